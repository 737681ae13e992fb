"""The generic event table seen as bank-card transactions."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.schema import TXN_COLS

# Vocabulary of the transaction feed.
CHANNELS = ["ATM", "POS", "WEB", "MOBILE"]
CARD_TYPES = ["VISA", "MASTERCARD", "AMEX"]
MERCHANT_GROUPS = ["GROCERY", "TECH", "TRAVEL", "RESTAURANT"]
COUNTRIES = ["MA", "FR", "ES", "US"]
CITIES = ["Casablanca", "Rabat", "Paris", "Madrid", "New York"]


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def events_as_txn(events: DataFrame) -> DataFrame:
    """17 transaction columns plus the ``isAnomaly`` label, one row per event."""
    k = F.get_json_object("props", "$.k").cast("int")
    event, user = F.col("event_id"), F.col("user_id")
    columns = {
        "TransactionID": event.cast("string"),
        "Time": F.col("ts").cast("timestamp_ntz"),
        "AccountNumber": F.concat(F.lit("ACC"), (user + 100000).cast("string")),
        "CardNumber": F.concat(F.lit("CARD"), (user % 9000 + 1000).cast("string")),
        "TransactionType": F.col("event_type"),
        "Channel": _pick(CHANNELS, k % 4),
        "TransactionAmount": F.col("value"),
        "MerchandCode": F.concat(F.lit("MER"), (k + 1000).cast("string")),
        "MerchandGroup": _pick(MERCHANT_GROUPS, k % 7 % 4),
        "Country": _pick(COUNTRIES, event % 11 % 4),
        "City": _pick(CITIES, event % 13 % 5),
        "Country2": _pick(COUNTRIES, k % 4),
        "City2": _pick(CITIES, k % 5),
        "CardType": _pick(CARD_TYPES, k % 3),
        "Age": (user % 63 + 18).cast("int"),
        "Gender": F.when(user % 2 == 0, "M").otherwise("F"),
        "Bank": F.lit("CDM"),
    }
    label = F.when((F.col("value") >= 150) & (k % 2 == 0), 1).otherwise(0)
    return events.select(*[columns[c].alias(c) for c in TXN_COLS], label.alias("isAnomaly"))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_txn(spark.read.parquet(f"{sf_dir}/events.parquet"))
