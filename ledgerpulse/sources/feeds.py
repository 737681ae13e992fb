"""Transaction feeds: JSON messages, Kafka, training / validation / replay CSV files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerpulse.functions.clean import clean_number, date_hour, parse_time
from ledgerpulse.operators.ranking import rank_pct
from ledgerpulse.schema import KEY, TXN_COLS, TXN_SCHEMA

CORRUPT = "_corrupt"
_TEXT_TIME = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "Time" else f
                           for f in TXN_SCHEMA])
_JSON_SCHEMA = T.StructType([*_TEXT_TIME.fields, T.StructField(CORRUPT, T.StringType())])

# Columns of the labelled file that are no transaction fields.
LABELED_EXTRA = ["ClientID", "ClientName", "AnomalyType"]


def read_kafka(spark: SparkSession, servers: str, topic: str, per_trigger: int,
               starting: str = "latest") -> DataFrame:
    """The topic as a stream with a ``value`` column; ``per_trigger`` bounds each micro-batch."""
    return (spark.readStream.format("kafka").options(**kafka_options(servers, topic, per_trigger, starting))
            .load())


def kafka_options(servers: str, topic: str, per_trigger: int, starting: str = "latest") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
            "failOnDataLoss": "false", "maxOffsetsPerTrigger": str(per_trigger)}


def read_json_files(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of text files, one JSON message per line, as a stream with a ``value`` column."""
    return (spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger)
            .load(path).select("value"))


def parse_json(messages: DataFrame) -> DataFrame:
    """The message text as transaction columns; malformed text gives nulls and ``_corrupt``."""
    text = F.col("value").cast("string")
    data = F.from_json(text, _JSON_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return (messages.select(data.alias("data")).select("data.*")
            .withColumn("Time", parse_time("Time")))


def valid_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col(KEY).isNotNull())


def rejected(messages: DataFrame) -> DataFrame:
    """(value, reason, seen) of messages that are malformed or name no account."""
    text = F.col("value").cast("string")
    data = F.from_json(text, _JSON_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    reason = F.when(data.isNull() | data[CORRUPT].isNotNull(), "malformed").when(data[KEY].isNull(), "no account")
    return (messages.select(text.alias("value"), reason.alias("reason"), F.current_timestamp().alias("seen"))
            .where("reason IS NOT NULL"))


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, named without spaces ('Account Number' -> AccountNumber)."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.col(f"`{c}`").alias(c.replace(" ", "")) for c in raw.columns])


def _typed(df: DataFrame) -> DataFrame:
    casts = {"Time": parse_time("Time"), "Age": F.col("Age").cast("double").cast("int"),
             "TransactionAmount": clean_number("TransactionAmount")}
    return df.withColumns({c: e for c, e in casts.items() if c in df.columns})


def load_train(spark: SparkSession, path: str) -> DataFrame:
    """Training file: typed, with ``rank`` (share of the account's history), Date and Hour."""
    return date_hour(rank_pct(_typed(_read_csv(spark, path))))


def load_labeled(spark: SparkSession, path: str) -> DataFrame:
    """Validation file: client columns dropped, label ``isAnomaly`` kept as an integer."""
    df = _read_csv(spark, path).drop(*LABELED_EXTRA)
    return date_hour(rank_pct(_typed(df).withColumn("isAnomaly", F.col("isAnomaly").cast("int"))))


def anomaly_types(spark: SparkSession, path: str) -> DataFrame:
    """TransactionID and AnomalyType of the validation file, to join back after scoring."""
    return _read_csv(spark, path).select("TransactionID", "AnomalyType")


def csv_to_events(spark: SparkSession, path: str) -> DataFrame:
    """Replay file as keyed messages: ``key`` is the account, ``value`` the JSON event."""
    df = _typed(_read_csv(spark, path)).select(*TXN_COLS)
    iso = F.regexp_replace(F.col("Time").cast("string"), " ", "T")
    return df.select(F.col(KEY).alias("key"),
                     F.to_json(F.struct(*[iso.alias(c) if c == "Time" else F.col(c)
                                          for c in TXN_COLS])).alias("value"))
