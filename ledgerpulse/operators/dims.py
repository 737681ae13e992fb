"""Calendar, client and merchant dimensions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.schema import KEY, ORDER

PROFILE_COLS = ["CardNumber", "Age", "Gender", "Bank", "CardType"]
PLACE_COLS = ["MerchandGroup", "Country2", "City2"]


def time_dim(spark: SparkSession, first_year: int, last_year: int | None = None) -> DataFrame:
    """One row per minute from the start of the first year to the end of the last."""
    last_year = last_year or first_year
    start = f"make_timestamp_ntz({first_year}, 1, 1, 0, 0, 0)"
    end = f"make_timestamp_ntz({last_year + 1}, 1, 1, 0, 0, 0)"
    minutes = spark.range(1).select(F.expr(f"timestampdiff(MINUTE, {start}, {end})")).first()[0]
    t = F.col("Time")
    return (spark.range(minutes)
            .select(F.expr(f"{start} + make_dt_interval(0, 0, cast(id AS int))").alias("Time"))
            .select("Time", F.to_date(t).alias("Date"), F.year(t).alias("Year"),
                    F.quarter(t).alias("Quarter"), F.month(t).alias("Month"),
                    F.dayofmonth(t).alias("Day"), F.hour(t).alias("Hour"),
                    F.minute(t).alias("Minute"), F.second(t).cast("int").alias("Second")))


def time_dim_of(txn: DataFrame) -> DataFrame:
    """The calendar of the years in which the transactions fall."""
    first, last = txn.agg(F.year(F.min("Time")), F.year(F.max("Time"))).first()
    return time_dim(txn.sparkSession, first, last)


def client_state(rows: DataFrame) -> DataFrame:
    """Per (account, channel) what the client dimension needs; the states of two batches merge to that of both."""
    # the decimal part of a sum does not depend on the rows' order; what decimals cannot hold is added apart
    exact = F.expr("try_cast(TransactionAmount AS DECIMAL(28, 8))")
    rest = F.col("TransactionAmount") - F.coalesce(exact.cast("double"), F.lit(0.0))
    return rows.groupBy(KEY, "Channel").agg(
        F.count(F.lit(1)).alias("n"), F.sum(exact).alias("amount"), F.sum(rest).alias("rest"),
        F.count("TransactionAmount").alias("amounts"),
        F.max_by(F.struct(*PROFILE_COLS), F.struct(*ORDER)).alias("profile"), F.max(F.struct(*ORDER)).alias("newest"))


def merge_client_states(states: DataFrame) -> DataFrame:
    # a sum of decimals has ten digits more than its input; the state keeps 38 in all
    amount = F.sum("amount").cast("decimal(38, 8)").alias("amount")
    return states.groupBy(KEY, "Channel").agg(
        F.sum("n").alias("n"), amount, F.sum("rest").alias("rest"), F.sum("amounts").alias("amounts"),
        F.max_by("profile", "newest").alias("profile"), F.max("newest").alias("newest"))


def client_dim_of(states: DataFrame) -> DataFrame:
    return (states.groupBy(KEY)
            .agg(F.max_by("profile", "newest").alias("profile"),
                 F.try_divide(F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)) + F.sum("rest"),
                              F.sum("amounts")).alias("AvgTxnAmount"),
                 F.max_by("Channel", F.struct("n", "Channel")).alias("UsualChannel"))
            .select(KEY, *[f"profile.{c}" for c in PROFILE_COLS], "AvgTxnAmount", "UsualChannel"))


def client_dim(silver: DataFrame) -> DataFrame:
    """Latest profile, mean amount and usual channel per account, from one scan.

    Grouping by (account, channel) first gives the channel counts, and everything else merges
    from those partial rows.
    """
    return client_dim_of(client_state(silver))


def merchand_state(rows: DataFrame) -> DataFrame:
    """Per merchant the newest row's group and place, with its time and id."""
    return rows.groupBy("MerchandCode").agg(
        F.max_by(F.struct(*PLACE_COLS), F.struct(*ORDER)).alias("place"), F.max(F.struct(*ORDER)).alias("newest"))


def merge_merchand_states(states: DataFrame) -> DataFrame:
    return states.groupBy("MerchandCode").agg(
        F.max_by("place", "newest").alias("place"), F.max("newest").alias("newest"))


def merchand_dim_of(states: DataFrame) -> DataFrame:
    return states.select("MerchandCode", F.col("place.MerchandGroup").alias("MerchandGroup"),
                         F.col("place.Country2").alias("Country"), F.col("place.City2").alias("City"))


def merchand_dim(silver: DataFrame) -> DataFrame:
    """Latest group and place per merchant."""
    return merchand_dim_of(merchand_state(silver))
