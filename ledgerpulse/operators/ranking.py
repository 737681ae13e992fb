"""Position of a row in its account's history, and the split of each history by time."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.functions.clean import fill_zero
from ledgerpulse.operators.slices import HOT_ROWS, ROWS, slice_accounts
from ledgerpulse.operators.features import running_rows
from ledgerpulse.schema import KEY


def rank_pct(txn: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``rank``: row number within the account by time, divided by the account's rows."""
    keyed = slice_accounts(txn, 0, ROWS, max_rows)
    rows = F.count(F.lit(1)).over(Window.partitionBy(*keyed.part))
    df = keyed.df.withColumns({"_upto": running_rows(keyed), "_rows": rows})
    if keyed.sliced:
        totals = keyed.hot.sized().select(F.col(KEY).alias("_hot"), F.col("n").alias("_hot_rows"))
        df = (df.join(totals, F.col(KEY).eqNullSafe(F.col("_hot")), "left")
              .withColumn("_rows", F.coalesce("_hot_rows", "_rows")))
    df = df.withColumn("rank", F.col("_upto") / F.col("_rows"))
    return keyed.own(df).select(*txn.columns, "rank")


def time_split(df: DataFrame, share: float = 0.8, fill: list[str] | None = None,
               max_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(first ``share`` of every account's rows, the rest); ``fill`` columns get inf/NaN/null -> 0."""
    ranked = df if "rank" in df.columns else rank_pct(df, max_rows)
    train = ranked.filter(F.col("rank") <= share).drop("rank")
    test = ranked.filter(F.col("rank") > share).drop("rank")
    return (fill_zero(train, fill), fill_zero(test, fill)) if fill else (train, test)
