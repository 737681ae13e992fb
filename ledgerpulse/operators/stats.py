"""Descriptive statistics of transactions, accounts and scores."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.operators.quantiles import exact_quantiles, group_quantiles, value_ranks
from ledgerpulse.operators.slices import HOT_ROWS, attach
from ledgerpulse.schema import CAT_COLS, ENTROPY_COLS, KEY, ORDER

PIVOT_LIMIT = 1000
# Activity buckets and their upper quantiles.
BUCKETS = {"low": 0.33, "medium": 0.66, "high": 1.0}


def latest_row(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The columns of the newest row per key, by (Time, TransactionID)."""
    newest = F.max_by(F.struct(*columns), F.struct(*ORDER))
    return df.groupBy(key).agg(newest.alias("_row")).select(key, "_row.*")


def usual_value(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """The most frequent value per key; among equals the greatest value."""
    counts = df.groupBy(key, column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(F.max_by(column, F.struct("_n", column)).alias(name))


def client_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean and standard deviation of each column per account."""
    return df.groupBy(KEY).agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (
        ("count", F.count), ("mean", F.avg), ("std", F.stddev_samp))])


def account_activity(df: DataFrame) -> DataFrame:
    return df.groupBy(KEY).agg(F.count(F.lit(1)).alias("activity"))


def activity_buckets(df: DataFrame) -> DataFrame:
    """Accounts cut at the 33rd and 66th percentile of their activity, upper edge included."""
    activity = account_activity(df)
    edges = [p for p in BUCKETS.values() if p < 1]
    cuts = exact_quantiles(activity, {"activity": F.col("activity").cast("double")}, edges)
    names = list(BUCKETS)
    bucket = F.lit(names[-1])
    for name, p in reversed(list(zip(names, edges))):
        bucket = F.when(F.col("activity") <= F.lit(cuts["activity", p]), name).otherwise(bucket)
    return activity.withColumn("bucket", bucket)


def stratified_sample(buckets: DataFrame, per_bucket: int = 5, seed: int = 42) -> DataFrame:
    """Up to ``per_bucket`` accounts of each bucket, picked by a seeded hash of the account."""
    ticket = F.md5(F.concat_ws(":", F.col(KEY), F.lit(str(seed))))
    w = Window.partitionBy("bucket").orderBy("_ticket", KEY)
    return (buckets.withColumn("_ticket", ticket).withColumn("_rank", F.row_number().over(w))
            .filter(F.col("_rank") <= per_bucket).drop("_ticket", "_rank"))


def rows_of(df: DataFrame, accounts: DataFrame, bounded: bool = False) -> DataFrame:
    """Rows of the given accounts; ``bounded`` says their number is fixed and small."""
    keys = accounts.select(KEY)
    return df.join(F.broadcast(keys) if bounded else keys, KEY, "left_semi")


def daily_mean(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(KEY, F.to_date("Time").alias("date")).agg(F.avg(column).alias(f"mean_{column}"))


def pivot_daily(daily: DataFrame, accounts: list[str], column: str,
                names: list[str] | None = None) -> DataFrame:
    """One row per day, one column per listed account."""
    if len(accounts) > PIVOT_LIMIT:
        raise ValueError(f"at most {PIVOT_LIMIT} accounts can become columns")
    names = names or accounts
    return (daily.filter(F.col(KEY).isin(accounts)).groupBy("date")
            .agg(*[F.max(F.when(F.col(KEY) == a, F.col(column))).alias(n)
                   for a, n in zip(accounts, names)]))


def _values(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """Long form: one (category, value) pair per row and column, in one pass."""
    pairs = [F.struct(F.lit(c).alias("category"), F.col(c).alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*pairs)))


def crosstab_share(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of each category value among the account's rows, long form."""
    counts = (_values(df, columns, [KEY]).groupBy(KEY, "category", "value")
              .agg(F.count(F.lit(1)).alias("n")))
    total = F.sum("n").over(Window.partitionBy(KEY, "category"))
    return counts.select(KEY, "category", "value", (F.col("n") / total).alias("share"))


def crosstab_wide(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Accounts x values with row shares; absent values are 0."""
    if len(values) > PIVOT_LIMIT:
        raise ValueError(f"at most {PIVOT_LIMIT} values can become columns")
    return df.groupBy(KEY).agg(*[(F.count_if(F.col(column) == v) / F.count(column)).alias(v)
                                 for v in values])


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return (_values(df, columns, []).groupBy("category", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max: one row per column."""
    quartiles = exact_quantiles(df, {c: F.col(c).cast("double") for c in columns}, [0.25, 0.5, 0.75])
    parts = df.agg(*[F.struct(
        F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
        *[F.lit(quartiles[c, p]).cast("double").alias(f"q{int(p * 100)}") for p in (0.25, 0.5, 0.75)],
        F.max(c).cast("double").alias("max")).alias(c) for c in columns])
    return parts.select(F.inline(F.array(*columns)))


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None,
              max_rows: int = HOT_ROWS) -> DataFrame:
    """Counts in equal-width bins between minimum and maximum, overall or per key."""
    value = F.col(column).cast("double")
    limits = [F.min(value).alias("_low"), F.max(value).alias("_high")]
    if by is None:
        low, high = df.agg(*limits).first()
        edges = df.withColumns({"_low": F.lit(low).cast("double"), "_high": F.lit(high).cast("double")})
        keys = []
    else:
        edges = attach(df, df.groupBy(by).agg(*limits), by, "inner", max_rows)
        keys = [by]
    width = (F.col("_high") - F.col("_low")) / F.lit(float(bins))
    place = F.coalesce(F.floor(F.try_divide(value - F.col("_low"), width)), F.lit(0))
    return (edges.filter(value.isNotNull())
            .groupBy(*keys, F.least(place, F.lit(bins - 1)).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("_low").alias("_low"), F.min(width).alias("_width"))
            .select(*keys, "bin", (F.col("_low") + F.col("bin") * F.col("_width")).alias("left_edge"), "n"))


def box_stats(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Quartiles, whiskers (furthest value within 1.5 quartile ranges) and outliers per group."""
    ranks = value_ranks(df, by, column)
    quartiles = group_quantiles(ranks, by, column, {"q1": 0.25, "median": 0.5, "q3": 0.75}).drop("n")
    if by:
        # joined per (group, slice), so that a large group is not one join task
        pieces = ranks.select(*by, "_slice").distinct().join(quartiles, by)
        rows = ranks.join(pieces, [*by, "_slice"])
    else:
        rows = ranks.withColumns({c: F.lit(v).cast("double")
                                  for c, v in quartiles.first().asDict().items()})
    value, spread = F.col(column), F.col("q3") - F.col("q1")
    inside = value.between(F.col("q1") - 1.5 * spread, F.col("q3") + 1.5 * spread)
    return rows.groupBy(*by).agg(
        F.sum("n").alias("n"), *[F.max(c).alias(c) for c in ("q1", "median", "q3")],
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("outliers"))


def account_entropies(df: DataFrame, normalised: bool = True) -> DataFrame:
    """Shannon entropy (natural log) of six categories per account, in one grouping.

    H = ln N - (sum of k ln k) / N over the counts k; normalised by ln(distinct values), 0 for one.
    """
    pairs = [F.struct(F.lit(i).alias("_cat"), F.col(c).alias("_value")) for i, c in enumerate(CAT_COLS)]
    counts = (df.select(KEY, F.inline(F.array(*pairs))).groupBy(KEY, "_cat", "_value")
              .agg(F.count(F.lit(1)).alias("k")))

    def of(i: int, value) -> Column:
        return F.sum(F.when(F.col("_cat") == i, value).otherwise(0))

    weighted = F.col("k") * F.log("k")
    sums = counts.groupBy(KEY).agg(
        of(0, F.col("k")).cast("double").alias("n"),
        *[of(i, weighted).alias(f"w{i}") for i in range(len(CAT_COLS))],
        *[of(i, F.lit(1)).alias(f"u{i}") for i in range(len(CAT_COLS))])
    out = []
    for i, name in enumerate(ENTROPY_COLS):
        h = F.greatest(F.log("n") - F.col(f"w{i}") / F.col("n"), F.lit(0.0))
        if normalised:
            h = F.when(F.col(f"u{i}") > 1, h / F.log(f"u{i}")).otherwise(0.0)
        out.append(h.alias(name))
    return sums.select(KEY, *out)


def attach_account_entropy(df: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    return attach(df, account_entropies(df), KEY, "left", max_rows)


def score_distribution(scored: DataFrame, score: str) -> DataFrame:
    """One row: mean, median, population std, skewness, p95, p99 and p99 - p90."""
    q = exact_quantiles(scored, {score: F.col(score)}, [0.5, 0.9, 0.95, 0.99])
    at = {p: F.lit(q[score, p]).cast("double") for p in (0.5, 0.9, 0.95, 0.99)}
    return scored.agg(
        F.avg(score).alias("score_mean"), at[0.5].alias("score_median"),
        F.stddev_pop(score).alias("score_std"), F.skewness(score).alias("score_skew"),
        at[0.95].alias("score_p95"), at[0.99].alias("score_p99"), (at[0.99] - at[0.9]).alias("tailsep"))


def top_scores(scored: DataFrame, score: str, k: int = 30, id_col: str = "TransactionID") -> DataFrame:
    return scored.orderBy(F.desc(score), F.asc(id_col)).limit(k)
