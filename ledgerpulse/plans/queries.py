"""The registered queries: each reads the given tables and returns one DataFrame."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.functions import clean
from ledgerpulse.operators import dims, evaluate, facts, stats
from ledgerpulse.operators.features import features
from ledgerpulse.operators.ranking import rank_pct, time_split
from ledgerpulse.operators.scale import Scaler, minmax_columns
from ledgerpulse.schema import (CAT_COLS, CLIENT_COLS, ENGINEERED_COLS, ENTROPY_COLS, FEATURE_COLS,
                                FREQ_COLS, GLOBAL_COLS, KEY, TIME_COLS, TXN_COLS)
from ledgerpulse.sources import feeds
from ledgerpulse.sources.events import CHANNELS, read_events
from ledgerpulse.sources.tables import write_csv
from ledgerpulse.storage import materialize, scratch_path

QUERIES = {}
ID = "TransactionID"
MOVING = ["MovingAvg", "MovingStd", "AmountZScore"]
SCORES = ("s1", "s2", "s3")


def query(fn, name: str | None = None):
    QUERIES[name or fn.__name__] = lambda spark, sf_dir: tidy(fn(spark, sf_dir))
    return fn


def tidy(df: DataFrame) -> DataFrame:
    """Doubles to 6 places without negative zero, so that engines can be compared."""
    return df.select(*[(F.round(f"`{n}`", 6) + F.lit(0.0)).alias(n) if t == "double" else F.col(f"`{n}`")
                       for n, t in df.dtypes])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three simple scores per transaction, with many ties in the first and the last."""
    amount, hour, minute = F.col("TransactionAmount"), F.hour("Time"), F.minute("Time")
    return read_events(spark, sf_dir).select(
        ID, "isAnomaly", (F.floor(amount) + 10 * hour).cast("double").alias("s1"),
        amount.alias("s2"), minute.cast("double").alias("s3"))


# --- sources ------------------------------------------------------------------------------

def _messages(txn: DataFrame) -> DataFrame:
    return txn.select(F.to_json(F.struct(*[
        F.regexp_replace(F.col(c).cast("string"), " ", "T").alias(c) if c == "Time" else F.col(c)
        for c in TXN_COLS])).alias("value"))


@query
def parse_json_events(spark, sf_dir):
    return feeds.parse_json(_messages(read_events(spark, sf_dir))).select(*TXN_COLS)


@query
def valid_events(spark, sf_dir):
    txn = read_events(spark, sf_dir)
    no_account = F.when(F.col("MerchandCode") != "MER1000", F.col(KEY))
    messages = _messages(txn.withColumn(KEY, no_account))
    return feeds.valid_events(feeds.parse_json(messages)).select(ID, KEY, "MerchandCode")


# Header of the training and the labelled file.
TRAIN_HEADER = {
    "TransactionID": "TransactionID", "Time": "Time", "AccountNumber": "Account Number",
    "CardNumber": "Card Number", "TransactionType": "Transaction Type", "Channel": "Channel",
    "TransactionAmount": "Transaction Amount", "MerchandCode": "Merchand Code",
    "MerchandGroup": "Merchand Group", "Country": "Country", "City": "City",
    "Country2": "Country 2", "City2": "City 2", "CardType": "Card Type", "Age": "Age",
    "Gender": "Gender",
}


def _csv_copy(txn: DataFrame, tag: str, extra: dict | None = None) -> str:
    """The transactions as a CSV folder in the layout of the files the loaders expect."""
    text = {"Time": F.col("Time").cast("string"),
            "TransactionAmount": F.format_number(F.col("TransactionAmount") * 100, 2)}
    path = scratch_path(txn.sparkSession, tag)
    write_csv(txn.select(*[text.get(c, F.col(c)).alias(h) for c, h in TRAIN_HEADER.items()],
                         *[e.alias(n) for n, e in (extra or {}).items()]), path)
    return path


@query
def load_train(spark, sf_dir):
    path = _csv_copy(read_events(spark, sf_dir), "train-csv")
    return feeds.load_train(spark, path).select(
        ID, "Time", KEY, "TransactionAmount", "Country2", "Age", "rank", "Date", "Hour")


def _labeled_csv(spark, sf_dir) -> str:
    extra = {"ClientID": F.col(KEY), "ClientName": F.col("CardNumber"), "Bank": F.col("Bank"),
             "AnomalyType": F.when(F.col("isAnomaly") == 1, "amount").otherwise("none"),
             "isAnomaly": F.col("isAnomaly")}
    return _csv_copy(read_events(spark, sf_dir), "labeled-csv", extra)


@query
def load_labeled(spark, sf_dir):
    return feeds.load_labeled(spark, _labeled_csv(spark, sf_dir)).select(
        ID, "Time", KEY, "TransactionAmount", "City2", "Bank", "rank", "Date", "Hour", "isAnomaly")


@query
def csv_to_events(spark, sf_dir):
    txn = read_events(spark, sf_dir)
    when = F.format_string("%d/%d/%d %d:%02d", F.month("Time"), F.dayofmonth("Time"), F.year("Time"),
                           F.hour("Time"), F.minute("Time"))
    path = scratch_path(spark, "replay-csv")
    write_csv(txn.withColumn("Time", when).select(*TXN_COLS), path)
    messages = feeds.csv_to_events(spark, path)
    return feeds.parse_json(messages).select(F.col(KEY).alias("key"), *TXN_COLS)


# --- projections and filters --------------------------------------------------------------

@query
def drop_null_rows(spark, sf_dir):
    df = features(read_events(spark, sf_dir), "expanding", MOVING + ["LogTimeDiff"])
    return clean.drop_null_rows(df).select(ID, *MOVING, "LogTimeDiff")


@query
def clean_amount(spark, sf_dir):
    txn = read_events(spark, sf_dir)
    text = txn.withColumn("amount", F.format_number(F.col("TransactionAmount") * 1000, 2))
    return text.select(ID, clean.clean_number("amount").alias("amount"))


@query
def date_hour(spark, sf_dir):
    return clean.date_hour(read_events(spark, sf_dir)).select(ID, "Date", "Hour")


@query
def fill_zero(spark, sf_dir):
    df = features(read_events(spark, sf_dir), "expanding", MOVING + ["LogTimeDiff"])
    return clean.fill_zero(df, MOVING + ["LogTimeDiff"]).select(ID, *MOVING, "LogTimeDiff")


@query
def impute_mean(spark, sf_dir):
    columns = MOVING + ["LogTimeDiff"]
    df = materialize(features(read_events(spark, sf_dir), "expanding", columns), "engineered")
    return clean.MeanImputer(columns).fit(df).transform(df).select(ID, *columns)


@query
def anomaly_flags(spark, sf_dir):
    df = features(read_events(spark, sf_dir), "trailing", MOVING + ["LogAmount"])
    return clean.anomaly_flags(df, "LogAmount").select(ID, "LogAmount", "IsAnomaly", "IsCritical")


def _rank_pct(spark, sf_dir):
    return rank_pct(read_events(spark, sf_dir)).select(ID, KEY, "rank")


def _time_split(spark, sf_dir):
    train, test = time_split(read_events(spark, sf_dir), 0.8, ["TransactionAmount"])
    parts = (train.withColumn("part", F.lit("train"))
             .unionByName(test.withColumn("part", F.lit("test"))))
    return parts.select(ID, KEY, "TransactionAmount", "part")


query(_rank_pct, "rank_pct")
query(_time_split, "time_split")


@query
def feature_vector(spark, sf_dir):
    df = clean.feature_vector(features(read_events(spark, sf_dir), "trailing"))
    return df.select(ID, F.posexplode("vector").alias("position", "value"))


# --- joins --------------------------------------------------------------------------------

@query
def client_dim(spark, sf_dir):
    return dims.client_dim(read_events(spark, sf_dir))


@query
def merchand_dim(spark, sf_dir):
    return dims.merchand_dim(read_events(spark, sf_dir))


@query
def time_dim(spark, sf_dir):
    return dims.time_dim_of(read_events(spark, sf_dir))


@query
def attach_account_entropy(spark, sf_dir):
    return stats.attach_account_entropy(read_events(spark, sf_dir)).select(ID, KEY, *ENTROPY_COLS)


@query
def semi_sampled_accounts(spark, sf_dir):
    txn = read_events(spark, sf_dir)
    sample = stats.stratified_sample(stats.activity_buckets(txn))
    return stats.rows_of(txn, sample, bounded=True).select(ID, KEY, "TransactionAmount")


@query
def attach_label(spark, sf_dir):
    path = _labeled_csv(spark, sf_dir)
    rows = feeds.load_labeled(spark, path).select(ID, KEY, "isAnomaly")
    return rows.join(feeds.anomaly_types(spark, path), ID, "left")


# --- aggregations -------------------------------------------------------------------------

@query
def usual_channel(spark, sf_dir):
    return stats.usual_value(read_events(spark, sf_dir), KEY, "Channel", "UsualChannel")


@query
def latest_profile(spark, sf_dir):
    return stats.latest_row(read_events(spark, sf_dir), KEY, dims.PROFILE_COLS)


def _with_log(spark, sf_dir):
    return features(read_events(spark, sf_dir), "trailing", ["LogAmount"])


@query
def client_stats(spark, sf_dir):
    return stats.client_stats(_with_log(spark, sf_dir), ["LogAmount", "TransactionAmount"])


@query
def account_activity(spark, sf_dir):
    return stats.account_activity(read_events(spark, sf_dir))


@query
def activity_buckets(spark, sf_dir):
    return stats.activity_buckets(read_events(spark, sf_dir))


@query
def stratified_sample(spark, sf_dir):
    return stats.stratified_sample(stats.activity_buckets(read_events(spark, sf_dir)))


@query
def daily_mean(spark, sf_dir):
    return stats.daily_mean(_with_log(spark, sf_dir), "LogAmount")


@query
def pivot_daily(spark, sf_dir):
    """A column for each account of the stratified sample, in the accounts' order."""
    df = _with_log(spark, sf_dir)
    accounts = [r[KEY] for r in stats.stratified_sample(stats.activity_buckets(df)).select(KEY).orderBy(KEY).collect()]
    names = [f"top{i}" for i in range(1, len(accounts) + 1)]
    return stats.pivot_daily(stats.daily_mean(df, "LogAmount"), accounts, "mean_LogAmount", names)


@query
def crosstab_share(spark, sf_dir):
    columns = ["TransactionType", "Channel", "CardType", "MerchandGroup", "Country"]
    return stats.crosstab_share(read_events(spark, sf_dir), columns)


@query
def crosstab_channel(spark, sf_dir):
    return stats.crosstab_wide(read_events(spark, sf_dir), "Channel", CHANNELS)


@query
def value_counts(spark, sf_dir):
    return stats.value_counts(read_events(spark, sf_dir), CAT_COLS)


@query
def describe_numeric(spark, sf_dir):
    return stats.describe(_with_log(spark, sf_dir), ["Age", "TransactionAmount", "LogAmount"])


@query
def histogram(spark, sf_dir):
    return stats.histogram(read_events(spark, sf_dir), "TransactionAmount", 30)


@query
def histogram_by_account(spark, sf_dir):
    return stats.histogram(read_events(spark, sf_dir), "TransactionAmount", 30, by=KEY)


@query
def box_stats(spark, sf_dir):
    return stats.box_stats(read_events(spark, sf_dir), "TransactionAmount", [])


@query
def box_stats_by_age(spark, sf_dir):
    return stats.box_stats(read_events(spark, sf_dir), "TransactionAmount", ["Age"])


@query
def account_entropy(spark, sf_dir):
    return stats.account_entropies(read_events(spark, sf_dir), normalised=False)


@query
def account_norm_entropy(spark, sf_dir):
    return stats.account_entropies(read_events(spark, sf_dir))


@query
def score_distribution(spark, sf_dir):
    return stats.score_distribution(scored(spark, sf_dir), "s2")


# --- per-account features -----------------------------------------------------------------

def _feature_query(name: str, profile: str, columns: list[str]):
    def run(spark, sf_dir):
        return features(read_events(spark, sf_dir), profile, columns).select(ID, KEY, "Time", *columns)
    query(run, name)


for _profile in ("trailing", "expanding", "value_frame"):
    _feature_query(f"moving_stats_{_profile}", _profile, MOVING)
    _feature_query(f"freq_{_profile}", _profile, FREQ_COLS)
    _feature_query(f"entropy_{_profile}", _profile, ENTROPY_COLS)
    _feature_query("time_diff" if _profile == "trailing" else f"time_diff_{_profile}", _profile,
                   ["LogTimeDiff"])
    _feature_query(f"features_{_profile}", _profile, ENGINEERED_COLS)
_feature_query("log_amount", "trailing", ["LogAmount"])
_feature_query("hour_cyclic", "trailing", ["HourSin", "HourCos"])


# --- scaling ------------------------------------------------------------------------------

def _scale_query(name: str, method: str, columns: list[str]):
    def run(spark, sf_dir):
        df = materialize(features(read_events(spark, sf_dir), "trailing"), "engineered")
        return Scaler(method).fit(df).transform(df).select(ID, *columns)
    query(run, name)


_scale_query("scale_none", "none", FEATURE_COLS)
_scale_query("scale_global_minmax", "global_minmax", FEATURE_COLS)
_scale_query("scale_global_standard", "global_standard", FEATURE_COLS)
_scale_query("scale_client_minmax", "global_minmax_client_minmax", GLOBAL_COLS + CLIENT_COLS)
_scale_query("scale_client_standard", "global_standard_client_standard", GLOBAL_COLS + CLIENT_COLS)


@query
def score_minmax(spark, sf_dir):
    return minmax_columns(scored(spark, sf_dir), list(SCORES)).select(ID, *SCORES)


# --- evaluation ---------------------------------------------------------------------------

def _curve(spark, sf_dir):
    return evaluate.curve(scored(spark, sf_dir), "s1", "isAnomaly")


@query
def roc_auc(spark, sf_dir):
    return evaluate.curve_metrics(_curve(spark, sf_dir)).select("roc_auc")


@query
def pr_auc(spark, sf_dir):
    return evaluate.curve_metrics(_curve(spark, sf_dir)).select("pr_auc", "base_rate")


@query
def pr_curve(spark, sf_dir):
    return evaluate.pr_points(_curve(spark, sf_dir))


@query
def roc_curve(spark, sf_dir):
    return evaluate.roc_points(_curve(spark, sf_dir))


@query
def best_f1(spark, sf_dir):
    return evaluate.curve_metrics(_curve(spark, sf_dir)).select("f1", "precision", "recall", "threshold")


@query
def p95_metrics(spark, sf_dir):
    return evaluate.percentile_metrics(scored(spark, sf_dir), "s1", "isAnomaly")


def _unit_scores(spark, sf_dir):
    return minmax_columns(scored(spark, sf_dir), list(SCORES))


@query
def ensemble_blend(spark, sf_dir):
    weights = {"s3": 0.65, "s2": 0.35, "s1": 0.0}
    return evaluate.blend(_unit_scores(spark, sf_dir), weights).select(ID, "ensemble")


@query
def ensemble_search(spark, sf_dir):
    unit = materialize(_unit_scores(spark, sf_dir), "unit-scores")
    return evaluate.ensemble_search(unit, SCORES, "isAnomaly")


@query
def top_scores(spark, sf_dir):
    return stats.top_scores(scored(spark, sf_dir), "s1").select(ID, "isAnomaly", "s1")


# --- table rows without a model -----------------------------------------------------------

@query
def bronze(spark, sf_dir):
    return facts.bronze_rows(read_events(spark, sf_dir)).drop("bronzetimestamp")


@query
def silver_features(spark, sf_dir):
    return features(read_events(spark, sf_dir), "trailing").select(*TXN_COLS, *ENGINEERED_COLS)


def _silver_with_share(spark, sf_dir):
    """Silver rows whose score is LogAmount and whose explanation is each absolute feature's share."""
    df = features(read_events(spark, sf_dir), "trailing", ["LogAmount", *FREQ_COLS])
    total = sum((F.col(c) for c in FREQ_COLS), F.lit(0.0))
    parts = F.array(*[F.col(c) / total for c in FREQ_COLS])
    return df.withColumns({
        "modelscore": F.col("LogAmount"),
        "modelexplain": F.map_from_arrays(F.array(*[F.lit(c) for c in FREQ_COLS]), parts)})


@query
def transaction_fact(spark, sf_dir):
    return facts.transaction_fact(_silver_with_share(spark, sf_dir)).drop("goldtimestamp")


@query
def explain_fact(spark, sf_dir):
    return facts.explain_fact(_silver_with_share(spark, sf_dir))
