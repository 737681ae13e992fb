"""Registered queries that run streams and lakehouse tables to completion."""

import uuid
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.models.som import SelfOrganizingMap
from ledgerpulse.models.store import ScoringModel
from ledgerpulse.operators import facts
from ledgerpulse.operators.features import epoch_micros, features
from ledgerpulse.operators.scale import Scaler
from ledgerpulse.plans.model_queries import MAP
from ledgerpulse.plans.queries import ID, _messages, query
from ledgerpulse.schema import ENGINEERED_COLS, FEATURE_COLS, KEY, TABLES
from ledgerpulse.sources.events import read_events
from ledgerpulse.sources.feeds import parse_json, read_json_files, valid_events
from ledgerpulse.sources.tables import compact_day, create_tables, read_table
from ledgerpulse.storage import materialize, scratch_path
from ledgerpulse.streaming import medallion
from ledgerpulse.streaming.stateful import stateful_features

ONCE = {"availableNow": True}
FILES = 64      # of one micro-batch


def time_parts(txn: DataFrame, parts: int) -> list[DataFrame]:
    """The transactions cut into equal spans of time, oldest first."""
    micros = txn.withColumn("_us", epoch_micros())
    low, high = micros.agg(F.min("_us"), F.max("_us")).first()
    part = F.floor((F.col("_us") - low) * parts / (high - low + 1))
    return [micros.filter(part == i).drop("_us") for i in range(parts)]


class Feed:
    """A folder of JSON messages that grows part by part."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = scratch_path(spark, "feed")

    def add(self, txn: DataFrame) -> None:
        _messages(txn).write.mode("append").text(self.path)

    def stream(self) -> DataFrame:
        return read_json_files(self.spark, self.path, FILES)


def _streamed(spark, sf_dir, parts: int, **options) -> DataFrame:
    """Features of as many micro-batches, the stream restarted from its checkpoint before each."""
    feed, out, checkpoint = Feed(spark), scratch_path(spark, "stream"), scratch_path(spark, "checkpoint")
    for part in time_parts(read_events(spark, sf_dir), parts):
        feed.add(part)
        stream = stateful_features(valid_events(parse_json(feed.stream())), **options)
        (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(**ONCE).start().awaitTermination())
    return spark.read.parquet(out).select(ID, KEY, "Time", *ENGINEERED_COLS)


@query
def stream_features_trailing(spark, sf_dir):
    return _streamed(spark, sf_dir, 4)


@query
def stream_features_window(spark, sf_dir):
    """The same over each account's last three rows."""
    return _streamed(spark, sf_dir, 2, window=3)


def _model(spark, sf_dir) -> ScoringModel:
    df = materialize(features(read_events(spark, sf_dir), "trailing"), "engineered")
    return ScoringModel(Scaler("global_standard"), {"som": SelfOrganizingMap(**MAP)}).fit(df)


def rule_model() -> ScoringModel:
    """A map of 3 x 3 given by a rule: unit u is 20 + 6 u years old, feature j of it is ((7 u + 3 j) mod 11) / 4."""
    u, j = np.arange(9)[:, None], np.arange(len(FEATURE_COLS))[None, :]
    som = SelfOrganizingMap(FEATURE_COLS, x=3, y=3)
    som.codebook = np.where(j == 0, 20.0 + 6 * u, (7 * u + 3 * j) % 11 / 4.0)
    return ScoringModel(Scaler("none"), {"som": som})


def _run(spark, sf_dir, parts: int, model: ScoringModel | None = None) -> str:
    feed, root, checkpoint = Feed(spark), scratch_path(spark, "lake"), scratch_path(spark, "checkpoint")
    model = model or _model(spark, sf_dir)
    for part in time_parts(read_events(spark, sf_dir), parts):
        feed.add(part)
        medallion.start_stateful(feed.stream(), root, checkpoint, model, "som", ONCE).awaitTermination()
    return root


def _count(spark, root: str, table: str) -> DataFrame:
    rows = read_table(spark, root, table)
    return rows.agg(F.lit(table).alias("table"), F.count(F.lit(1)).alias("rows"),
                    F.count_distinct(rows.columns[0]).alias("keys"))


@query
def stream_medallion(spark, sf_dir):
    root = _run(spark, sf_dir, 2)
    return reduce(DataFrame.unionByName, [_count(spark, root, t) for t in medallion.BATCH_TABLES])


@query
def stream_medallion_values(spark, sf_dir):
    """Every number the four tables hold after two micro-batches that a map given by a rule has scored."""
    root = _run(spark, sf_dir, 2, rule_model())
    held = {"bronze.transactions": ["TransactionAmount"], "silver.features": [*ENGINEERED_COLS, "modelscore"],
            "gold.TransactionFact": ["modelscore", "IsAnomaly", "IsCritical"]}
    found = []
    for table, columns in held.items():
        pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
        found.append(read_table(spark, root, table).select(F.lit(table).alias("table"), "batch_id", ID, F.inline(pairs)))
    explained = read_table(spark, root, "gold.ExplainFact").select(
        F.lit("gold.ExplainFact").alias("table"), "batch_id", ID, F.col("FeatureName").alias("name"),
        F.col("FeatureValue").alias("value"))
    return reduce(DataFrame.unionByName, [*found, explained])


@query
def stream_memoryless(spark, sf_dir):
    """Silver rows of one micro-batch that holds all messages, with features within it."""
    feed, root, checkpoint = Feed(spark), scratch_path(spark, "lake"), scratch_path(spark, "checkpoint")
    feed.add(read_events(spark, sf_dir))
    medallion.start_memoryless(feed.stream(), root, checkpoint, _model(spark, sf_dir), "som",
                               trigger=ONCE).awaitTermination()
    return read_table(spark, root, "silver.features").select(ID, KEY, "Time", *ENGINEERED_COLS)


@query
def stream_resume(spark, sf_dir):
    root = _run(spark, sf_dir, 3)
    silver = read_table(spark, root, "silver.features")
    return silver.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"), F.min("Time").alias("first"),
                                          F.max("Time").alias("last"))


def _batch_lake(spark, sf_dir) -> str:
    """All tables filled by one batch write; a fitted map scores it."""
    root = scratch_path(spark, "lake")
    medallion.write_batch(features(read_events(spark, sf_dir), "trailing"), 0, root,
                          _model(spark, sf_dir), "som")
    medallion.refresh_dims(spark, root, bootstrap=True)
    return root


@query
def table_schemas(spark, sf_dir):
    """Column, type and row count of each of the seven tables after a full load."""
    root = _batch_lake(spark, sf_dir)
    found = []
    for table, (schema, _) in TABLES.items():
        rows = read_table(spark, root, table).select(*schema.fieldNames())
        columns = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                                     F.lit(f.dataType.simpleString()).alias("type"))
                            for i, f in enumerate(schema)])
        found.append(rows.agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(table).alias("table"), "rows", F.inline(columns)))
    return reduce(DataFrame.unionByName, found)


@query
def table_catalog(spark, sf_dir):
    """The same read from the catalog, after a load in two batches through it and the compaction of every day."""
    root, prefix = scratch_path(spark, "lake"), f"t{uuid.uuid4().hex}_"
    names = dict(zip(TABLES, create_tables(spark, root, prefix), strict=True))
    model = rule_model()
    try:
        for i, part in enumerate(time_parts(features(read_events(spark, sf_dir), "trailing"), 2)):
            medallion.write_batch(part, i, root, model, "som", catalog=prefix)
        medallion.refresh_dims(spark, root, bootstrap=True, catalog=prefix)
        facts_table = "gold.TransactionFact"
        for day in [r[0] for r in spark.table(names[facts_table]).select("date").distinct().collect()]:   # days only
            compact_day(spark, root, facts_table, str(day), catalog=prefix)
        found = []
        for table, name in names.items():
            listed = [c for c in spark.catalog.listColumns(name) if not c.isPartition]
            columns = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c.name).alias("column"),
                                         F.lit(c.dataType).alias("type")) for i, c in enumerate(listed)])
            found.append(spark.table(name).agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit(table).alias("table"), "rows", F.inline(columns)))
        return materialize(reduce(DataFrame.unionByName, found), "catalog-tables")
    finally:
        for name in names.values():
            spark.sql(f"DROP TABLE {name}")
        for layer in dict.fromkeys(t.split(".")[0] for t in TABLES):
            spark.sql(f"DROP DATABASE {prefix}{layer}")


@query
def dim_overwrite(spark, sf_dir):
    """The client dimension after two refreshes: replaced, not doubled."""
    root = _batch_lake(spark, sf_dir)
    medallion.refresh_dims(spark, root)
    return read_table(spark, root, "gold.ClientDim")


@query
def silver_rows(spark, sf_dir):
    df = features(read_events(spark, sf_dir), "trailing")
    scored = _model(spark, sf_dir).transform(df)
    return facts.silver_rows(scored, "som_score", "som_explain").drop("silvertimestamp", "modelexplain")
