"""Micro-batches into bronze, silver and gold tables, and the queries that run them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerpulse.models.store import ScoringModel
from ledgerpulse.operators import dims, facts
from ledgerpulse.operators.features import features
from ledgerpulse.schema import ANOMALY_THRESHOLD, CRITICAL_THRESHOLD, WINDOW_ROWS
from ledgerpulse.sources.feeds import CORRUPT, parse_json, rejected, valid_events
from ledgerpulse.sources.tables import append_rows, overwrite_table, read_table
from ledgerpulse.storage import owned
from ledgerpulse.streaming import dim_refresh
from ledgerpulse.streaming.stateful import stateful_features

BATCH_TABLES = ["bronze.transactions", "silver.features", "gold.TransactionFact", "gold.ExplainFact"]


def write_batch(engineered: DataFrame, batch_id: int, root: str, model: ScoringModel, prefix: str,
                anomaly: float = ANOMALY_THRESHOLD, critical: float = CRITICAL_THRESHOLD,
                catalog: str | None = None, landed: bool = False) -> None:
    """Land one batch, score it once and write its tables; repeating a batch replaces its rows.

    Bronze is written before anything that can fail, unless it is ``landed`` already. What several tables
    read is written to shared storage and deleted at the end.
    """
    with owned(engineered.sparkSession) as write:
        rows = write(engineered, "batch")
        if not landed:
            append_rows(facts.bronze_rows(rows), root, "bronze.transactions", batch_id, catalog)
        silver = write(facts.silver_rows(model.transform(rows), f"{prefix}_score", f"{prefix}_explain"), "silver-batch")
        append_rows(silver, root, "silver.features", batch_id, catalog)
        append_rows(facts.transaction_fact(silver, anomaly, critical), root, "gold.TransactionFact", batch_id, catalog)
        append_rows(facts.explain_fact(silver), root, "gold.ExplainFact", batch_id, catalog)


def medallion_sink(root: str, model: ScoringModel, prefix: str,
                   engineer: Callable[[DataFrame], DataFrame] | None = None,
                   catalog: str | None = None, **thresholds) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function. ``engineer`` adds features where the stream has none yet.

    Then every parsed row is landed, also one without an account, which gets no features.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if engineer is None:
            write_batch(batch, batch_id, root, model, prefix, catalog=catalog, **thresholds)
            return
        with owned(batch.sparkSession) as keep:
            rows = keep(batch, "raw-batch")      # features look at the batch more than once
            append_rows(facts.bronze_rows(rows), root, "bronze.transactions", batch_id, catalog)
            write_batch(engineer(valid_events(rows)), batch_id, root, model, prefix, catalog=catalog, landed=True,
                        **thresholds)
    return write


def start_stateful(messages: DataFrame, root: str, checkpoint: str, model: ScoringModel, prefix: str,
                   trigger: dict | None = None, ttl_ms: int | None = None, window: int = WINDOW_ROWS,
                   **options) -> StreamingQuery:
    """Messages -> features with memory across micro-batches -> tables; see ``start_quarantine`` for the rest."""
    engineered = stateful_features(valid_events(parse_json(messages)), ttl_ms, window)
    return _start(engineered, medallion_sink(root, model, prefix, **options), checkpoint, trigger)


def start_memoryless(messages: DataFrame, root: str, checkpoint: str, model: ScoringModel, prefix: str,
                     profile: str = "value_frame", trigger: dict | None = None, **options) -> StreamingQuery:
    """Messages -> features within each micro-batch only -> tables."""
    sink = medallion_sink(root, model, prefix, lambda batch: features(batch, profile), **options)
    parsed = parse_json(messages)
    return _start(parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT), sink, checkpoint, trigger)


def start_quarantine(messages: DataFrame, root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Messages no account's features can be built from, with the reason, under bronze/rejected."""
    writer = (rejected(messages).writeStream.format("parquet").option("path", f"{root}/bronze/rejected")
              .option("checkpointLocation", checkpoint).outputMode("append"))
    return (writer.trigger(**trigger) if trigger else writer).start()


def _start(stream: DataFrame, sink, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(**trigger) if trigger else writer).start()


def refresh_dims(spark: SparkSession, root: str, bootstrap: bool = False, catalog: str | None = None) -> dict:
    """Bring the client and merchant dimensions up to date with silver; ``bootstrap`` also writes the calendar.

    Only batches written since the last refresh are read (``dim_refresh``).
    """
    if bootstrap:
        overwrite_table(dims.time_dim_of(read_table(spark, root, "silver.features")), root, "gold.TimeDim", catalog)
    return dim_refresh.refresh(spark, root, catalog)
