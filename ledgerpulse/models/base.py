"""What every detector offers, and how any mix of them scores a DataFrame in one Arrow pass."""

import json
import pickle
from abc import ABC, abstractmethod
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerpulse.functions.clean import finite
from ledgerpulse.schema import FEATURE_COLS
from ledgerpulse.storage import materialize


class Detector(ABC):
    """An unsupervised detector; a higher score is more anomalous.

    ``fit`` runs as Spark jobs. What it learns is a few small arrays, so scoring is a vectorised
    function of a block of rows.
    """

    name = "detector"

    def __init__(self, columns: list[str] = FEATURE_COLS, **params):
        self.columns = list(columns)
        self.params = params

    @abstractmethod
    def fit(self, df: DataFrame, id_col: str = "TransactionID", written: bool = False) -> "Detector":
        """Learn from all rows of ``df``; ``written`` says that reading it again costs only a scan."""

    def training_rows(self, df: DataFrame, id_col: str, written: bool) -> DataFrame:
        """``_id`` and the model inputs, in a form that many passes can read."""
        rows = df.select(F.col(id_col).alias("_id"), *inputs(df, self.columns))
        return rows if written else materialize(rows, f"{self.name}-rows")

    @abstractmethod
    def explain_block(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, share of each column) for a block of rows."""

    def score_block(self, x: np.ndarray) -> np.ndarray:
        return self.explain_block(x)[0]

    def transform(self, df: DataFrame, prefix: str | None = None, explain: bool = True) -> DataFrame:
        return score_all(df, {prefix or self.name: self}, explain)

    @abstractmethod
    def arrays(self) -> dict[str, np.ndarray]:
        """Learned state as named matrices."""

    @abstractmethod
    def restore(self, arrays: dict[str, np.ndarray]) -> None:
        """Inverse of ``arrays``."""

    @property
    def in_table(self) -> bool:
        """Whether a part of the model is a table, so that a block of rows alone cannot be scored to the end."""
        return False

    def open_block(self, x: np.ndarray, explain: bool) -> tuple[np.ndarray, np.ndarray | None, list, list]:
        """What the arrays give for a block of rows (length, weight), and per row the places in the table to go on from."""
        raise NotImplementedError

    def finished(self, rows: DataFrame, explain: bool) -> DataFrame:
        """(_row, score, share) from the rows of ``open_block``: _row, x, length, weight, trees, nodes."""
        raise NotImplementedError

    def load_tables(self, spark: SparkSession, path: str) -> None:
        """Find the tables saved beside the arrays."""

    def save(self, spark: SparkSession, path: str) -> None:
        """Model tables: the matrices row by row, and one row that describes the model."""
        rows = [(part, i, [float(v) for v in row])
                for part, m in self.arrays().items() for i, row in enumerate(np.atleast_2d(m))]
        meta = [(self.name, json.dumps(self.columns), json.dumps(self.params))]
        (spark.createDataFrame(rows, "part string, row int, values array<double>").coalesce(1)
         .write.mode("overwrite").parquet(f"{path}/arrays"))
        (spark.createDataFrame(meta, "name string, columns string, params string").coalesce(1)
         .write.mode("overwrite").parquet(f"{path}/meta"))


def inputs(df: DataFrame, columns: list[str], suffix: str = "") -> list:
    """Model inputs by name: doubles, with missing and infinite values as 0."""
    return [F.coalesce(finite(f"{c}{suffix}"), F.lit(0.0)).alias(c) for c in columns]


def share(amounts: np.ndarray) -> np.ndarray:
    return amounts / (amounts.sum(axis=1, keepdims=True) + 1e-8)


def fit_all(rows: DataFrame, models: Iterable[Detector], id_col: str = "TransactionID") -> None:
    """Fit detectors on a written table at the same time: their jobs do not depend on each other."""
    models = list(models)
    with ThreadPoolExecutor(max(1, len(models))) as pool:
        list(pool.map(inheritable_thread_target(rows.sparkSession)(lambda m: m.fit(rows, id_col, written=True)), models))


def score_all(df: DataFrame, models: dict[str, Detector], explain: bool = True,
              suffix: str = "") -> DataFrame:
    """Adds ``<prefix>_score`` and ``<prefix>_explain`` of every model, from one Python pass.

    A failing model fails the job: a default score would read as a normal transaction. If a part of a model
    is a table, the rows are written after that pass, numbered, and finished by the model's own joins.
    """
    columns = list(dict.fromkeys(c for m in models.values() for c in m.columns))
    places = {p: [columns.index(c) for c in m.columns] for p, m in models.items()}
    fields = []
    for p in models:
        fields.append(T.StructField(f"{p}_score", T.DoubleType()))
        if explain:
            fields.append(T.StructField(f"{p}_share", T.ArrayType(T.DoubleType())))
        if models[p].in_table:
            fields += [T.StructField(f"{p}_{c}", T.ArrayType(T.LongType())) for c in ("trees", "nodes")]
    shipped = df.sparkSession.sparkContext.broadcast(pickle.dumps(models))

    @F.pandas_udf(T.StructType(fields))
    def run(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        local = pickle.loads(shipped.value)
        for block in blocks:
            x = block.to_numpy(dtype=float)
            out = {}
            for p, m in local.items():
                if m.in_table:
                    out[f"{p}_score"], shares, out[f"{p}_trees"], out[f"{p}_nodes"] = m.open_block(x[:, places[p]], explain)
                    out |= {f"{p}_share": list(shares)} if explain else {}
                elif explain:
                    out[f"{p}_score"], shares = m.explain_block(x[:, places[p]])
                    out[f"{p}_share"] = list(shares)
                else:
                    out[f"{p}_score"] = m.score_block(x[:, places[p]])
            yield pd.DataFrame(out)[[f.name for f in fields]]

    scored = df.withColumn("_scores", run(F.struct(*inputs(df, columns, suffix))))
    if any(m.in_table for m in models.values()):
        scored = _finished(scored, models, explain, suffix)
    out = {}
    for p, m in models.items():
        out[f"{p}_score"] = F.col(f"_scores.{p}_score")
        if explain:
            names = F.array(*[F.lit(c) for c in m.columns])
            out[f"{p}_explain"] = F.map_from_arrays(names, F.col(f"_scores.{p}_share"))
    return scored.withColumns(out).drop("_scores")


def _finished(scored: DataFrame, models: dict[str, Detector], explain: bool, suffix: str) -> DataFrame:
    """``scored`` with the ``_scores`` of models in tables taken to their end."""
    scored = materialize(scored.withColumn("_row", F.monotonically_increasing_id()), "open-rows")
    scores = {c: F.col(f"_scores.{c}") for c in scored.schema["_scores"].dataType.names}
    out = scored
    for p, m in models.items():
        if not m.in_table:
            continue
        rows = scored.select("_row", F.array(*inputs(scored, m.columns, suffix)).alias("x"), scores[f"{p}_score"].alias("length"),
                             *([scores[f"{p}_share"].alias("weight")] if explain else []),
                             scores.pop(f"{p}_trees").alias("trees"), scores.pop(f"{p}_nodes").alias("nodes"))
        ends = m.finished(rows, explain).withColumnsRenamed({"score": f"_{p}_score", "share": f"_{p}_share"})
        out = out.join(ends, "_row")
        scores |= {c: F.col(f"_{c}") for c in (f"{p}_score", f"{p}_share") if f"_{c}" in ends.columns}
    return out.select(*[F.col(f"`{c}`") for c in scored.columns if c not in ("_row", "_scores")],
                      F.struct(*[c.alias(name) for name, c in scores.items()]).alias("_scores"))
