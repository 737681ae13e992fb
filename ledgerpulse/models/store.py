"""Reading saved models back, alone or as a bundle with the scaling they were trained on."""

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.models.autoencoder import Autoencoder
from ledgerpulse.models.base import Detector, fit_all, score_all
from ledgerpulse.models.iforest import IsolationForest
from ledgerpulse.models.som import SelfOrganizingMap
from ledgerpulse.operators.scale import Scaler
from ledgerpulse.storage import materialize

DETECTORS = {c.name: c for c in (IsolationForest, SelfOrganizingMap, Autoencoder)}
SCALED = "__scaled"


def load_model(spark: SparkSession, path: str) -> Detector:
    meta = spark.read.parquet(f"{path}/meta").first()
    model = DETECTORS[meta["name"]](columns=json.loads(meta["columns"]), **json.loads(meta["params"]))
    rows = spark.read.parquet(f"{path}/arrays").orderBy("part", "row").collect()
    parts: dict[str, list] = {}
    for r in rows:
        parts.setdefault(r["part"], []).append(r["values"])
    model.restore({k: np.array(v) for k, v in parts.items()})
    model.load_tables(spark, path)
    return model


@dataclass
class ScoringModel:
    """Detectors together with the scaler of their training rows; columns go by name."""

    scaler: Scaler = field(default_factory=Scaler)
    detectors: dict[str, Detector] = field(default_factory=dict)

    def fit(self, df: DataFrame, id_col: str = "TransactionID") -> "ScoringModel":
        columns = dict.fromkeys(c for d in self.detectors.values() for c in d.columns)
        scaled = self.scaler.fit(df).transform(df).select(id_col, *columns)
        rows = materialize(scaled, "training-rows")
        fit_all(rows, self.detectors.values(), id_col)
        return self

    def transform(self, df: DataFrame, explain: bool = True) -> DataFrame:
        """Raw columns stay; scores and explanations of all detectors are added."""
        columns = {c for d in self.detectors.values() for c in d.columns}
        rows = self.scaler.transform(df, SCALED)
        rows = rows.withColumns({f"{c}{SCALED}": F.col(c) for c in columns
                                 if f"{c}{SCALED}" not in rows.columns})
        out = score_all(rows, self.detectors, explain, SCALED)
        return out.drop(*[c for c in out.columns if c.endswith(SCALED)])

    def save(self, spark: SparkSession, path: str) -> None:
        for prefix, detector in self.detectors.items():
            detector.save(spark, f"{path}/{prefix}")
        s = self.scaler
        meta = json.dumps({"method": s.method, "global_cols": s.global_cols, "client_cols": s.client_cols,
                           "key": s.key, "centers": s.centers, "detectors": list(self.detectors)})
        (spark.createDataFrame([(meta,)], "meta string").coalesce(1)
         .write.mode("overwrite").parquet(f"{path}/scaler"))
        if s.clients is not None:
            s.clients.write.mode("overwrite").parquet(f"{path}/clients")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ScoringModel":
        meta = json.loads(spark.read.parquet(f"{path}/scaler").first()["meta"])
        scaler = Scaler(meta["method"], meta["global_cols"], meta["client_cols"], meta["key"])
        scaler.centers = {c: tuple(v) for c, v in meta["centers"].items()}
        if scaler.client_cols:
            scaler.clients = spark.read.parquet(f"{path}/clients")
        return cls(scaler, {p: load_model(spark, f"{path}/{p}") for p in meta["detectors"]})
