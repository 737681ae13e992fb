"""Experiments: scaling x detector grid, run records, hyper-parameter sweep."""

import json
import math
import random
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.functions.clean import MeanImputer
from ledgerpulse.models.autoencoder import Autoencoder
from ledgerpulse.models.base import Detector, score_all
from ledgerpulse.models.iforest import IsolationForest
from ledgerpulse.models.som import SelfOrganizingMap
from ledgerpulse.operators.evaluate import curve, curve_metrics
from ledgerpulse.operators.features import features
from ledgerpulse.operators.ranking import time_split
from ledgerpulse.operators.scale import METHODS, Scaler
from ledgerpulse.operators.stats import score_distribution
from ledgerpulse.schema import FEATURE_COLS
from ledgerpulse.storage import materialize

ID = "TransactionID"
LABEL = "isAnomaly"
METRICS = ["roc_auc", "pr_auc", "f1", "precision", "recall"]
DISTRIBUTION = ["score_mean", "score_median", "score_std", "score_skew", "score_p95", "score_p99", "tailsep"]
RUN_SCHEMA = ", ".join([
    "Scaling string", "Pipeline string", "params string", "fit_seconds double", "score_seconds double",
    *[f"{m} double" for m in METRICS], *[f"train_{m} double" for m in DISTRIBUTION],
    *[f"val_{m} double" for m in DISTRIBUTION], "error string"])

# name -> (detector, does it read the encoder's latent columns)
PIPELINES = {
    "Standalone/IsolationForest": (IsolationForest, False),
    "Standalone/SOM": (SelfOrganizingMap, False),
    "Standalone/AutoEncoder": (Autoencoder, False),
    "AE+IsolationForest": (IsolationForest, True),
    "AE+SOM": (SelfOrganizingMap, True),
}


def _scores(rows: DataFrame, model: Detector) -> tuple[DataFrame, float]:
    start = time.time()
    kept = [c for c in (ID, LABEL) if c in rows.columns]
    out = materialize(score_all(rows, {"m": model}, explain=False).select(*kept, "m_score"), "scores")
    return out, time.time() - start


def train_run(model: Detector, train: DataFrame) -> dict:
    """Fit, then the score distribution on the training rows (a written table)."""
    start = time.time()
    model.fit(train, ID, written=True)
    seconds = time.time() - start
    stats = score_distribution(_scores(train, model)[0], "m_score").first().asDict()
    return {"fit_seconds": seconds, **{f"train_{k}": v for k, v in stats.items()}}


def eval_run(model: Detector, val: DataFrame) -> dict:
    """Labelled metrics and the score distribution on validation rows."""
    scores, seconds = _scores(val, model)
    metrics = curve_metrics(curve(scores, "m_score", LABEL)).first().asDict()
    stats = score_distribution(scores, "m_score").first().asDict()
    return {"score_seconds": seconds, **{m: metrics[m] for m in METRICS},
            **{f"val_{k}": v for k, v in stats.items()}}


def split_features(txn: DataFrame, profile: str = "expanding", share: float = 0.8,
                   split_first: bool = False) -> tuple[DataFrame, DataFrame]:
    """(train, validation) features. ``split_first`` lets every window start anew at the split."""
    if split_first:
        return tuple(features(part, profile) for part in time_split(txn, share))
    return time_split(materialize(features(txn, profile), "engineered"), share)


def scale_pair(method: str, train: DataFrame, val: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole-table scaling learns on train; scaling with client statistics learns on each part."""
    on_train = Scaler(method).fit(train)
    on_val = Scaler(method).fit(val) if on_train.per_client else on_train
    parts = []
    for tag, scaler, df in (("train", on_train, train), ("val", on_val, val)):
        scaled = scaler.transform(df).select(ID, LABEL, *FEATURE_COLS)
        parts.append(materialize(MeanImputer(FEATURE_COLS).fit(scaled).transform(scaled), f"scaled-{tag}"))
    return parts[0], parts[1]


def experiment_grid(train: DataFrame, val: DataFrame, scalings: list[str] | None = None,
                    params: dict[type, dict] | None = None, parallel: int = 4) -> list[dict]:
    """Every scaling with every pipeline; a cell that fails is recorded and the rest goes on.

    Cells are independent jobs, so ``parallel`` of them share the cluster at a time; so are the scalings with their encoders.
    """
    params = params or {}

    def prepare(scaling: str) -> list[tuple]:
        x_train, x_val = scale_pair(scaling, train, val)
        encoder, coded, failure = None, (x_train, x_val), None
        try:
            encoder = Autoencoder(columns=FEATURE_COLS, **params.get(Autoencoder, {}))
            encoder.fit(x_train, ID, written=True)
            coded = [materialize(encoder.encode(x).select(ID, LABEL, *encoder.latent_columns()), "latent")
                     for x in (x_train, x_val)]
        except Exception as e:      # the cells that read its columns record it
            failure = e
        cells = []
        for name, (detector, latent) in PIPELINES.items():
            columns = encoder.latent_columns() if latent and not failure else FEATURE_COLS
            parts = coded if latent else (x_train, x_val)
            cells.append((scaling, name, detector, columns, parts, encoder if latent else None, failure if latent else None))
        return cells

    def run(cell) -> dict:
        scaling, name, detector, columns, (a, b), extractor, failure = cell
        row = {"Scaling": METHODS[scaling], "Pipeline": name}
        try:
            if failure:
                raise failure
            model = detector(columns=columns, **params.get(detector, {}))
            logged = {**model.params, **({"feature_extractor": extractor.params} if extractor else {})}
            row["params"] = json.dumps(logged)
            return {**row, **train_run(model, a), **eval_run(model, b), "error": None}
        except Exception as e:
            return {**row, "error": f"{type(e).__name__}: {e}"[:500]}

    with ThreadPoolExecutor(parallel) as pool:
        cells = [c for some in pool.map(inheritable_thread_target(prepare), scalings or list(METHODS)) for c in some]
        return list(pool.map(inheritable_thread_target(run), cells))


def runs_frame(spark: SparkSession, runs: list[dict]) -> DataFrame:
    names = [f.strip().split(" ")[0] for f in RUN_SCHEMA.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in runs], RUN_SCHEMA)


def record_runs(spark: SparkSession, runs: list[dict], path: str) -> None:
    """Append run records to the runs table."""
    runs_frame(spark, runs).coalesce(1).write.mode("append").parquet(path)


# Search ranges per detector (a pair is a range, a list a choice).
SPACES: dict[type, dict] = {
    IsolationForest: {"n_estimators": (100, 400), "max_samples": (0.5, 1.0), "contamination": (0.01, 0.1)},
    Autoencoder: {"lr": ("log", 1e-4, 1e-2), "batch_size": [64, 128, 256]},
    SelfOrganizingMap: {"x": (5, 20), "y": (5, 20), "sigma": (0.5, 2.0), "learning_rate": (0.1, 0.8),
                        "passes": (5, 30)},
}


def draw(space: dict, rng: random.Random) -> dict:
    out = {}
    for name, choice in space.items():
        if isinstance(choice, list):
            out[name] = rng.choice(choice)
        elif choice[0] == "log":
            out[name] = choice[1] * (choice[2] / choice[1]) ** rng.random()
        elif isinstance(choice[0], int):
            out[name] = rng.randint(*choice)
        else:
            out[name] = rng.uniform(*choice)
    return out


def sweep(detector: type, train: DataFrame, target: str, direction: str = "maximize", trials: int = 20,
          seed: int = 42, columns: list[str] = FEATURE_COLS, space: dict | None = None,
          fixed: dict | None = None, report: Callable[[dict], None] = lambda row: None) -> list[dict]:
    """Seeded random search for the best value of one score-distribution statistic.

    A trial that fails keeps its error and no value; it and a value that is no number cannot be the best.
    """
    rng = random.Random(seed)
    rows = []
    for trial in range(trials):
        params = {**draw(space or SPACES[detector], rng), **(fixed or {})}
        row = {"trial": trial, "params": json.dumps(params), "value": None}
        try:
            row["value"] = train_run(detector(columns=columns, **params), train)[f"train_{target}"]
        except Exception as e:
            row["params"] = json.dumps({**params, "error": f"{type(e).__name__}: {e}"[:500]})
        report(row)
        rows.append(row)
    valid = [r for r in rows if r["value"] is not None and not math.isnan(r["value"])]
    pick = max if direction == "maximize" else min
    best = pick(valid, key=lambda r: r["value"], default=None)
    return [{**r, "best": r is best} for r in rows]
