"""Registered queries around detectors and experiments."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.models.autoencoder import Autoencoder
from ledgerpulse.models.base import fit_all, score_all
from ledgerpulse.models.iforest import IsolationForest
from ledgerpulse.models.som import SelfOrganizingMap, neighbourhood, som_pass
from ledgerpulse.models.store import ScoringModel
from ledgerpulse.operators.evaluate import blend
from ledgerpulse.operators.features import features
from ledgerpulse.operators.scale import Scaler, minmax_columns
from ledgerpulse.plans import experiments
from ledgerpulse.plans.queries import ID, query
from ledgerpulse.schema import FEATURE_COLS
from ledgerpulse.sources.events import read_events
from ledgerpulse.storage import materialize, scratch_path

CELLS = (5, 2)          # ten prototypes, one per embedding label
SIGMA = 0.8
WIDTH = 64
SAMPLE_COLS = [f"e{i}" for i in range(WIDTH)]

# The settings the detectors are trained with.
FOREST = {"n_estimators": 100, "contamination": 0.01}
MAP = {"x": 20, "y": 20, "passes": 10}
CODER = {"latent": 4, "epochs": 50}
# Small ones for the grid, which trains 30 detectors.
GRID = {IsolationForest: {**FOREST, "n_estimators": 50}, SelfOrganizingMap: {"x": 6, "y": 6, "passes": 3},
        Autoencoder: {**CODER, "epochs": 3}}


def engineered(spark, sf_dir, scaling: str = "global_standard") -> DataFrame:
    df = materialize(features(read_events(spark, sf_dir), "trailing"), "engineered")
    return materialize(Scaler(scaling).fit(df).transform(df), "model-input")


def _exploded(df: DataFrame, column: str, id_col: str = ID) -> DataFrame:
    return df.select(id_col, F.explode(column).alias("feature", "value"))


# --- embeddings as samples, label means as prototypes: exact in SQL -----------------------

def samples(spark, sf_dir) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vectors.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c)
                                               for i, c in enumerate(SAMPLE_COLS)])


def label_means(rows: DataFrame) -> np.ndarray:
    """One prototype per label, in label order."""
    means = rows.groupBy("label").agg(*[F.avg(c).alias(c) for c in SAMPLE_COLS]).orderBy("label")
    book = means.limit(CELLS[0] * CELLS[1] + 1).toPandas()[SAMPLE_COLS].to_numpy()
    if len(book) != CELLS[0] * CELLS[1]:
        raise ValueError(f"expected {CELLS[0] * CELLS[1]} labels")
    return book


def _fixed_map(rows: DataFrame) -> SelfOrganizingMap:
    model = SelfOrganizingMap(SAMPLE_COLS, x=CELLS[0], y=CELLS[1], sigma=SIGMA)
    model.codebook = label_means(rows)
    return model


@query
def som_score(spark, sf_dir):
    rows = samples(spark, sf_dir)
    return _fixed_map(rows).transform(rows, explain=False).select("vec_id", F.col("som_score").alias("score"))


@query
def som_explain(spark, sf_dir):
    rows = samples(spark, sf_dir)
    return _exploded(_fixed_map(rows).transform(rows), "som_explain", "vec_id")


@query
def som_epoch(spark, sf_dir):
    rows = samples(spark, sf_dir)
    after = som_pass(rows, SAMPLE_COLS, label_means(rows), neighbourhood(*CELLS, SIGMA))
    return spark.createDataFrame(
        [(u, j, float(v)) for u, row in enumerate(after) for j, v in enumerate(row)],
        "unit int, position int, weight double")


# --- detectors with weights given by a rule: scoring and explaining are exact in SQL -------

RULE_TREES = 5


def rule_autoencoder() -> Autoencoder:
    """Weight (((31 i + 17 j + 7 layer) mod 13) - 6) / 20, bias ((j mod 5) - 2) / 10."""
    model = Autoencoder(SAMPLE_COLS, latent=6)
    parts = []
    for layer, (n_in, n_out) in enumerate(model.network.shapes):
        i, j = np.arange(n_in)[:, None], np.arange(n_out)[None, :]
        parts += [(((31 * i + 17 * j + 7 * layer) % 13 - 6) / 20.0).ravel(), (np.arange(n_out) % 5 - 2) / 10.0]
    model.weights = np.concatenate(parts)
    return model


def rule_forest() -> IsolationForest:
    """Tree t splits on columns 3t, then 3t + 1 or 3t + 2; leaves hold 100, 60, 1 and 95 rows."""
    model = IsolationForest(SAMPLE_COLS, n_estimators=RULE_TREES)
    model.samples, model.offset = 256, -0.5
    leaf = [-1, 0, -1, -1]
    model.trees = [np.array([
        [3 * t % WIDTH, 0.0, 1, 4, 256],
        [(3 * t + 1) % WIDTH, 0.05, 2, 3, 160], [*leaf, 100], [*leaf, 60],
        [(3 * t + 2) % WIDTH, -0.05, 5, 6, 96], [*leaf, 1], [*leaf, 95]], dtype=float)
        for t in range(RULE_TREES)]
    return model


@query
def ae_encode_rule(spark, sf_dir):
    model = rule_autoencoder()
    return model.encode(samples(spark, sf_dir)).select("vec_id", *model.latent_columns())


@query
def ae_explain_rule(spark, sf_dir):
    return _exploded(rule_autoencoder().transform(samples(spark, sf_dir)), "ae_explain", "vec_id")


@query
def iforest_explain_rule(spark, sf_dir):
    return _exploded(rule_forest().transform(samples(spark, sf_dir)), "if_explain", "vec_id")


@query
def ensemble_score_rule(spark, sf_dir):
    """All three detectors in one pass over the rows."""
    rows = samples(spark, sf_dir)
    models = {"if": rule_forest(), "ae": rule_autoencoder(), "som": _fixed_map(rows)}
    return score_all(rows, models).select("vec_id", *[f"{p}_score" for p in models])


# --- detectors on transaction features ----------------------------------------------------

@query
def som_fit(spark, sf_dir):
    book = SelfOrganizingMap(**MAP).fit(engineered(spark, sf_dir), written=True).codebook
    return spark.createDataFrame([(u, c, float(v)) for u, row in enumerate(book)
                                  for c, v in zip(FEATURE_COLS, row)],
                                 "unit int, feature string, weight double")


@query
def iforest_fit(spark, sf_dir):
    """The learned trees, a row for each node."""
    trees = IsolationForest(**FOREST).fit(engineered(spark, sf_dir), written=True).trees
    return spark.createDataFrame(
        [(i, k, int(n[0]), float(n[1]), int(n[2]), int(n[3]), int(n[4])) for i, t in enumerate(trees)
         for k, n in enumerate(t)],
        "tree int, node int, feature int, threshold double, left int, right int, n int")


def _fitted(spark, sf_dir, model):
    rows = engineered(spark, sf_dir)
    return model.fit(rows, written=True).transform(rows, "m")


@query
def iforest_score(spark, sf_dir):
    return _fitted(spark, sf_dir, IsolationForest(**FOREST)).select(ID, F.col("m_score").alias("score"))


@query
def iforest_explain(spark, sf_dir):
    return _exploded(_fitted(spark, sf_dir, IsolationForest(**FOREST)), "m_explain")


@query
def ae_fit(spark, sf_dir):
    weights = Autoencoder(**CODER).fit(engineered(spark, sf_dir), written=True).weights
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(weights)], "i int, weight double")


@query
def ae_score(spark, sf_dir):
    return _fitted(spark, sf_dir, Autoencoder(**CODER)).select(ID, F.col("m_score").alias("score"))


@query
def ae_explain(spark, sf_dir):
    return _exploded(_fitted(spark, sf_dir, Autoencoder(**CODER)), "m_explain")


@query
def ae_encode(spark, sf_dir):
    rows = engineered(spark, sf_dir)
    coder = Autoencoder(**CODER).fit(rows, written=True)
    return coder.encode(rows).select(ID, *coder.latent_columns())


@query
def meta_detector(spark, sf_dir):
    rows = engineered(spark, sf_dir)
    coder = Autoencoder(**CODER).fit(rows, written=True)
    coded = materialize(coder.encode(rows).select(ID, *coder.latent_columns()), "latent")
    models = {"ae_if": IsolationForest(coder.latent_columns(), **FOREST),
              "ae_som": SelfOrganizingMap(coder.latent_columns(), **MAP)}
    fit_all(coded, models.values())
    return score_all(coded, models, explain=False).select(ID, "ae_if_score", "ae_som_score")


def _ensemble(spark, sf_dir) -> tuple[ScoringModel, DataFrame]:
    df = materialize(features(read_events(spark, sf_dir), "trailing"), "engineered")
    model = ScoringModel(Scaler("global_standard"), {
        "if": IsolationForest(**FOREST), "ae": Autoencoder(**CODER), "som": SelfOrganizingMap(**MAP)})
    return model.fit(df), df


@query
def ensemble_score(spark, sf_dir):
    model, df = _ensemble(spark, sf_dir)
    scores = materialize(model.transform(df, explain=False)
                         .select(ID, "if_score", "ae_score", "som_score"), "ensemble")
    unit = minmax_columns(scores, ["if_score", "ae_score", "som_score"])
    return blend(unit, {"som_score": 0.65, "ae_score": 0.35, "if_score": 0.0})


@query
def model_roundtrip(spark, sf_dir):
    df = materialize(features(read_events(spark, sf_dir), "trailing"), "engineered")
    path = scratch_path(spark, "model")
    model = ScoringModel(Scaler("global_standard_client_standard"), {"som": SelfOrganizingMap(**MAP)}).fit(df)
    model.save(spark, path)
    before = model.transform(df, explain=False).select(ID, F.col("som_score").alias("saved"))
    after = ScoringModel.load(spark, path).transform(df, explain=False)
    return (after.select(ID, F.col("som_score").alias("loaded")).join(before, ID)
            .select(ID, (F.col("saved") == F.col("loaded")).alias("same")))


# --- experiments --------------------------------------------------------------------------

@query
def experiment_grid(spark, sf_dir):
    """All five scalings with all five pipelines."""
    train, val = experiments.split_features(read_events(spark, sf_dir), "expanding")
    runs = experiments.experiment_grid(train, val, None, GRID)
    return experiments.runs_frame(spark, runs).drop("fit_seconds", "score_seconds")


@query
def sweep(spark, sf_dir):
    rows = experiments.sweep(SelfOrganizingMap, engineered(spark, sf_dir), "tailsep", trials=3)
    return spark.createDataFrame(rows, "trial int, params string, value double, best boolean")


