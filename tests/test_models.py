import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerpulse.models import autoencoder
from ledgerpulse.models.autoencoder import Autoencoder, Network
from ledgerpulse.models.base import score_all
from ledgerpulse.models import iforest
from ledgerpulse.models.iforest import IsolationForest, unsuccessful_path
from ledgerpulse.models.som import SelfOrganizingMap, neighbourhood, som_pass, winners
from ledgerpulse.models.store import ScoringModel
from ledgerpulse.operators.scale import Scaler
from ledgerpulse.plans import experiments

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    """Two clusters and a few far points, marked in ``isAnomaly``."""
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (600, 3)), rng.normal(6, 1, (600, 3)), rng.normal(0, 1, (12, 3)) + 25])
    pdf = pd.DataFrame(x, columns=COLS)
    pdf["TransactionID"] = [f"{i:05d}" for i in range(len(pdf))]
    pdf["AccountNumber"] = [f"A{i % 9}" for i in range(len(pdf))]
    pdf["isAnomaly"] = (np.arange(len(pdf)) >= 1200).astype(int)
    return spark.createDataFrame(pdf).repartition(4).cache()


def matrix(df):
    return df.orderBy("TransactionID").select(*COLS).toPandas().to_numpy()


def test_som_pass_against_loops(data):
    x = matrix(data)
    book, h = x[:6].copy(), neighbourhood(3, 2, 0.8)
    best = np.array([np.argmin(((book - r) ** 2).sum(axis=1)) for r in x])
    assert (winners(x, book) == best).all()
    want = np.array([sum(h[u, best[i]] * x[i] for i in range(len(x))) / sum(h[u, b] for b in best)
                     for u in range(6)])
    np.testing.assert_allclose(som_pass(data, COLS, book, h), want)


def test_som_gets_closer_and_does_not_depend_on_partitions(data):
    errors, books = [], []
    for passes in (1, 8):
        m = SelfOrganizingMap(COLS, x=4, y=4, passes=passes).fit(data)
        errors.append(m.transform(data).agg(F.avg("som_score")).first()[0])
    assert errors[1] < errors[0]
    for n in (1, 5):
        books.append(SelfOrganizingMap(COLS, x=2, y=2, passes=3).fit(data.repartition(n)).codebook)
    np.testing.assert_allclose(books[0], books[1])


def test_som_with_fewer_rows_than_units(data):
    m = SelfOrganizingMap(COLS, x=5, y=5, passes=1).fit(data.limit(7))
    assert m.codebook.shape == (25, 3)


def path(tree, row):
    node, depth, weight = 0, 0, np.zeros(3)
    while tree[node, 0] >= 0:
        weight[int(tree[node, 0])] += 1 / (depth + 1)
        node = int(tree[node, 2] if row[int(tree[node, 0])] <= tree[node, 1] else tree[node, 3])
        depth += 1
    return depth + float(unsuccessful_path(tree[node, 4])), weight


def test_forest_scores_against_walking_the_trees(data):
    m = IsolationForest(COLS, n_estimators=20, max_samples=64, contamination=0.01).fit(data)
    x = matrix(data)
    score, shares = m.explain_block(x)
    for i in (0, 700, 1205):
        walked = [path(t, x[i]) for t in m.trees]
        raw = 2 ** (-np.mean([d for d, _ in walked]) / float(unsuccessful_path(np.array(64))))
        assert score[i] == pytest.approx(raw + m.offset)
        weight = sum(w for _, w in walked)
        np.testing.assert_allclose(shares[i], weight / (weight.sum() + 1e-8))
    assert (score > 0).sum() == pytest.approx(0.01 * len(x), abs=1)
    assert score[1200:].mean() > score[:1200].mean()
    assert len(m.trees) == 20 and 40 < np.mean([t[0, 4] for t in m.trees]) < 90
    inner = [t[t[:, 0] >= 0] for t in m.trees]
    assert all((t[i[:, 2].astype(int), 4] + t[i[:, 3].astype(int), 4] == i[:, 4]).all() for t, i in zip(m.trees, inner))


def test_forest_does_not_depend_on_partitions(data):
    a, b = (IsolationForest(COLS, n_estimators=5).fit(data.repartition(n)) for n in (1, 6))
    for s, t in zip(a.trees, b.trees):
        np.testing.assert_array_equal(s, t)


def test_forest_sample_sizes():
    m = IsolationForest(COLS)
    assert m._sample_size(10) == 10 and m._sample_size(10 ** 9) == 256
    assert IsolationForest(COLS, max_samples=0.5)._sample_size(1000) == 500
    assert IsolationForest(COLS, max_samples=1.0)._sample_size(10 ** 12) == 10 ** 12
    assert IsolationForest(COLS, max_samples=70_000)._sample_size(10 ** 9) == 70_000


def test_forest_trees_do_not_depend_on_where_they_grow(data, monkeypatch):
    fit = lambda: IsolationForest(COLS, n_estimators=3, max_samples=1.0).fit(data).trees
    alone = fit()
    monkeypatch.setattr(iforest, "GROWN_ALONE", 200)     # the upper levels are split over all tasks
    for a, b in zip(alone, fit(), strict=True):
        np.testing.assert_array_equal(a, b)
    assert all(t[0, 4] == 1212 for t in alone)


@pytest.mark.parametrize("held", [2, 40])
def test_forest_below_its_arrays_is_walked_by_joins(spark, data, tmp_path, held):
    make = lambda **more: IsolationForest(COLS, n_estimators=4, max_samples=0.3, contamination=0.01, **more).fit(data)
    whole, cut = make(), make(max_nodes=held)
    assert not whole.in_table and cut.in_table
    assert sum(len(t) for t in cut.trees) <= max(held, 4) < sum(len(t) for t in whole.trees)
    np.testing.assert_allclose(cut.offset, whole.offset, rtol=1e-12)
    other = SelfOrganizingMap(COLS, x=2, y=2, passes=1).fit(data)
    both = score_all(data, {"w": whole, "c": cut, "s": other}).orderBy("TransactionID").toPandas()
    np.testing.assert_allclose(both["c_score"], both["w_score"], rtol=1e-12)
    for a, b in zip(both["c_explain"], both["w_explain"], strict=True):
        assert a.keys() == b.keys() and np.allclose(list(a.values()), list(b.values()), rtol=1e-12)
    assert (both["s_score"] > 0).any()

    ScoringModel(Scaler("none"), {"if": cut}).save(spark, str(tmp_path / "m"))
    again = ScoringModel.load(spark, str(tmp_path / "m")).transform(data, explain=False).orderBy("TransactionID").toPandas()
    np.testing.assert_allclose(again["if_score"], both["c_score"], rtol=1e-12)
    with pytest.raises(ValueError, match="score_all"):
        cut.score_block(np.zeros((1, 3)))


def test_forest_in_a_table_scores_rows_that_repeat_and_an_empty_table(data):
    forest = IsolationForest(COLS, n_estimators=3, max_nodes=6).fit(data)
    twice = score_all(data.limit(5).union(data.limit(5)), {"f": forest}, explain=False)
    assert twice.count() == 10 and twice.select("f_score").distinct().count() <= 5
    assert score_all(data.where("false"), {"f": forest}).count() == 0


def test_forest_samples_from_a_large_table(spark):
    rows = spark.range(400_000).select(F.col("id").cast("string").alias("_id"), *[F.rand(i).alias(c)
                                       for i, c in enumerate(COLS)])
    m = IsolationForest(COLS, n_estimators=10, max_samples=100)
    m.samples = 100
    sizes = m.samples_per_tree(rows, 400_000).groupBy("tree").count().collect()
    assert sorted(r["tree"] for r in sizes) == list(range(10)) and all(60 < r["count"] < 145 for r in sizes)


def test_autoencoder_gradient_against_differences():
    rng = np.random.default_rng(2)
    net = Network(5, 3)
    w, x = net.start(0) + rng.normal(0, 0.1, net.size), rng.normal(size=(7, 5))

    def loss(v):
        return ((net.forward(v, x)[-1] - x) ** 2).mean()

    got = net.gradient(w, x)
    for i in rng.choice(net.size, 40, replace=False):
        step = np.zeros(net.size)
        step[i] = 1e-6
        assert got[i] == pytest.approx((loss(w + step) - loss(w - step)) / 2e-6, abs=1e-6)


def test_autoencoder_learns_and_encodes(data):
    m = Autoencoder(COLS, latent=2, epochs=6, lr=0.01).fit(data)
    assert m.losses[-1] < m.losses[0]
    x = matrix(data)
    hidden = m.network.forward(m.weights, x)
    np.testing.assert_allclose(m.explain_block(x)[0], ((x - hidden[-1]) ** 2).mean(axis=1))
    coded = m.encode(data).orderBy("TransactionID").select("z0", "z1").toPandas().to_numpy()
    np.testing.assert_allclose(coded, hidden[2])


def test_autoencoder_is_one_model_on_any_number_of_tasks(data, monkeypatch):
    """One task and six, and other input partitions, give the same weights and losses."""
    one = Autoencoder(COLS, latent=2, epochs=2, lr=0.01, batch_size=32).fit(data.repartition(1))
    n = data.count()
    monkeypatch.setattr(autoencoder, "TASK_ROWS", n // 8)
    many = Autoencoder(COLS, latent=2, epochs=2, lr=0.01, batch_size=32).fit(data.repartition(6))
    assert n > 100 and not np.array_equal(one.weights, Network(len(COLS), 2).start(42))
    np.testing.assert_allclose(many.weights, one.weights, rtol=1e-6, atol=1e-9)
    np.testing.assert_allclose(many.losses, one.losses, rtol=1e-6)


def plain_training(m, x, ids, spark, batch_size, epochs):
    """The same training step by step, by the plain rules; (weights, moments, steps) after the last epoch."""
    ids = spark.createDataFrame([(i,) for i in ids], "id string")
    hashes = ids.select(*[F.xxhash64("id", F.lit(42), F.lit(e)).alias(f"e{e}") for e in range(epochs)],
                        F.pmod(F.xxhash64("id", F.lit(42)), F.lit(10_000)).alias("share")).toPandas()
    net, train = m.network, (hashes["share"] >= 1000).to_numpy()
    batches = -(-train.sum() // batch_size)
    w, t = net.start(42), 0
    a, b, losses = np.zeros_like(w), np.zeros_like(w), []
    for e in range(epochs + 1):
        losses.append(((net.forward(w, x[~train])[-1] - x[~train]) ** 2).mean())
        for batch in range(batches) if e < epochs else ():
            t += 1
            part = x[train & (hashes[f"e{e}"] % batches == batch).to_numpy()]
            if len(part):
                seen, layers, g = net.forward(w, part), net.layers(w), []
                d = 2 * (seen[-1] - part) / x.shape[1] / len(part)
                for i in reversed(range(len(layers))):
                    g = [(seen[i].T @ d).ravel(), d.sum(axis=0), *g]
                    d = (d @ layers[i][0].T) * (seen[i] > 0)
                g = np.concatenate(g)
                a, b = 0.9 * a + 0.1 * g, 0.999 * b + 0.001 * g * g
                w = w - 0.01 * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t) * a / (np.sqrt(b) + 1e-7)
    return w, losses


@pytest.mark.parametrize("held", [autoencoder.HELD_BYTES, 3000])
def test_autoencoder_takes_the_steps_of_plain_training(spark, data, monkeypatch, held):
    """In one task, with its rows in memory and in files that are split by batch; every job of the fit is counted."""
    ids = [f"{i:05d}" for i in range(data.count())]
    m = Autoencoder(COLS, latent=2, epochs=3, lr=0.01, batch_size=32)
    want, losses = plain_training(m, matrix(data), ids, spark, 32, 3)
    monkeypatch.setattr(autoencoder, "HELD_BYTES", held)
    jobs, run = [], Autoencoder._alone
    monkeypatch.setattr(Autoencoder, "_alone", lambda *args: jobs.append(args[3]) or run(*args))
    m.fit(data)
    np.testing.assert_allclose(m.losses, losses, rtol=1e-6)
    np.testing.assert_allclose(m.weights, want, rtol=1e-6, atol=1e-9)
    assert jobs == [range(0, 4)]


def test_autoencoder_rows_beyond_a_tasks_rows_need_no_exchange(data, monkeypatch):
    """Batches of few rows are no work for several tasks, however many rows there are; a second for each batch was lost so."""
    monkeypatch.setattr(autoencoder, "TASK_ROWS", 100)
    monkeypatch.setattr(Autoencoder, "_together", None)
    assert len(Autoencoder(COLS, latent=2, epochs=2, batch_size=8).fit(data).losses) == 3


def test_autoencoder_of_large_batches_on_several_tasks(data, monkeypatch):
    make = lambda: Autoencoder(COLS, latent=2, epochs=2, lr=0.01, batch_size=400).fit(data)
    one = make()
    monkeypatch.setattr(autoencoder, "TASK_ROWS", 100)
    monkeypatch.setattr(Autoencoder, "_alone", None)
    many = make()
    np.testing.assert_allclose(many.weights, one.weights, rtol=1e-6, atol=1e-9)
    np.testing.assert_allclose(many.losses, one.losses, rtol=1e-6)


def test_autoencoder_stops_after_the_same_passes(data, monkeypatch):
    """A job runs only passes that are sure to be needed."""
    asked, run = [], Autoencoder._alone
    monkeypatch.setattr(Autoencoder, "_alone", lambda *args: asked.extend(args[3]) or run(*args))
    monkeypatch.setattr(autoencoder, "PATIENCE", 2)
    m = Autoencoder(COLS, latent=2, epochs=60, lr=0.5, batch_size=32).fit(data)
    best = int(np.argmin(m.losses[1:])) + 1
    assert asked == list(range(len(m.losses))) and best + 3 == len(m.losses) < 61


def test_hashes_go_on_as_in_spark(spark):
    ids = spark.createDataFrame([(None,), ("",), ("a",), ("0017",)], "id string")
    for value in (0, 7, 2 ** 31 - 1, -5):
        r = ids.select(F.xxhash64("id", F.lit(3)).alias("a"), F.xxhash64("id", F.lit(3), F.lit(value)).alias("b")).toPandas()
        assert (autoencoder.hashed_on(r["a"].to_numpy(), value) == r["b"].to_numpy()).all()


def test_autoencoder_without_held_out_rows_keeps_what_it_learned(data):
    m = Autoencoder(COLS, latent=2, epochs=4, lr=0.01, validation_split=0.0).fit(data)
    start = m.network.start(42)
    x = matrix(data)
    error = lambda w: ((m.network.forward(w, x)[-1] - x) ** 2).mean()
    assert all(np.isnan(v) for v in m.losses) and error(m.weights) < error(start)
    with pytest.raises(ValueError, match="diverged"):
        Autoencoder(COLS, latent=2, epochs=2, lr=1e200, validation_split=0.0).fit(data)


def test_explanations_add_up(data):
    models = {"s": SelfOrganizingMap(COLS, x=2, y=2, passes=1).fit(data),
              "f": IsolationForest(COLS, n_estimators=5).fit(data),
              "e": Autoencoder(COLS, epochs=1).fit(data)}
    for r in score_all(data, models).collect():
        for p in models:
            assert set(r[f"{p}_explain"]) == set(COLS)
            assert sum(r[f"{p}_explain"].values()) == pytest.approx(1, abs=1e-4)


def test_missing_inputs_count_as_zero(spark, data):
    m = SelfOrganizingMap(COLS, x=2, y=2, passes=1).fit(data)
    rows = spark.createDataFrame([("1", None, float("nan"), float("inf")), ("2", 0.0, 0.0, 0.0)],
                                 "TransactionID string, a double, b double, c double")
    scores = [r["som_score"] for r in m.transform(rows).orderBy("TransactionID").collect()]
    assert scores[0] == scores[1]


def test_columns_go_by_name_and_bundle_survives_saving(spark, data, tmp_path):
    bundle = ScoringModel(Scaler("global_standard_client_standard", ["a"], ["b", "c"]), {
        "som": SelfOrganizingMap(COLS, x=2, y=2, passes=1), "if": IsolationForest(COLS, n_estimators=3),
        "ae": Autoencoder(COLS, epochs=1)}).fit(data)
    bundle.save(spark, str(tmp_path / "m"))
    shuffled = data.select("isAnomaly", "c", "TransactionID", "a", "AccountNumber", "b")
    names = ["som_score", "if_score", "ae_score"]
    want = bundle.transform(data).orderBy("TransactionID").select(*names, "a").collect()
    got = ScoringModel.load(spark, str(tmp_path / "m")).transform(shuffled)
    assert got.orderBy("TransactionID").select(*names, "a").collect() == want


def test_a_failing_model_fails_the_job(data):
    unfitted = SelfOrganizingMap(COLS)
    with pytest.raises(Exception, match="TypeError"):
        unfitted.transform(data).collect()


def test_grid_records_failures_and_goes_on(spark, data, monkeypatch):
    monkeypatch.setattr(experiments, "FEATURE_COLS", COLS)
    monkeypatch.setattr(experiments, "Scaler", lambda m: Scaler(m, COLS, []))
    small = {IsolationForest: {"n_estimators": 5}, Autoencoder: {"epochs": 1, "latent": 2},
             SelfOrganizingMap: {"x": -1, "y": 2}}
    runs = experiments.experiment_grid(data, data, ["none"], small)
    assert [r["Pipeline"] for r in runs] == list(experiments.PIPELINES)
    failed = {r["Pipeline"] for r in runs if r["error"]}
    assert failed == {"Standalone/SOM", "AE+SOM"}
    good = next(r for r in runs if r["Pipeline"] == "Standalone/IsolationForest")
    assert good["roc_auc"] > 0.9 and good["score_seconds"] > 0 and "train_tailsep" in good
    assert experiments.runs_frame(spark, runs).count() == 5


def test_grid_prepares_its_scalings_at_the_same_time(data, monkeypatch):
    monkeypatch.setattr(experiments, "FEATURE_COLS", COLS)
    monkeypatch.setattr(experiments, "PIPELINES", {"Standalone/SOM": (SelfOrganizingMap, False)})
    both = threading.Barrier(2)
    monkeypatch.setattr(experiments, "scale_pair", lambda method, *parts: both.wait(60) is None or parts)
    runs = experiments.experiment_grid(data, data, ["none", "global_minmax"], {
        SelfOrganizingMap: {"x": 2, "y": 2, "passes": 1}, Autoencoder: {"epochs": 0, "latent": 2}})
    assert [r["Scaling"] for r in runs] == [experiments.METHODS[m] for m in ("none", "global_minmax")]
    assert all(r["error"] is None for r in runs)


def test_detectors_of_a_bundle_fit_at_the_same_time(data):
    both = threading.Barrier(2)

    class Waiting(SelfOrganizingMap):
        def fit(self, *args, **kwargs):
            both.wait(60)
            return super().fit(*args, **kwargs)

    make = lambda kind: {f"s{n}": kind(COLS, x=n, y=1, passes=2) for n in (2, 3)}
    together, alone = make(Waiting), make(SelfOrganizingMap)
    ScoringModel(Scaler("none"), together).fit(data)
    for name, model in alone.items():
        np.testing.assert_allclose(together[name].codebook, model.fit(data).codebook)

    class Failing(SelfOrganizingMap):
        def fit(self, *args, **kwargs):
            raise ValueError("no fit")

    with pytest.raises(ValueError, match="no fit"):
        ScoringModel(Scaler("none"), {"a": SelfOrganizingMap(COLS, x=2, y=1, passes=1), "b": Failing(COLS)}).fit(data)


def test_sweep_is_seeded_and_picks_the_best(data):
    args = dict(detector=SelfOrganizingMap, train=data, target="score_mean", direction="minimize",
                trials=2, columns=COLS, fixed={"passes": 1})
    a, b = experiments.sweep(**args), experiments.sweep(**args)
    assert a == b and sum(r["best"] for r in a) == 1
    assert min(a, key=lambda r: r["value"])["best"]
