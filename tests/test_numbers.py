"""Quantiles, running totals, curves, histograms and scaling against plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerpulse.functions.clean import MeanImputer, fill_zero
from ledgerpulse.operators.evaluate import (curve, curve_metrics, ensemble_search, exact_areas, percentile_metrics,
                                            weight_grid)
from ledgerpulse.operators.prefix import running_totals
from ledgerpulse.operators.quantiles import exact_quantiles, group_quantiles, value_ranks
from ledgerpulse.operators.scale import Scaler
from ledgerpulse.operators.stats import box_stats, histogram, stratified_sample

PROBS = [0.0, 0.001, 0.25, 0.5, 0.9, 0.95, 0.999, 1.0]


def frame(spark, **columns):
    import pandas as pd
    return spark.createDataFrame(pd.DataFrame(columns))


@pytest.mark.parametrize("values", [10 ** 6, 1])
def test_exact_quantiles(spark, values):
    rng = np.random.default_rng(3)
    cols = {"normal": rng.normal(size=30_000), "few": rng.integers(0, 4, 30_000).astype(float),
            "third": np.where(rng.random(30_000) < 0.34, 7.0, rng.exponential(size=30_000)),
            "same": np.full(30_000, 2.5)}
    df = frame(spark, **cols).repartition(5)
    got = exact_quantiles(df, {c: F.col(c) for c in cols}, PROBS, values=values)
    for c, x in cols.items():
        for p in PROBS:
            assert got[c, p] == pytest.approx(np.percentile(x, 100 * p), abs=1e-12), (c, p)


def test_quantiles_of_heavy_columns(spark):
    rng = np.random.default_rng(7)
    cols = {"sixty": np.where(rng.random(20_000) < 0.6, 0.0, rng.normal(size=20_000)),
            "tail": np.exp(rng.normal(0, 40, 20_000)), "wide": rng.choice([-1.7e308, -1.0, 0.5, 1.7e308], 20_000),
            "endless": np.where(rng.random(20_000) < 0.3, -np.inf, rng.exponential(size=20_000))}
    df = frame(spark, **cols).repartition(4)
    probs = [0.0, 0.31, 0.5, 0.6, 0.97]
    got = exact_quantiles(df, {c: F.col(c) for c in cols}, probs, values=1)
    for c, x in cols.items():
        for p in probs:
            below = np.sort(x)[int(p * (len(x) - 1))]
            want = below if np.isinf(below) else np.percentile(x, 100 * p)
            assert got[c, p] == pytest.approx(want, rel=1e-12), (c, p)


def test_quantiles_skip_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert exact_quantiles(df, {"x": F.col("x")}, [0.5])["x", 0.5] == 2.0
    assert exact_quantiles(df.limit(0), {"x": F.col("x")}, [0.5])["x", 0.5] is None


def test_group_quantiles_with_one_large_group(spark):
    rng = np.random.default_rng(4)
    g, x = np.where(rng.random(6000) < 0.4, 0, rng.integers(1, 30, 6000)), rng.normal(size=6000).round(2)
    ranks = value_ranks(frame(spark, g=g, x=x), ["g"], "x")
    got = {r["g"]: r for r in group_quantiles(ranks, ["g"], "x", {"a": 0.25, "b": 0.9}).collect()}
    for k in np.unique(g):
        assert got[k]["a"] == pytest.approx(np.percentile(x[g == k], 25))
        assert got[k]["b"] == pytest.approx(np.percentile(x[g == k], 90))
        assert got[k]["n"] == (g == k).sum()


def test_running_totals(spark):
    rng = np.random.default_rng(5)
    v, n = np.arange(5000), rng.integers(0, 9, 5000)
    got = running_totals(frame(spark, v=v, n=n), [], [F.desc("v")], ["n"]).orderBy("v").toPandas()
    np.testing.assert_array_equal(got["n_upto"], n[::-1].cumsum()[::-1])
    assert set(got["n_all"]) == {n.sum()}


def brute_metrics(score, y):
    pos, neg = score[y == 1], score[y == 0]
    auc = ((pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean())
    ap, last, best = 0.0, 0.0, (-1.0,)
    for t in sorted(set(score)):
        p = (score >= t)
        precision, recall = y[p].mean(), y[p].sum() / y.sum()
        f1 = 2 * precision * recall / (precision + recall + 1e-10)
        if f1 > best[0]:
            best = (f1, precision, recall, t)
    for t in sorted(set(score), reverse=True):
        p = (score >= t)
        recall = y[p].sum() / y.sum()
        ap, last = ap + (recall - last) * y[p].mean(), recall
    return auc, ap, best


def test_curve_metrics_with_ties(spark):
    rng = np.random.default_rng(6)
    y = (rng.random(1500) < 0.1).astype(int)
    s = np.floor(rng.normal(size=1500) * 4 + 3 * y)
    got = curve_metrics(curve(frame(spark, s=s, y=y), "s", "y")).first()
    auc, ap, best = brute_metrics(s, y)
    assert (got["roc_auc"], got["pr_auc"]) == pytest.approx((auc, ap))
    assert (got["f1"], got["precision"], got["recall"], got["threshold"]) == pytest.approx(best)
    assert got["base_rate"] == pytest.approx(y.mean())


def test_percentile_metrics_flag_strictly_above(spark):
    s, y = np.r_[np.zeros(90), np.ones(10)], np.r_[np.zeros(95), np.ones(5)].astype(int)
    got = percentile_metrics(frame(spark, s=s, y=y), "s", "y").first()
    assert got["threshold"] == 1.0 and got["f1"] == 0.0


def test_weight_grid_and_search(spark):
    assert len(weight_grid(0.05)) == 231 and all(abs(sum(w) - 1) < 1e-9 for w in weight_grid(0.05))
    rng = np.random.default_rng(8)
    y = (rng.random(2000) < 0.05).astype(int)
    a, b, c = rng.random(2000), rng.random(2000) + y, rng.random(2000) + 0.3 * y
    a, b, c = ((x - x.min()) / (x.max() - x.min()) for x in (a, b, c))
    rows = ensemble_search(frame(spark, a=a, b=b, c=c, y=y), ("a", "b", "c"), "y", step=0.2).collect()
    want = []
    for w1, w2, w3 in weight_grid(0.2):
        s = w1 * a + w2 * b + w3 * c
        flag = s > np.percentile(s, 95)
        want.append(2 * (flag & (y == 1)).sum() / (flag.sum() + y.sum()))
    assert [r["f1"] for r in rows] == pytest.approx(want)
    assert [r["best"] for r in rows].index(True) == int(np.argmax(want))
    for r, (w1, w2, w3) in zip(rows, weight_grid(0.2)):
        auc, ap = brute_metrics(w1 * a + w2 * b + w3 * c, y)[:2]
        assert (r["roc_auc"], r["pr_auc"]) == (pytest.approx(auc), pytest.approx(ap))
    none = ensemble_search(frame(spark, a=a, b=b, c=c, y=y).limit(0), ("a", "b", "c"), "y", step=0.5).collect()
    assert len(none) == 6 and not any(r["best"] for r in none)


def test_search_with_an_outlier_is_exact(spark):
    """One extreme row squeezes all others into a sliver of [0, 1]; the ranking is still perfect."""
    y = np.r_[np.zeros(3800), np.ones(200)].astype(int)
    x = np.r_[np.arange(4000.0), [1e15]]
    x = (x - x.min()) / (x.max() - x.min())
    rows = ensemble_search(frame(spark, a=x, b=x, c=x, y=np.r_[y, 1]), ("a", "b", "c"), "y", step=0.5).collect()
    assert all((r["roc_auc"], r["pr_auc"]) == (pytest.approx(1.0), pytest.approx(1.0)) for r in rows)
    assert [r["threshold"] for r in rows] == pytest.approx([float(np.percentile(x, 95))] * 6, rel=1e-9)


@pytest.mark.parametrize("cells", [4_000_000, 700, 100])
def test_areas_are_exact_with_ties_in_any_number_of_passes(spark, cells):
    rng = np.random.default_rng(11)
    y = (rng.random(1500) < 0.1).astype(int)
    a, b, c = (np.floor(rng.random(1500) * 12 + 3 * y) / 16 for _ in range(3))
    slim = frame(spark, s1=a, s2=b, s3=c, y=y).selectExpr("s1", "s2", "s3", "y = 1 AS hit")
    for (w1, w2, w3), got in zip(weight_grid(0.5), exact_areas(slim, weight_grid(0.5), cells)):
        assert got == pytest.approx(brute_metrics(w1 * a + w2 * b + w3 * c, y)[:2])
    assert exact_areas(slim.where("NOT hit"), weight_grid(0.5), cells) == [(None, None)] * 6


def test_histogram_and_box(spark):
    rng = np.random.default_rng(9)
    x = rng.exponential(size=2000)
    df = frame(spark, x=x, TransactionID=np.arange(2000).astype(str))
    counts = {r["bin"]: r["n"] for r in histogram(df, "x", 30).collect()}
    want, _ = np.histogram(x, 30)
    assert [counts.get(i, 0) for i in range(30)] == list(want)
    box = box_stats(df, "x", []).first()
    q1, q3 = np.percentile(x, [25, 75])
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert (box["whisker_low"], box["whisker_high"]) == (inside.min(), inside.max())
    assert box["outliers"] == 2000 - len(inside)


def test_constant_histogram(spark):
    df = frame(spark, x=np.full(5, 3.0))
    assert [(r["bin"], r["n"]) for r in histogram(df, "x", 30).collect()] == [(0, 5)]


def test_stratified_sample_ignores_partitioning(spark):
    import pandas as pd
    acc = pd.DataFrame({"AccountNumber": [f"A{i}" for i in range(100)],
                        "bucket": ["low" if i % 3 else "high" for i in range(100)]})
    runs = [set(r[0] for r in stratified_sample(spark.createDataFrame(acc).repartition(n), 5).collect())
            for n in (1, 7)]
    assert runs[0] == runs[1] and len(runs[0]) == 10


def test_cleaning(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),), (float("nan"),), (None,), (3.0,)], "x double")
    assert [r[0] for r in fill_zero(df, ["x"]).collect()] == [1.0, 0.0, 0.0, 0.0, 3.0]
    assert [r[0] for r in MeanImputer(["x"]).fit(df).transform(df).collect()] == [1.0, 2.0, 2.0, 2.0, 3.0]


def test_scalers(spark):
    import pandas as pd
    pdf = pd.DataFrame({"AccountNumber": list("aaabbc"), "TransactionID": list("123456"),
                        "g": [1.0, 2, 3, 4, 5, 9], "c": [1.0, 2, 4, 7, 7, 3], "k": 5.0})
    df = spark.createDataFrame(pdf)
    std = Scaler("global_standard", ["g", "k"]).fit(df).transform(df).toPandas().sort_values("TransactionID")
    np.testing.assert_allclose(std["g"], (pdf.g - pdf.g.mean()) / pdf.g.std(ddof=0))
    assert set(std["k"]) == {0.0}
    for max_rows in (10, 2):
        s = Scaler("global_standard_client_standard", ["g"], ["c"], max_rows=max_rows).fit(df)
        got = s.transform(df).toPandas().sort_values("TransactionID").reset_index(drop=True)
        by = pdf.groupby("AccountNumber")["c"]
        want = (pdf.c - by.transform("mean")) / (by.transform("std") + 1e-6)
        np.testing.assert_allclose(got["c"].astype(float), want)
        assert list(got.columns) == list(pdf.columns)
    beside = Scaler("global_minmax", ["g"]).fit(df).transform(df, "_s")
    assert set(beside.columns) == {*pdf.columns, "g_s"}
    with pytest.raises(ValueError):
        Scaler("robust")
