import datetime as dt
import math
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, by_id
from ledgerpulse.functions import trailing
from ledgerpulse.models.som import SelfOrganizingMap
from ledgerpulse.models.store import ScoringModel
from ledgerpulse.operators.features import features
from ledgerpulse.plans.stream_queries import ONCE, Feed, time_parts
from ledgerpulse.schema import ENGINEERED_COLS, FEATURE_COLS
from ledgerpulse.sources.events import read_events
from ledgerpulse.sources.feeds import parse_json, valid_events
from ledgerpulse.sources.tables import read_table
from ledgerpulse.streaming import medallion
from ledgerpulse.streaming.stateful import stateful_features


def run_stream(spark, parts, tmp_path, ttl_ms=None, after=lambda: None):
    feed, out = Feed(spark), str(tmp_path / "out")
    for part in parts:
        feed.add(part)
        stream = stateful_features(valid_events(parse_json(feed.stream())), ttl_ms)
        (stream.writeStream.format("parquet").option("path", out).trigger(**ONCE)
         .option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination())
        after()
    return spark.read.parquet(out)


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    txn = read_events(spark, SF_DIR)
    got = run_stream(spark, time_parts(txn, 3), tmp_path).toPandas().set_index("TransactionID").sort_index()
    want = features(txn, "trailing").toPandas().set_index("TransactionID").sort_index()
    assert list(got.index) == list(want.index)
    for c in ENGINEERED_COLS:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), atol=1e-9)


def test_late_row_counts_as_newest(spark, txn, tmp_path):
    rows = txn([{"TransactionAmount": float(a)} for a in (1, 2, 4, 8)])
    late = F.col("TransactionID") == "000001"
    got = by_id(run_stream(spark, [rows.filter(~late), rows.filter(late)], tmp_path))
    assert got["000001"]["MovingAvg"] == pytest.approx(np.log([1, 4, 8, 2]).mean())
    assert got["000001"]["LogTimeDiff"] == pytest.approx(math.log(1e-6))
    assert got["000003"]["MovingAvg"] == pytest.approx(np.log([1, 4, 8]).mean())


def test_missing_values_in_a_stream(spark, txn, tmp_path):
    rows = txn([{"Channel": c, "Age": None, "Time": t} for c, t in
                ((None, None), ("ATM", None), (None, dt.datetime(2024, 1, 1, 5)))])
    got = by_id(run_stream(spark, [rows], tmp_path))
    assert got["000002"]["ChannelFreq"] == pytest.approx(2 / 3) and got["000002"]["Age"] is None
    assert got["000000"]["HourSin"] == 0.0


class State(SimpleNamespace):
    """What the state function uses of a group state."""

    def remove(self):
        self.exists, self.gone = False, True

    def update(self, value):
        self.get, self.exists = value, True

    def setTimeoutDuration(self, ms):
        self.timeout = ms


def test_silent_accounts_are_forgotten(spark, txn, monkeypatch):
    seen = {}
    monkeypatch.setattr("pyspark.sql.GroupedData.applyInPandasWithState",
                        lambda self, fn, *a: seen.update(fn=fn, mode=a[-1]))
    rows = txn([{}, {}])
    stateful_features(rows, ttl_ms=5000)
    state = State(exists=False, hasTimedOut=False)
    assert len(list(seen["fn"](("A",), iter([rows.toPandas()]), state))[0]) == 2
    assert state.timeout == 5000 and len(state.get[0]) == 2 and seen["mode"] == "ProcessingTimeTimeout"
    state.hasTimedOut = True
    assert list(seen["fn"](("A",), iter([]), state)) == [] and state.gone
    stateful_features(rows)
    assert seen["mode"] == "NoTimeout"


def test_state_keeps_seven_rows(spark, txn, monkeypatch):
    seen = {}
    monkeypatch.setattr("pyspark.sql.GroupedData.applyInPandasWithState", lambda self, fn, *a: seen.update(fn=fn))
    stateful_features(txn([{}]))
    state = State(exists=False, hasTimedOut=False)
    list(seen["fn"](("A",), iter([txn([{}] * 20).toPandas()]), state))
    assert {len(v) for v in state.get} == {7}


@pytest.mark.parametrize("window", [1, 2, 9])
def test_features_and_state_of_other_windows(spark, txn, monkeypatch, window):
    seen = {}
    monkeypatch.setattr("pyspark.sql.GroupedData.applyInPandasWithState", lambda self, fn, *a: seen.update(fn=fn))
    amounts, cities = [float(2 ** (k % 5)) for k in range(20)], ["a", "b", "c"] * 6 + ["a", "a"]
    rows = txn([{"TransactionAmount": a, "City": c} for a, c in zip(amounts, cities)]).toPandas()
    stateful_features(txn([{}]), window=window)
    state, got = State(exists=False, hasTimedOut=False), []
    for part in (rows[:3], rows[3:11], rows[11:]):
        got += list(seen["fn"](("A",), iter([part[:2], part[2:]]), state))
        state.exists = True
    got = pd.concat(got).sort_values("TransactionID").reset_index()
    assert {len(v) for v in state.get} == {window}
    for i, row in got.iterrows():
        logs, held = np.log(amounts[max(0, i - window + 1):i + 1]), cities[max(0, i - window + 1):i + 1]
        assert row["MovingAvg"] == pytest.approx(logs.mean()) and row["MovingStd"] == pytest.approx(logs.std())
        assert row["CityFreq"] == pytest.approx(held.count(cities[i]) / len(held))
    with pytest.raises(ValueError, match="window"):
        stateful_features(txn([{}]), window=0)


def test_chunks_do_not_change_anything(monkeypatch):
    rng = np.random.default_rng(0)
    args = (np.sort(rng.integers(0, 10 ** 6, 500)), rng.normal(size=500),
            [rng.integers(0, 4, 500).astype(str).astype(object) for _ in range(6)], rng.integers(0, 24, 500))
    whole = trailing.trailing_rows(*args)
    monkeypatch.setattr(trailing, "CHUNK", 37)
    for name, values in trailing.trailing_rows(*args).items():
        np.testing.assert_allclose(values, whole[name], atol=1e-12)


def test_an_accounts_categories_are_counted_at_once(monkeypatch):
    """Array calls, not rows, are what an account with few rows costs; the counts stay apart by category."""
    calls, factorize = [], pd.factorize
    monkeypatch.setattr(trailing.pd, "factorize", lambda *a, **b: calls.append(a) or factorize(*a, **b))
    cats = [np.array(c, dtype=object) for c in (["a", "b", "a"], [None, "a", None], ["a", "a", "a"], ["x", "y", "z"], ["b"] * 3,
                                                [None] * 3)]
    got = trailing.trailing_rows(np.arange(3), np.zeros(3), cats, np.zeros(3), 2)
    assert len(calls) == 1
    for name, want in zip(trailing.FREQ_COLS, ([1, .5, .5], [1, .5, .5], [1, 1, 1], [1, .5, .5], [1, 1, 1], [1, 1, 1])):
        np.testing.assert_allclose(got[name], want)
    for name, want in zip(trailing.ENTROPY_COLS, ([0, 1, 1], [0, 1, 1], [0, 0, 0], [0, 1, 1], [0, 0, 0], [0, 0, 0])):
        np.testing.assert_allclose(got[name], want, atol=1e-12)


@pytest.fixture(scope="module")
def model(spark):
    df = features(read_events(spark, SF_DIR), "trailing")
    return ScoringModel(detectors={"som": SelfOrganizingMap(x=3, y=3, passes=1)}).fit(df)


def counts(spark, root):
    return [read_table(spark, root, t).count() for t in medallion.BATCH_TABLES]


@pytest.mark.parametrize("start", [medallion.start_stateful, medallion.start_memoryless])
def test_medallion_tables(spark, tmp_path, model, start):
    root, feed = str(tmp_path / "lake"), Feed(spark)
    txn = read_events(spark, SF_DIR)
    feed.add(txn)
    start(feed.stream(), root, str(tmp_path / "cp"), model, "som", trigger=ONCE).awaitTermination()
    n = txn.count()
    assert counts(spark, root) == [n, n, n, n * len(FEATURE_COLS)]
    fact = read_table(spark, root, "gold.TransactionFact")
    assert fact.filter("IsAnomaly != (modelscore > 3.5) or IsCritical != (modelscore > 5.25)").count() == 0
    assert fact.filter("goldtimestamp is null or batch_id != 0 or date != to_date(Time)").count() == 0
    assert read_table(spark, root, "silver.features").filter("silvertimestamp is null").count() == 0


def test_repeated_batch_replaces_itself(spark, tmp_path, model):
    root = str(tmp_path / "lake")
    df = features(read_events(spark, SF_DIR), "trailing")
    for batch in (0, 1, 0):
        medallion.write_batch(df, batch, root, model, "som")
    n = df.count()
    assert counts(spark, root) == [2 * n, 2 * n, 2 * n, 2 * n * len(FEATURE_COLS)]
