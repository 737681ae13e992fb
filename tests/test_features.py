import datetime as dt
import math

import numpy as np
import pytest

from conftest import SF_DIR, by_id
from ledgerpulse.operators.features import PROFILES, features
from ledgerpulse.operators.ranking import rank_pct, time_split
from ledgerpulse.operators.slices import CARRIED, RANKS, attach, hot_keys, in_front, slice_accounts
from ledgerpulse.schema import CAT_COLS, ENGINEERED_COLS, KEY
from ledgerpulse.sources.events import read_events
from pyspark.sql import functions as F

EPS = 1e-6


def test_first_row_per_profile(txn):
    df = txn([{}])
    got = {p: by_id(features(df, p))["000000"] for p in PROFILES}
    t, e, v = got["trailing"], got["expanding"], got["value_frame"]
    assert t["LogTimeDiff"] == 0.0 and e["LogTimeDiff"] is None
    assert v["LogTimeDiff"] == pytest.approx(math.log(EPS))
    assert t["MovingStd"] == 0.0 and e["MovingStd"] is None and v["MovingStd"] is None
    assert t["MovingAvg"] == v["MovingAvg"] == pytest.approx(math.log(10)) and e["MovingAvg"] is None
    assert t["AmountZScore"] == 0.0 and v["AmountZScore"] is None
    for row in got.values():
        assert row["ChannelFreq"] == 1.0 and row["ChannelEntropy"] == 0.0


def test_moving_statistics_need_seven_rows_only_when_expanding(txn):
    amounts = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0]
    df = txn([{"TransactionAmount": a} for a in amounts])
    logs = np.log(amounts)
    t, e, v = (by_id(features(df, p)) for p in PROFILES)
    for i in range(8):
        frame, key = logs[max(0, i - 6):i + 1], f"{i:06d}"
        assert t[key]["MovingAvg"] == pytest.approx(frame.mean())
        assert t[key]["MovingStd"] == pytest.approx(frame.std())
        if len(frame) > 1:
            assert v[key]["MovingStd"] == pytest.approx(frame.std(ddof=1))
        if len(frame) == 7:
            assert e[key]["MovingStd"] == pytest.approx(frame.std(ddof=1))
            assert e[key]["AmountZScore"] == pytest.approx((logs[i] - frame.mean()) / (frame.std(ddof=1) + EPS))
        else:
            assert e[key]["MovingAvg"] is None and e[key]["AmountZScore"] is None


def test_amount_zero_and_negative(txn):
    df = txn([{"TransactionAmount": 0.0}, {"TransactionAmount": -5.0}])
    t, e, v = (by_id(features(df, p, ["LogAmount"])) for p in PROFILES)
    for key in ("000000", "000001"):
        assert t[key]["LogAmount"] == pytest.approx(math.log(EPS))
        assert v[key]["LogAmount"] is None
    assert e["000000"]["LogAmount"] == float("-inf")
    assert math.isnan(e["000001"]["LogAmount"])


def test_an_infinite_logarithm_empties_the_expanding_window(txn):
    rows = [{"TransactionAmount": 0.0 if i == 3 else 5.0} for i in range(12)]
    got = by_id(features(txn(rows), "expanding"))
    assert [got[f"{i:06d}"]["MovingAvg"] is None for i in range(12)] == [True] * 10 + [False] * 2


def test_missing_category_counts_as_a_value(txn):
    df = txn([{"Channel": c} for c in ("ATM", None, None, "ATM")])
    t, e, v = (by_id(features(df, p)) for p in PROFILES)
    for got in (t, e, v):
        assert got["000002"]["ChannelFreq"] == pytest.approx(2 / 3)
    half = -(1 / 3 * math.log(1 / 3) + 2 / 3 * math.log(2 / 3)) / math.log(2)
    assert t["000002"]["ChannelEntropy"] == pytest.approx(half)
    assert e["000002"]["ChannelEntropy"] == pytest.approx(half)


def test_trailing_forgets_and_expanding_does_not(txn):
    df = txn([{"City": "Paris"}] + [{"City": "Rabat"}] * 7)
    t, e, v = (by_id(features(df, p))["000007"] for p in PROFILES)
    assert t["CityFreq"] == 1.0 and t["CityEntropy"] == 0.0
    assert e["CityFreq"] == pytest.approx(7 / 8) and e["CityEntropy"] > 0
    assert v["CityFreq"] == 1.0


def test_value_frame_counts_rows_of_the_value(txn):
    # 7 rows with the value lie before, but only 3 of them among the last 7 rows
    df = txn([{"City": "Paris"}] * 5 + [{"City": "Rabat"}] * 4 + [{"City": "Paris"}])
    t, v = (by_id(features(df, p))["000009"] for p in ("trailing", "value_frame"))
    assert v["CityFreq"] == pytest.approx(6 / 7)
    assert t["CityFreq"] == pytest.approx(3 / 7)


def test_equal_times_are_ordered_by_id(txn):
    same = dt.datetime(2024, 5, 1)
    df = txn([{"Time": same, "TransactionAmount": a} for a in (1.0, 3.0, 9.0)])
    got = by_id(features(df, "trailing"))
    assert got["000002"]["MovingAvg"] == pytest.approx(np.log([1, 3, 9]).mean())
    assert got["000002"]["LogTimeDiff"] == pytest.approx(math.log(EPS))


def brute_trailing(values):
    out = []
    for i in range(len(values)):
        frame = values[max(0, i - 6):i + 1]
        p = [frame.count(v) / len(frame) for v in set(frame)]
        h = -sum(x * math.log(x) for x in p) / math.log(len(p)) if len(p) > 1 else 0.0
        out.append((frame.count(values[i]) / len(frame), h))
    return out


def test_trailing_categories_against_counting(txn):
    rng = np.random.default_rng(7)
    cities = [str(v) for v in rng.integers(0, 9, 300)]
    groups = [None if v == 0 else str(v) for v in rng.integers(0, 3, 300)]
    got = by_id(features(txn([{"City": c, "MerchandGroup": g} for c, g in zip(cities, groups)]), "trailing"))
    for i, ((cf, ce), (gf, ge)) in enumerate(zip(brute_trailing(cities), brute_trailing(groups))):
        row = got[f"{i:06d}"]
        assert (row["CityFreq"], row["CityEntropy"]) == pytest.approx((cf, ce), abs=1e-12)
        assert (row["MerchandFreq"], row["MerchandEntropy"]) == pytest.approx((gf, ge), abs=1e-12)
        assert 0 < row["CityFreq"] <= 1 and -1e-12 <= row["CityEntropy"] <= 1 + 1e-12


@pytest.fixture(scope="module")
def skewed(spark):
    """One account holds a third of all rows, with missing categories."""
    df = read_events(spark, SF_DIR)
    third = F.col("TransactionID").cast("int") % 3 == 0
    return (df.withColumn(KEY, F.when(third, "ACC1").otherwise(F.col(KEY)))
            .withColumn("Channel", F.when(F.col("Age") % 5 != 0, F.col("Channel")))).cache()


@pytest.mark.parametrize("profile", PROFILES)
@pytest.mark.parametrize("max_rows", [40, 150])
def test_sliced_accounts_equal_plain_windows(skewed, profile, max_rows):
    plain = features(skewed, profile).toPandas().set_index("TransactionID").sort_index()
    sliced = features(skewed, profile, max_rows=max_rows).toPandas().set_index("TransactionID").sort_index()
    assert list(plain.index) == list(sliced.index)
    for c in ENGINEERED_COLS:
        np.testing.assert_allclose(sliced[c].astype(float), plain[c].astype(float), rtol=0, atol=1e-12)


def test_what_stands_before_slices_grows_with_the_cells_that_exist(txn):
    """An account with a city for every row: one cell a row, not one for each city and slice."""
    rows = txn([{"City": f"{k:05d}"} for k in range(600)])
    keyed = slice_accounts(rows, 6, RANKS, max_rows=50)
    front = keyed.df.where(in_front()).groupBy("_kind", "_cat").count().collect()
    cells = sum(r["count"] for r in front if r["_kind"] == CARRIED and CAT_COLS[r["_cat"]] == "City")
    slices = keyed.df.select("_slice").distinct().count()
    assert slices > 10 and cells <= 600 + 6 * slices
    for profile in ("expanding", "value_frame"):
        plain = features(rows, profile).toPandas().set_index("TransactionID").sort_index()
        sliced = features(rows, profile, max_rows=50).toPandas().set_index("TransactionID").sort_index()
        for c in ENGINEERED_COLS:
            np.testing.assert_allclose(sliced[c].astype(float), plain[c].astype(float), rtol=0, atol=1e-12)


def test_rank_and_split_of_sliced_accounts(skewed):
    plain = by_id(rank_pct(skewed).select("TransactionID", "rank"))
    assert by_id(rank_pct(skewed, max_rows=50).select("TransactionID", "rank")) == plain
    train, test = time_split(skewed, 0.8, max_rows=50)
    assert train.count() + test.count() == skewed.count()
    assert train.count() == sum(r["rank"] <= 0.8 for r in plain.values())


def test_hot_keys_and_salted_join(spark, skewed):
    hot = hot_keys(skewed, KEY, 100)
    assert [r[KEY] for r in hot.table.collect()] == ["ACC1"] and hot_keys(skewed, KEY) is None
    stats = skewed.groupBy(KEY).agg(F.avg("TransactionAmount").alias("m")).filter(F.col(KEY) != "ACC100003")
    plain = by_id(skewed.join(stats, KEY, "left").select("TransactionID", "m"))
    assert by_id(attach(skewed, stats, KEY, "left", 100).select("TransactionID", "m")) == plain


def test_one_shuffle_for_all_windows(spark):
    for profile in PROFILES:
        plan = features(read_events(spark, SF_DIR), profile)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1, plan


def test_unknown_profile(txn):
    with pytest.raises(ValueError):
        features(txn([{}]), "other")


def test_an_amount_that_is_no_number_counts_as_missing(txn):
    """As in the stream."""
    rows = features(txn([{"TransactionAmount": float("nan")}, {"TransactionAmount": None}]), "trailing").collect()
    assert [r["LogAmount"] for r in rows] == pytest.approx([math.log(1e-6)] * 2)
