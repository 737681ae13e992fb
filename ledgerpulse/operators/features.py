"""Per-account behavioural features in three profiles that differ on purpose.

``trailing``     the last 7 rows of the account, whatever their value (also the stream's rule)
``expanding``    all rows of the account so far; the moving statistics need 7 full rows
``value_frame``  the last 7 rows *with the same value* against the last 7 rows

Rows are ordered by (Time, TransactionID); a missing category counts as a value of its own.
"""

import json
import math
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.operators.slices import (HOT_ROWS, NOTHING, RANKS, ROWS, VALUES, Keyed, in_front, is_carried,
                                          is_head, n_log_n, slice_accounts)
from ledgerpulse.schema import (CAT_COLS, ENGINEERED_COLS, ENTROPY_COLS, EPS, FREQ_COLS,
                                WINDOW_ROWS)

LOOK_BACK = WINDOW_ROWS - 1
PROFILES = ("trailing", "expanding", "value_frame")
ROW_COLS = {"LogAmount", "HourSin", "HourCos"}


def features(txn: DataFrame, profile: str = "trailing", keep: list[str] | None = None,
             max_rows: int = HOT_ROWS) -> DataFrame:
    """``txn`` plus the engineered columns of ``profile`` (all of them, or those in ``keep``)."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}, expected one of {PROFILES}")
    wanted = ENGINEERED_COLS if keep is None else keep
    totals = NOTHING
    if profile != "trailing":
        counted = any(c in FREQ_COLS + ENTROPY_COLS for c in wanted)
        ranked = profile == "value_frame" and any(c in ENTROPY_COLS for c in wanted)
        totals = RANKS if ranked else VALUES if counted else ROWS
    inputs = txn.columns
    # columns of the row alone need no look at the accounts: their unused windows are pruned
    keyed = (Keyed(txn) if set(wanted) <= ROW_COLS
             else slice_accounts(txn, LOOK_BACK, totals, max_rows))
    build = {"trailing": _trailing, "expanding": _expanding, "value_frame": _value_frame}[profile]
    return keyed.own(build(keyed, wanted)).select(*inputs, *wanted)


def hour_pair() -> dict[str, Column]:
    angle = F.lit(2 * math.pi) * F.coalesce(F.hour("Time"), F.lit(0)) / F.lit(24.0)
    return {"HourSin": F.sin(angle), "HourCos": F.cos(angle)}


def epoch_micros(column: str = "Time") -> Column:
    """Microseconds since 1970 of a zone-free timestamp, without going through a zone."""
    second = F.expr(f"extract(SECOND FROM {column})")
    fraction = ((second - F.floor(second)) * 1_000_000).cast("long")
    return F.unix_timestamp(column) * 1_000_000 + fraction


def _z_score() -> Column:
    return (F.col("LogAmount") - F.col("MovingAvg")) / (F.col("MovingStd") + F.lit(EPS))


def _needs(wanted: list[str], *columns: str) -> bool:
    return any(c in wanted for c in columns)


# --- trailing -----------------------------------------------------------------------------

def _trailing(keyed: Keyed, wanted: list[str]) -> DataFrame:
    w = keyed.window()
    roll = w.rowsBetween(-LOOK_BACK, Window.currentRow)
    seconds = F.coalesce(F.unix_timestamp("Time"), F.lit(0))
    df = (keyed.df
          .withColumns({"LogAmount": F.log(F.greatest(F.nanvl("TransactionAmount", F.lit(None)), F.lit(EPS))),
                        "_seconds": seconds, **hour_pair()})
          .withColumns({"_row": F.row_number().over(w),
                        "MovingAvg": F.avg("LogAmount").over(roll),
                        "MovingStd": F.stddev_pop("LogAmount").over(roll),
                        "_gap": F.col("_seconds") - F.lag("_seconds", 1).over(w)}))
    df = df.withColumns({
        "AmountZScore": _z_score(),
        "LogTimeDiff": F.when(F.col("_row") == 1, F.lit(0.0)).otherwise(
            F.log(F.greatest(F.col("_gap") / F.lit(3600.0), F.lit(EPS)))),
    })
    if _needs(wanted, *FREQ_COLS, *ENTROPY_COLS):
        df = _trailing_categories(df, keyed.over)
    return df


def _trailing_categories(df: DataFrame, over: str) -> DataFrame:
    """Share and entropy of the last 7 rows without building a list per row.

    Each row keeps, per category, its link: how many rows back the same value occurred last (0 if
    not within 6). The links of the seven rows of a frame say which of them are equal, so their
    combination is an index into a table of all 7! cases. Six links are packed into one long, and
    only that long is read back with ``lag``.
    """
    back = range(1, WINDOW_ROWS)
    links = {}
    for i, c in enumerate(CAT_COLS):
        cases = " ".join(f"WHEN _row > {j} AND {c} <=> lag({c}, {j}) {over} THEN {j}" for j in back)
        links[f"_l{i}"] = F.expr(f"CASE {cases} ELSE 0 END")
    packed = " + ".join(f"shiftleft(cast(_l{i} AS bigint), {3 * i})" for i in range(len(CAT_COLS)))
    df = df.withColumns(links).withColumn("_p0", F.expr(packed))
    df = df.withColumns({f"_p{j}": F.expr(f"lag(_p0, {j}, 0L) {over}") for j in back})

    cases = []
    for i in range(len(CAT_COLS)):
        digits = []
        for j, radix in enumerate(_radices()):
            link = f"(shiftright(_p{j}, {3 * i}) & 7)"
            digits.append(f"if({link} <= {LOOK_BACK - j}, {link} * {radix}, 0)")
        cases.append(f"cast({' + '.join(digits)} AS int)")
    df = df.withColumn("_case", F.expr(f"array({', '.join(cases)})"))
    tables = _frame_tables()
    df = df.withColumns({
        "_size": F.expr(f"cast(least(_row, {WINDOW_ROWS}) AS double)"),
        **{name: F.expr(f"transform(_case, c -> get(from_json('{json.dumps(values)}', 'array<{kind}>'), c))")
           for name, kind, values in tables}})
    out = {}
    for i, (freq, entropy) in enumerate(zip(FREQ_COLS, ENTROPY_COLS)):
        # rows missing from a short frame look like further distinct values
        distinct = f"(_distinct[{i}] - {WINDOW_ROWS} + _size)"
        out[freq] = F.expr(f"_equal[{i}] / _size")
        out[entropy] = F.expr(f"CASE WHEN {distinct} > 1 THEN "
                              f"greatest(ln(_size) - _weight[{i}] / _size, 0D) / ln({distinct}) ELSE 0D END")
    return df.withColumns(out)


def _radices() -> list[int]:
    """Place values of the links: the row j places back has 7 - j possible links."""
    out = [1]
    for j in range(LOOK_BACK - 1):
        out.append(out[-1] * (WINDOW_ROWS - j))
    return out


@cache
def _frame_tables() -> list[tuple[str, str, list]]:
    """Per combination of links: sum of c ln c over the values, distinct values, equals of the last."""
    weight, distinct, equal = [], [], []
    for case in range(math.factorial(WINDOW_ROWS)):
        seen = [0] * WINDOW_ROWS          # occurrences up to each row, newest row first
        for j in reversed(range(WINDOW_ROWS)):
            link = case // _radices()[j] % (WINDOW_ROWS - j) if j < LOOK_BACK else 0
            seen[j] = seen[j + link] + 1 if link else 1
        weight.append(sum(_n_log_n_of(k) - _n_log_n_of(k - 1) for k in seen))
        distinct.append(seen.count(1))
        equal.append(seen[0])
    return [("_weight", "double", weight), ("_distinct", "int", distinct), ("_equal", "int", equal)]


def _n_log_n_of(n: int) -> float:
    return n * math.log(n) if n else 0.0


# --- running counts, shared by expanding and value_frame -----------------------------------

def _running_counts(keyed: Keyed, df: DataFrame, ranks: bool) -> DataFrame:
    """``_k{i}``: rows of the account so far with this row's value of category i.

    ``_d{i}``, on request: rank of the value among the account's distinct values.
    """
    for i, c in enumerate(CAT_COLS):
        same = keyed.window(c)
        if keyed.sliced:
            rows = F.when(in_front(), F.when(is_carried(i), F.col("_n")).otherwise(0))
            upto = same.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            df = df.withColumn(f"_k{i}", F.sum(rows.otherwise(1)).over(upto))
        else:
            df = df.withColumn(f"_k{i}", F.row_number().over(same))
        if ranks:
            # counting first rows in (value, time) order reuses the sort of the count above
            by_value = (Window.partitionBy(*keyed.part).orderBy(c, *keyed.order)
                        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
            first = F.col(f"_k{i}") == 1
            rank = F.sum(F.when(first & ~in_front() if keyed.sliced else first, 1).otherwise(0)).over(by_value)
            if keyed.sliced:
                # in a slice the value's cell, before its rows, knows the rank among all values of the account
                rank = F.when(~in_front(), F.coalesce(F.max(F.when(is_carried(i), F.col("_rank"))).over(upto), rank))
            df = df.withColumn(f"_d{i}", rank)
    return df


def running_rows(keyed: Keyed) -> Column:
    """Rows of the account so far."""
    if not keyed.sliced:
        return F.row_number().over(keyed.window())
    rows = F.when(is_head(0), F.col("_n")).when(in_front(), 0).otherwise(1)
    return F.sum(rows).over(
        keyed.window().rowsBetween(Window.unboundedPreceding, Window.currentRow))


# --- expanding ----------------------------------------------------------------------------

def _expanding(keyed: Keyed, wanted: list[str]) -> DataFrame:
    w = keyed.window()
    roll = w.rowsBetween(-LOOK_BACK, Window.currentRow)
    amount = F.col("TransactionAmount")
    df = keyed.df.withColumns({
        "LogAmount": F.when(amount == 0, F.lit(float("-inf")))
                      .when(amount < 0, F.lit(float("nan"))).otherwise(F.log(amount)),
        "_finite": F.when(amount > 0, F.log(amount)),
        "_micros": epoch_micros(), **hour_pair()})
    full = F.count("_finite").over(roll) == WINDOW_ROWS
    df = df.withColumns({
        "_all": running_rows(keyed),
        "MovingAvg": F.when(full, F.avg("_finite").over(roll)),
        "MovingStd": F.when(full, F.stddev_samp("_finite").over(roll)),
        "_gap": F.col("_micros") - F.lag("_micros", 1).over(w)})
    hours = F.col("_gap") / F.lit(3.6e9)
    df = df.withColumns({
        "AmountZScore": _z_score(),
        "LogTimeDiff": F.when(F.col("_gap").isNotNull(), F.log(F.greatest(hours, F.lit(EPS))))})
    if _needs(wanted, *FREQ_COLS, *ENTROPY_COLS):
        df = _running_counts(keyed, df, ranks=False)
        df = df.withColumns({f: F.try_divide(f"_k{i}", F.col("_all").cast("double"))
                             for i, f in enumerate(FREQ_COLS)})
    if _needs(wanted, *ENTROPY_COLS):
        df = _expanding_entropy(keyed, df)
    return df


def _expanding_entropy(keyed: Keyed, df: DataFrame) -> DataFrame:
    """H = ln N - (sum of k ln k over the values) / N, with the sum built up row by row."""
    upto = keyed.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {}
    for i in range(len(CAT_COLS)):
        k = F.col(f"_k{i}")
        gain = n_log_n(k) - n_log_n(k - 1)
        new = F.when(k == 1, 1).otherwise(0)
        if keyed.sliced:
            gain = F.when(is_head(i), F.col("_w")).when(in_front(), 0.0).otherwise(gain)
            new = F.when(is_head(i), F.col("_u")).when(in_front(), 0).otherwise(new)
        sums[f"_s{i}"] = F.sum(gain).over(upto)
        sums[f"_u{i}"] = F.sum(new).over(upto)
    df = df.withColumns(sums)
    n = F.col("_all").cast("double")
    return df.withColumns({
        name: F.when(F.col(f"_u{i}") > 1,
                     F.greatest(F.log(n) - F.try_divide(F.col(f"_s{i}"), n), F.lit(0.0))
                     / F.log(f"_u{i}"))
               .otherwise(0.0)
        for i, name in enumerate(ENTROPY_COLS)})


# --- value_frame --------------------------------------------------------------------------

def _value_frame(keyed: Keyed, wanted: list[str]) -> DataFrame:
    w = keyed.window()
    roll = w.rowsBetween(-LOOK_BACK, Window.currentRow)
    amount = F.col("TransactionAmount")
    df = keyed.df.withColumns({
        "LogAmount": F.when(amount > 0, F.log(amount)),
        "_seconds": F.unix_timestamp("Time"), **hour_pair()})
    df = df.withColumns({
        "_all": running_rows(keyed),
        "MovingAvg": F.avg("LogAmount").over(roll),
        "MovingStd": F.stddev_samp("LogAmount").over(roll),
        "_gap": F.col("_seconds") - F.lag("_seconds", 1).over(w)})
    hours = F.col("_gap") / F.lit(3600.0)
    df = df.withColumns({
        "AmountZScore": _z_score(),
        "LogTimeDiff": F.log(F.when(hours > EPS, hours).otherwise(F.lit(EPS)))})
    if _needs(wanted, *FREQ_COLS, *ENTROPY_COLS):
        df = _running_counts(keyed, df, ranks=_needs(wanted, *ENTROPY_COLS))
        # a frame of 7 rows over rows of one value holds min(k, 7) rows
        total = F.least("_all", F.lit(WINDOW_ROWS)).cast("double")
        df = df.withColumns({f: F.try_divide(F.least(f"_k{i}", F.lit(WINDOW_ROWS)), total)
                             for i, f in enumerate(FREQ_COLS)})
    if _needs(wanted, *ENTROPY_COLS):
        df = _value_frame_entropy(keyed, df, roll)
    return df


def _value_frame_entropy(keyed: Keyed, df: DataFrame, roll) -> DataFrame:
    terms = {}
    for i, freq in enumerate(FREQ_COLS):
        p = F.col(freq)
        held = F.least(f"_k{i}", F.lit(WINDOW_ROWS)).cast("double")
        real = ~in_front() if keyed.sliced else F.lit(True)
        terms[f"_t{i}"] = F.when(real, F.try_divide(p * F.log(p), held))
    df = df.withColumns(terms)
    df = df.withColumns({f"_h{i}": F.sum(f"_t{i}").over(roll) for i in range(len(CAT_COLS))}
                        | {f"_u{i}": F.max(f"_d{i}").over(roll) for i in range(len(CAT_COLS))})
    return df.withColumns({
        name: F.when(F.col(f"_u{i}") > 1, -F.col(f"_h{i}") / F.log(f"_u{i}")).otherwise(0.0)
        for i, name in enumerate(ENTROPY_COLS)})
