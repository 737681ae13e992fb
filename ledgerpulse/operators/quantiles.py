"""Exact interpolated quantiles (linear between neighbours) of large columns."""

import math
import sys
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.operators.prefix import running_totals

VALUES = 2_000_000     # values looked at one by one, over all requested quantiles
BINS = 4096            # parts a bracket is cut into by one pass


@dataclass
class _Target:
    """One quantile. Its two neighbouring ranks lie among the ``inside`` values in [low, high]."""

    name: str
    prob: float
    rows: int
    low: float
    high: float
    below: int = 0
    inside: int = 0

    def __post_init__(self):
        self.inside = self.rows
        self.position = self.prob * (self.rows - 1)
        self.first = math.floor(self.position)
        self.last = math.ceil(self.position)

    def within(self) -> str:
        return f"`{self.name}` BETWEEN {number(self.low)} AND {number(self.high)}"

    def bin(self) -> str:
        """Part of the bracket a value lies in; infinite values have parts of their own."""
        low, high = (max(min(x, sys.float_info.max), -sys.float_info.max) for x in (self.low, self.high))
        share = f"(`{self.name}` * 0.5D - {number(low * 0.5)}) / {number(high * 0.5 - low * 0.5)}"
        return (f"CASE WHEN `{self.name}` = {number(math.inf)} THEN {BINS} WHEN `{self.name}` = {number(-math.inf)} THEN -1 "
                f"ELSE least({BINS - 1}, CAST(floor({share} * {BINS}D) AS INT)) END")


def number(x: float) -> str:
    """SQL text of a double, exact."""
    return f"{x!r}D" if math.isfinite(x) else f"double('{'-' if x < 0 else ''}Infinity')"


def exact_quantiles(df: DataFrame, columns: dict[str, Column], probs: list[float],
                    values: int = VALUES) -> dict[tuple[str, float], float | None]:
    """{(column name, prob): quantile}, like ``numpy.percentile``; null and NaN are left out.

    Each pass counts the values in equal parts of every bracket, by part over many reducers, and goes
    on with the values between the smallest and largest one of the parts that hold the two neighbouring
    ranks. That ends with few values to rank, or with a single one however often it occurs.
    """
    slim = df.select(*[F.when(~F.isnan(c), c.cast("double")).alias(n) for n, c in columns.items()])
    ends = slim.agg(*[f(n).alias(f"{t}_{n}") for n in columns
                      for t, f in (("n", F.count), ("low", F.min), ("high", F.max))]).first()
    targets = [_Target(n, p, ends[f"n_{n}"], ends[f"low_{n}"], ends[f"high_{n}"])
               for n in columns for p in probs if ends[f"n_{n}"]]
    share = max(1000, values // max(1, len(targets)))
    while wide := [t for t in targets if t.inside > share and t.low < t.high]:
        _narrow(slim, wide)
    found = _rank(slim, [t for t in targets if t.low < t.high])
    found |= {(t.name, t.prob): t.low for t in targets if t.low == t.high}
    return {(n, p): found.get((n, p)) for n in columns for p in probs}


def _narrow(slim: DataFrame, targets: list[_Target]) -> None:
    """Shrinks the targets' brackets; targets with the same bracket are counted once."""
    shared: dict[tuple, list[_Target]] = {}
    for t in targets:
        shared.setdefault((t.name, t.low, t.high), []).append(t)
    groups = list(shared.values())
    picks = [f"CASE WHEN {g[0].within()} THEN struct({i} AS g, {g[0].bin()} AS bin, `{g[0].name}` AS v) END"
             for i, g in enumerate(groups)]
    counts = (slim.select(F.expr(f"inline(array_compact(array({', '.join(picks)})))")).groupBy("g", "bin")
              .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
              .collect())   # at most BINS + 2 rows for each bracket
    for i, group in enumerate(groups):
        parts = sorted((r for r in counts if r["g"] == i), key=lambda r: r["bin"])
        for t in group:
            before, held = t.below, []
            for r in parts:
                if before <= t.last and before + r["n"] > t.first:
                    if not held:
                        t.below = before
                    held.append(r)
                before += r["n"]
            t.low, t.high, t.inside = held[0]["low"], held[-1]["high"], sum(r["n"] for r in held)


def _rank(slim: DataFrame, targets: list[_Target]) -> dict[tuple[str, float], float]:
    """The quantiles of brackets that hold few values."""
    if not targets:
        return {}
    picks = [f"CASE WHEN {t.within()} THEN struct({i} AS t, `{t.name}` AS v) END"
             for i, t in enumerate(targets)]
    counts = (slim.select(F.expr(f"inline(array_compact(array({', '.join(picks)})))"))
              .groupBy("t", "v").agg(F.count(F.lit(1)).alias("n")))

    def of_target(values: list[int]) -> Column:
        return F.expr(f"element_at(array({', '.join(f'{v}L' for v in values)}), t + 1)")

    upto = Window.partitionBy("t").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.sum("n").over(upto) + of_target([t.below for t in targets]))

    def at(ranks: list[int]) -> Column:
        rank = of_target(ranks)
        return F.max(F.when((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank), F.col("v")))

    rows = ranked.groupBy("t").agg(at([t.first for t in targets]).alias("a"),
                                   at([t.last for t in targets]).alias("b")).collect()
    out = {}
    for r in rows:
        t = targets[r["t"]]
        out[t.name, t.prob] = r["a"] if r["a"] == r["b"] else r["a"] + (r["b"] - r["a"]) * (t.position - t.first)
    return out


def value_ranks(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, value, n) with ``n_upto`` / ``n_all``: every distinct value with its rank range."""
    c = F.col(value).cast("double")
    counts = (df.filter(c.isNotNull() & ~F.isnan(c)).groupBy(*by, c.alias(value))
              .agg(F.count(F.lit(1)).alias("n")))
    return running_totals(counts, by, [value], ["n"], "value-ranks")


def group_quantiles(ranks: DataFrame, by: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """One row per group with a column per named quantile, from ``value_ranks``."""
    sides = []
    for name, p in probs.items():
        position = F.lit(p) * (F.col("n_all") - 1)
        for side, rank in (("a", F.floor(position)), ("b", F.ceil(position))):
            holds = (F.col("n_upto") > rank) & (F.col("n_upto") - F.col("n") <= rank)
            sides.append(F.max(F.when(holds, F.col(value))).alias(f"{name}_{side}"))
    out = ranks.groupBy(*by).agg(F.max("n_all").alias("n_all"), *sides)
    for name, p in probs.items():
        position = F.lit(p) * (F.col("n_all") - 1)
        a, b = F.col(f"{name}_a"), F.col(f"{name}_b")
        out = out.withColumn(name, a + (b - a) * (position - F.floor(position)))
    return out.select(*by, F.col("n_all").alias("n"), *probs)
