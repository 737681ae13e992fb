"""Labelled evaluation of anomaly scores: ROC and precision-recall curves, F1, ensembles."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.operators.prefix import running_totals
from ledgerpulse.operators.quantiles import exact_quantiles
from ledgerpulse.storage import materialize


def curve(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score, taken as threshold (score >= threshold is predicted positive).

    Columns: threshold, pos, cnt (rows at the threshold), tp, predicted, positives, rows.
    """
    at = (scored.groupBy(F.col(score).alias("threshold"))
          .agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("cnt")))
    return running_totals(at, [], [F.desc("threshold")], ["pos", "cnt"], "curve").select(
        "threshold", "pos", "cnt", F.col("pos_upto").alias("tp"), F.col("cnt_upto").alias("predicted"),
        F.col("pos_all").alias("positives"), F.col("cnt_all").alias("rows"))


def roc_points(points: DataFrame) -> DataFrame:
    """False and true positive rate per threshold."""
    negatives = F.col("rows") - F.col("positives")
    return points.select("threshold",
                         F.try_divide(F.col("predicted") - F.col("tp"), negatives).alias("fpr"),
                         F.try_divide("tp", "positives").alias("tpr"))


def pr_points(points: DataFrame) -> DataFrame:
    """Precision and recall per threshold."""
    return points.select("threshold", (F.col("tp") / F.col("predicted")).alias("precision"),
                         F.try_divide("tp", "positives").alias("recall"))


def curve_metrics(points: DataFrame) -> DataFrame:
    """One row: roc_auc, pr_auc (step form), best f1 with its precision, recall and threshold."""
    tp, pos, cnt, positives = (F.col(c) for c in ("tp", "pos", "cnt", "positives"))
    negatives = F.col("rows") - positives
    trapezoid = F.try_divide((cnt - pos) * (tp + tp - pos) / 2.0, positives * negatives)
    precision = tp / F.col("predicted")
    recall = F.try_divide(tp, positives)
    step = F.try_divide(pos, positives) * precision
    f1 = 2 * precision * recall / (precision + recall + F.lit(1e-10))
    # the lowest threshold wins among equal f1
    best = F.max(F.struct(f1.alias("f1"), (-F.col("threshold")).alias("low"),
                          precision.alias("precision"), recall.alias("recall")))
    return (points.agg(F.sum(trapezoid).alias("roc_auc"), F.sum(step).alias("pr_auc"),
                       best.alias("best"), F.max(F.try_divide(positives, F.col("rows"))).alias("base_rate"))
            .select("roc_auc", "pr_auc", "best.f1", "best.precision", "best.recall",
                    (-F.col("best.low")).alias("threshold"), "base_rate"))


def percentile_metrics(scored: DataFrame, score: str, label: str, prob: float = 0.95) -> DataFrame:
    """Precision, recall and F1 when scores strictly above the percentile are flagged."""
    threshold = exact_quantiles(scored, {score: F.col(score)}, [prob])[score, prob]
    flagged = F.col(score) > threshold
    hits = scored.agg(F.count_if(flagged & (F.col(label) == 1)).alias("tp"),
                      F.count_if(flagged).alias("flagged"),
                      F.count_if(F.col(label) == 1).alias("positives"))
    return hits.select(F.lit(threshold).alias("threshold"), *_precision_recall_f1())


def _precision_recall_f1() -> list:
    """Undefined ratios count as 0."""
    precision = F.coalesce(F.try_divide("tp", "flagged"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("tp", "positives"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), F.col("flagged") + F.col("positives")), F.lit(0.0))
    return [precision.alias("precision"), recall.alias("recall"), f1.alias("f1")]


def blend(df: DataFrame, weights: dict[str, float], name: str = "ensemble") -> DataFrame:
    """Weighted sum of score columns."""
    return df.withColumn(name, F.expr(weighted(weights)))


def weighted(weights: dict[str, float]) -> str:
    return " + ".join(f"({w!r}D * `{c}`)" for c, w in weights.items())


def weight_grid(step: float) -> list[tuple[float, float, float]]:
    """All weight triples on the simplex, first weight slowest, both ascending."""
    n = round(1 / step)
    return [(i * step, j * step, max(0.0, 1.0 - i * step - j * step))
            for i in range(n + 1) for j in range(n + 1 - i)]


PARTS, FEW = 256, 512      # parts a bracket is counted in; rows at which its values are listed
CELLS = 4_000_000          # counters of a pass over the rows, for each task and on the driver
CHUNK = 1024               # counters in a row of sums
ROWS = 2_000_000           # rows a task blends
SEARCH_SCHEMA = ("w1 double, w2 double, w3 double, threshold double, precision double, recall double, f1 double, "
                 "roc_auc double, pr_auc double, best boolean")


def _blended(weights: np.ndarray, columns: list[np.ndarray]) -> Iterator[np.ndarray]:
    for w in weights:
        yield w[0] * columns[0] + w[1] * columns[1] + w[2] * columns[2]


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in ("s1", "s2", "s3")]


def _summed(rows: DataFrame, width: int) -> np.ndarray:
    """Sums of the tasks' counters, given as (k, blob): chunk ``k`` of ``CHUNK`` counters. At most ``width`` reach the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in batches:
            for k, blob in zip(batch.column("k").to_pylist(), batch.column("blob"), strict=True):
                part = np.frombuffer(blob.as_buffer(), np.int64)
                if k == key:
                    total = total + part
                    continue
                if key is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([total.tobytes()])], ["k", "blob"])
                key, total = k, part
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([total.tobytes()])], ["k", "blob"])

    out = np.zeros(-(-width // CHUNK) * CHUNK, np.int64)
    for r in rows.repartition("k").sortWithinPartitions("k").mapInArrow(add, "k bigint, blob binary").collect():
        out[r["k"] * CHUNK:(r["k"] + 1) * CHUNK] = np.frombuffer(bytes(r["blob"]), np.int64)
    return out[:width]


def blend_sums(slim: DataFrame, width: int, count) -> np.ndarray:
    """Sum of ``count(batch, total)`` over all rows: each task adds into one array of ``width`` counters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(-(-width // CHUNK) * CHUNK, np.int64)
        for batch in batches:
            count(batch, total)
        for k, part in enumerate(total.reshape(-1, CHUNK)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([part.tobytes()])], ["k", "blob"])

    return _summed(slim.mapInArrow(run, "k bigint, blob binary"), width)


def blend_ranks(slim: DataFrame, grid: list[tuple], ranks: list[int]) -> np.ndarray:
    """Blends x ranks: the value of each rank (from 0) of each blend.

    Each has a bracket of its own, counted in ``PARTS`` parts of equal width between its least and its greatest value; the
    part with the rank is the next bracket, until it holds ``FEW`` rows or a single value. Then its values are listed.
    """
    weights, shape = np.array(grid), (len(grid), len(ranks))
    low, high = np.zeros(shape), np.zeros(shape)
    ends = np.stack([np.full(shape, -np.inf), np.full(shape, np.inf)], axis=-1)     # a bracket holds ends[0] <= x < ends[1]
    below, held = np.zeros(shape, np.int64), np.full(shape, FEW + 1)

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, most = np.full(shape, np.inf), np.full(shape, -np.inf)
        for batch in batches:
            for b, x in enumerate(_blended(weights, _columns(batch))):
                for r in np.flatnonzero(held[b] > FEW):
                    own = x[(x >= ends[b, r, 0]) & (x < ends[b, r, 1])]
                    if len(own):
                        least[b, r], most[b, r] = min(least[b, r], own.min()), max(most[b, r], own.max())
        q = np.flatnonzero(least.ravel() < np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(least.ravel()[q]), pa.array(most.ravel()[q])], ["q", "low", "high"])

    while (held > FEW).any():
        found = slim.mapInArrow(extremes, "q bigint, low double, high double").groupBy("q").agg(
            F.min("low").alias("low"), F.max("high").alias("high")).collect()      # a row for each bracket
        for q, a, b in found:
            low.flat[q], high.flat[q] = a, b
        held[low >= high] = 0                                                      # of a single value
        open_ = held > FEW
        if not open_.any():
            break
        edges = np.linspace(low, high, PARTS + 1, axis=-1)
        edges[..., 0], edges[..., -1] = ends[..., 0], ends[..., 1]

        def count(batch, total, edges=edges, open_=open_):
            total = total[:open_.size * PARTS].reshape(*shape, PARTS)
            for b, x in enumerate(_blended(weights, _columns(batch))):
                for r in np.flatnonzero(open_[b]):
                    if r and (edges[b, r] == edges[b, r - 1]).all():
                        total[b, r] = total[b, r - 1]
                        continue
                    at = np.searchsorted(edges[b, r], x, "right") - 1
                    at = at[(at >= 0) & (at < PARTS)]
                    total[b, r] += np.bincount(at, minlength=PARTS)

        counts = blend_sums(slim, below.size * PARTS, count).reshape(*shape, PARTS)
        for b, r in zip(*np.nonzero(open_), strict=True):
            upto = below[b, r] + counts[b, r].cumsum()
            k = int(np.searchsorted(upto, ranks[r], "right"))
            held[b, r], below[b, r] = counts[b, r, k], upto[k] - counts[b, r, k]
            ends[b, r] = edges[b, r, k:k + 2]

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, x in enumerate(_blended(weights, _columns(batch))):
                for r in range(len(ranks)):
                    v, n = np.unique(x[(x >= ends[b, r, 0]) & (x < ends[b, r, 1])], return_counts=True)
                    if len(v):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), b * len(ranks) + r)), pa.array(v), pa.array(n)],
                                                         ["q", "v", "n"])

    listed = slim.mapInArrow(values, "q bigint, v double, n bigint").groupBy("q", "v").agg(F.sum("n").alias("n"))
    frame = listed.toPandas().sort_values(["q", "v"])      # a few values of each bracket
    out = np.zeros(shape)
    for q, part in frame.groupby("q"):
        b, r = divmod(int(q), len(ranks))
        at = np.searchsorted(below[b, r] + part["n"].to_numpy().cumsum(), ranks[r], "right")
        out[b, r] = part["v"].to_numpy()[at]
    return out


def exact_areas(slim: DataFrame, grid: list[tuple], cells: int | None = None) -> list[tuple[float | None, float | None]]:
    """ROC-AUC and PR-AUC (step form) of each blend over its own distinct values.

    Both areas change only at the values of positives, so a blend needs the rows at each of these values and
    between two of them. Tasks hold the distinct positives and ``cells`` such counters; with more of them, the blends are
    counted in several passes, and where one blend alone has more, each blend's curve is sorted by Spark.
    """
    cells = cells or CELLS
    spark, weights = slim.sparkSession, np.array(grid)
    some = slim.where("hit").groupBy("s1", "s2", "s3").agg(F.count("*").alias("n"))
    if some.limit(cells // 2 + 1).count() > cells // 2:
        out = []
        for w in grid:
            value = " + ".join(f"{x!r}D * {c}" for x, c in zip(w, ("s1", "s2", "s3"), strict=True))
            row = curve_metrics(curve(slim.select(F.expr(value).alias("v"), F.col("hit").cast("int").alias("y")), "v", "y")).first()
            out.append((row["roc_auc"], row["pr_auc"]))
        return out
    frame = some.toPandas()
    times = frame["n"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast([frame[c].to_numpy(np.float64) for c in ("s1", "s2", "s3")])
    width, positives = 2 * len(frame) + 1, int(times.sum())
    out = []
    for first in range(0, len(grid), max(1, cells // width)):
        part = weights[first:first + max(1, cells // width)]

        def count(batch, total, part=part, own=[]):  # noqa: B006  the sorted values, made once in a task
            if not own:
                own.extend(np.unique(u) for u in _blended(part, shared.value))
            for b, x in enumerate(_blended(part, _columns(batch))):
                u = own[b]
                at = np.searchsorted(u, x)
                tied = u[np.minimum(at, len(u) - 1)] == x if len(u) else np.zeros(len(x), bool)
                total[b * width:(b + 1) * width] += np.bincount(2 * at + tied, minlength=width)

        counts = blend_sums(slim, len(part) * width, count).reshape(len(part), width)
        for c, x in zip(counts, _blended(part, shared.value), strict=True):
            u, place = np.unique(x, return_inverse=True)
            pos = np.bincount(place, times, len(u)).astype(np.int64)
            n, here = int(c.sum()), c[1:2 * len(u):2]
            under = c[:2 * len(u)].cumsum()[::2]                       # rows below each value
            tp = positives - pos.cumsum() + pos
            negatives = n - positives
            lower = under - (positives - tp)                          # negatives below
            roc = float((pos * (lower + (here - pos) / 2.0)).sum() / (positives * negatives)) if positives and negatives else None
            out.append((roc, float((pos / positives * (tp / np.maximum(n - under, 1))).sum()) if positives else None))
    shared.unpersist()
    return out


def ensemble_search(scored: DataFrame, scores: tuple[str, str, str], label: str,
                    step: float = 0.05, prob: float = 0.95) -> DataFrame:
    """One row per weight triple: F1 at the exact percentile threshold, exact ROC-AUC and PR-AUC.

    Every pass adds up its counters for all blends in a task's array, so rows are never multiplied by the grid.
    ``best`` marks the first maximum of F1. Rows without all scores are left out; scores are finite.
    """
    spark, grid = scored.sparkSession, weight_grid(step)
    weights = np.array(grid)
    slim = scored.select(*[F.col(c).cast("double").alias(f"s{k}") for k, c in enumerate(scores, 1)],
                         F.coalesce(F.col(label) == 1, F.lit(False)).alias("hit")).dropna()
    every = slim.agg(F.count("*").alias("n"), F.count_if("hit").alias("positives")).first()
    n, positives = every["n"], every["positives"]
    if not n:
        return spark.createDataFrame([(*w, None, 0.0, 0.0, 0.0, None, None, False) for w in grid], SEARCH_SCHEMA)
    # three numbers a row, spread over all cores for the passes of all blends
    slim = materialize(slim.repartition(max(spark.sparkContext.defaultParallelism, n // ROWS)), "blend-rows")
    position = prob * (n - 1)
    near = blend_ranks(slim, grid, [math.floor(position), math.ceil(position)])
    cut = near[:, 0] + (near[:, 1] - near[:, 0]) * (position - math.floor(position))

    def above(batch, total):
        hit = batch.column("hit").to_numpy(zero_copy_only=False).astype(bool)
        for b, x in enumerate(_blended(weights, _columns(batch))):
            flag = x > cut[b]
            total[2 * b] += flag.sum()
            total[2 * b + 1] += (flag & hit).sum()

    flags = blend_sums(slim, 2 * len(grid), above).reshape(-1, 2).tolist()
    out = []
    for w, c, (flagged, tp), areas in zip(grid, cut.tolist(), flags, exact_areas(slim, grid), strict=True):
        out.append([*w, c, tp / flagged if flagged else 0.0, tp / positives if positives else 0.0,
                    2 * tp / (flagged + positives) if flagged + positives else 0.0, *areas, False])
    best = max(out, key=lambda x: x[6])   # the first of equal ones
    best[9] = best[6] > 0
    return spark.createDataFrame([tuple(o) for o in out], SEARCH_SCHEMA)
