"""Isolation forest: rows choose their trees by hash, nodes their splits, trees grow in parallel."""

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.models import forest_table
from ledgerpulse.models.base import Detector, inputs, score_all, share
from ledgerpulse.operators.quantiles import exact_quantiles
from ledgerpulse.storage import materialize

AUTO_SAMPLES = 256
GROWN_ALONE = 65_536      # rows below a node from which on one task grows its subtree
RANGE = 1 << 40           # hash range that sampling tickets are drawn from
LEAF, OPEN = -1, -2       # OPEN: the walk goes on in the table of lower nodes
NODE = "tree int, node bigint, feature int, threshold double, n bigint"


def unsuccessful_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of a failed search in a binary tree of n rows."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    m = np.where(big, n, 3.0)
    return np.where(big, 2.0 * (np.log(m - 1.0) + np.euler_gamma) - 2.0 * (m - 1.0) / m, out)


def _mixed(*parts: int) -> int:
    """64 bits that depend on all parts alike."""
    x = 0
    for part in parts:
        x = (x + part + 0x9E3779B97F4A7C15) % 2**64
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
        x ^= x >> 31
    return x


def chosen_split(seed: int, tree: int, node: int, low: np.ndarray, high: np.ndarray) -> tuple[int, float] | None:
    """Feature and threshold of a node, by hash of its place and from the range of its rows alone."""
    splittable = np.flatnonzero(high > low)
    if not len(splittable):
        return None
    feature = int(splittable[_mixed(seed, tree, node, 1) % len(splittable)])
    part = (_mixed(seed, tree, node, 2) >> 11) / 2**53
    threshold = float(low[feature] + part * (high[feature] - low[feature]))
    return (feature, threshold) if threshold < high[feature] else None


def grow(x: np.ndarray, seed: int, tree: int, top: int, limit: int) -> list[tuple[int, int, float, int]]:
    """The subtree below node ``top`` as (node, feature, threshold, n). Node k has the children 2k and 2k + 1."""
    nodes, todo = [], [(top, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        split = None
        if len(rows) > 1 and node.bit_length() - 1 < limit:
            split = chosen_split(seed, tree, node, x[rows].min(axis=0), x[rows].max(axis=0))
        if split is None:
            nodes.append((node, LEAF, 0.0, len(rows)))
            continue
        nodes.append((node, *split, len(rows)))
        left = x[rows, split[0]] <= split[1]
        todo += [(2 * node, rows[left]), (2 * node + 1, rows[~left])]
    return nodes


def linked(nodes: pd.DataFrame, held: int | None = None) -> np.ndarray:
    """One tree's nodes as rows (feature, threshold, left, right, n), children by row number.

    Splits at depth ``held`` have no children here; they are open and carry their node in place of the left child.
    """
    nodes = nodes.sort_values("node")
    ids = nodes["node"].to_numpy()
    inner = nodes["feature"].to_numpy() >= 0
    out = np.full((len(nodes), 5), float(LEAF))
    out[:, 0], out[:, 1], out[:, 4] = nodes["feature"], nodes["threshold"], nodes["n"]
    if held is not None:
        opened = inner & (ids >= 1 << held)
        out[opened] = np.column_stack([np.full(opened.sum(), [OPEN]), np.zeros(opened.sum()), ids[opened],
                                       np.full(opened.sum(), LEAF), np.zeros(opened.sum())])
        inner &= ~opened
    for side in (0, 1):
        out[inner, 2 + side] = np.searchsorted(ids, 2 * ids[inner] + side)
    return out


class IsolationForest(Detector):
    """Score above 0 for the ``contamination`` share that is isolated fastest.

    Explanation: features met on the paths, weighted by 1 / (depth + 1). The trees are shipped to the
    scoring tasks down to the depth at which all levels together have at most ``max_nodes`` nodes. Lower nodes stay a
    table, and rows that get there walk on by joins; scores are the same on both ways but for rounding.
    """

    name = "if"

    def __init__(self, columns=None, n_estimators: int = 100, max_samples: int | float | str = "auto",
                 contamination: float = 0.001, random_state: int = 42, max_nodes: int = 2_000_000):
        kwargs = {} if columns is None else {"columns": columns}
        super().__init__(**kwargs, n_estimators=n_estimators, max_samples=max_samples,
                         contamination=contamination, random_state=random_state, max_nodes=max_nodes)
        self.trees: list[np.ndarray] = []
        self.tree_ids: list[int] = []
        self.held: int | None = None          # depth of the open nodes, None if all nodes are in the arrays
        self.below: DataFrame | None = None   # table of the nodes below it
        self.samples = 0
        self.offset = 0.0

    def _sample_size(self, rows: int) -> int:
        """Rows a tree is expected to draw; a fraction refers to all rows."""
        asked = self.params["max_samples"]
        size = (min(AUTO_SAMPLES, rows) if asked == "auto"
                else int(asked * rows) if isinstance(asked, float) else min(asked, rows))
        return max(size, 1)

    def samples_per_tree(self, rows: DataFrame, total: int) -> DataFrame:
        """(tree, row) pairs: a row joins every tree for which its ticket, a hash, lies below a bound.

        The bound alone decides, at any size and for any partitioning, so a tree's sample has about the
        asked size, and exactly all rows where all are asked for.
        """
        trees, seed = self.params["n_estimators"], self.params["random_state"]
        keep = RANGE if self.samples >= total else int(RANGE * self.samples / total)
        member = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.pmod(
            F.xxhash64("_id", F.lit(seed), t), F.lit(RANGE)) < keep)
        return rows.select(F.explode(member).alias("tree"), *self.columns)

    def tree_nodes(self, pairs: DataFrame) -> DataFrame:
        """(tree, node, feature, threshold, n) of all trees.

        Nodes with more than ``GROWN_ALONE`` rows are split level by level over all tasks; subtrees below
        are grown in one task each, by the same rule, so that bound changes no tree.
        """
        columns, seed, limit = self.columns, self.params["random_state"], self.limit
        settled = []
        pairs = pairs.withColumn("node", F.lit(1).cast("bigint"))

        def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for block in batches:
                out = []
                for r in block.itertuples(index=False):
                    values = np.array(r[3:], dtype=float).reshape(2, -1)
                    found = chosen_split(seed, r.tree, r.node, *values) if r.node.bit_length() - 1 < limit else None
                    out.append((r.tree, r.node, *(found or (LEAF, 0.0)), r.n))
                yield pd.DataFrame(out, columns=["tree", "node", "feature", "threshold", "n"])

        while True:
            large = (pairs.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"), *[
                f(c).alias(f"{side}{i}") for side, f in (("low", F.min), ("high", F.max)) for i, c in enumerate(columns)])
                .where(F.col("n") > GROWN_ALONE))
            cut = materialize(large.mapInPandas(split, NODE), "forest-level")
            if cut.isEmpty():
                break
            settled.append(cut)
            chosen = cut.select("tree", "node", "feature", "threshold")
            value = F.element_at(F.array(*columns), F.col("feature") + 1)
            below = F.when(F.col("feature").isNull(), F.col("node")).otherwise(
                2 * F.col("node") + F.when(value <= F.col("threshold"), 0).otherwise(1))
            pairs = materialize(pairs.join(chosen, ["tree", "node"], "left").where("feature IS NULL OR feature >= 0")
                                .select("tree", *columns, below.alias("node")), "forest-rows")

        def subtree(sample: pd.DataFrame) -> pd.DataFrame:
            tree, top = int(sample["tree"].iloc[0]), int(sample["node"].iloc[0])
            nodes = grow(sample[columns].to_numpy(dtype=float), seed, tree, top, limit)
            return pd.DataFrame([(tree, *n) for n in nodes], columns=["tree", "node", "feature", "threshold", "n"])

        small = pairs.groupBy("tree", "node").applyInPandas(subtree, NODE)
        return reduce(DataFrame.unionByName, [*settled, small])

    def fit(self, df, id_col="TransactionID", written=False):
        rows = self.training_rows(df, id_col, written)
        total = rows.count()
        self.samples = self._sample_size(total)
        nodes = materialize(self.tree_nodes(self.samples_per_tree(rows, total)), "forest-nodes")
        self.held = forest_table.held_depth(nodes, self.params["max_nodes"])
        self.below = None if self.held is None else nodes
        table = (nodes if self.held is None else nodes.where(F.col("node") < 2 << self.held)).toPandas()   # max_nodes at most
        grouped = list(table.groupby("tree"))
        self.tree_ids = [int(tree) for tree, _ in grouped]
        self.trees = [linked(g, self.held) for _, g in grouped]
        self.offset = 0.0
        raw = materialize(score_all(rows, {"raw": self}, explain=False).select("raw_score"), "forest-scores")
        share_below = self.params["contamination"]
        cut = exact_quantiles(raw, {"s": -F.col("raw_score")}, [share_below])["s", share_below]
        self.offset = cut
        return self

    @property
    def limit(self) -> int:
        """Depth at which a tree ends."""
        return math.ceil(math.log2(max(self.samples, 2)))

    def _lengths(self, x: np.ndarray, weight: np.ndarray | None = None, opened: list | None = None) -> np.ndarray:
        """Path lengths of a block, summed over the trees; on request adds 1 / (depth + 1) to ``weight`` at every split
        passed, and (tree, row, node) of the walks that end in open nodes to ``opened``."""
        depth_sum, row = np.zeros(len(x)), np.arange(len(x))
        for number, tree in enumerate(self.trees):
            feature, left, right = (tree[:, j].astype(int) for j in (0, 2, 3))
            # path length if a walk ends in this node, counted from the node on
            ends = unsuccessful_path(tree[:, 4])
            node, depth, who = np.zeros(len(x), dtype=int), 0, row[:len(x) if feature[0] >= 0 else 0]
            while len(who):
                at = node[who]
                split = feature[at]
                if weight is not None:
                    weight[who, split] += 1.0 / (depth + 1)
                node[who] = np.where(x[who, split] <= tree[at, 1], left[at], right[at])
                depth_sum[who] += 1.0
                depth += 1
                who = who[feature[node[who]] >= 0]
            depth_sum += ends[node]
            if opened is not None:
                on = np.flatnonzero(feature[node] == OPEN)
                opened.append((np.full(len(on), self.tree_ids[number]), on, left[node[on]]))
        return depth_sum

    @property
    def usual(self) -> float:
        """Sum over the trees of the path length that scores one half."""
        return float(unsuccessful_path(np.array([self.samples]))[0]) * len(self.trees)

    def _walk(self, x: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        if self.in_table:
            raise ValueError("this forest has nodes outside its arrays; score it with score_all")
        lengths = self._lengths(x, weight)
        return (2.0 ** (-lengths / self.usual) if self.usual else np.ones(len(x))) + self.offset

    @property
    def in_table(self):
        return self.held is not None

    def open_block(self, x, explain):
        """Path lengths, weights, and per row the trees and nodes in which its walk is open."""
        weight, opened = np.zeros(x.shape) if explain else None, []
        lengths = self._lengths(x, weight, opened)
        tree, row, node = (np.concatenate(part).astype(np.int64) for part in zip(*opened, strict=True))
        order = np.argsort(row, kind="stable")
        cuts = np.searchsorted(row[order], np.arange(1, len(x)))
        return lengths, weight, np.split(tree[order], cuts), np.split(node[order], cuts)

    def finished(self, rows, explain):
        width = len(self.columns)
        open_rows = (rows.select("_row", "x", "trees", F.posexplode("nodes").alias("at", "node"))
                     .select("_row", "x", F.get("trees", "at").cast("int").alias("tree"), "node"))
        parts = forest_table.walked(open_rows, self.below, self.held, width, explain)
        done = forest_table.summed(rows.drop("x", "trees", "nodes"), parts, explain)
        out = [(F.pow(F.lit(2.0), -F.col("length") / self.usual) + self.offset).alias("score")]
        if explain:
            total = F.aggregate("weight", F.lit(0.0), lambda a, w: a + w) + 1e-8
            out.append(F.transform("weight", lambda w: w / total).alias("share"))
        return done.select("_row", *out)

    def score_block(self, x):
        return self._walk(x)

    def explain_block(self, x):
        weight = np.zeros(x.shape)
        return self._walk(x, weight), share(weight)

    def arrays(self):
        ids = self.tree_ids or range(len(self.trees))
        numbered = [np.column_stack([np.full(len(t), i), t]) for i, t in zip(ids, self.trees, strict=True)]
        held = LEAF if self.held is None else self.held
        return {"trees": np.vstack(numbered), "fixed": np.array([[self.samples, self.offset, held]])}

    def restore(self, arrays):
        trees = arrays["trees"]
        self.tree_ids = [int(i) for i in np.unique(trees[:, 0])]
        self.trees = [trees[trees[:, 0] == i, 1:] for i in self.tree_ids]
        fixed = arrays["fixed"][0]
        self.samples, self.offset = int(fixed[0]), float(fixed[1])
        self.held = int(fixed[2]) if len(fixed) > 2 and fixed[2] >= 0 else None

    def save(self, spark, path):
        super().save(spark, path)
        if self.in_table:
            self.below.write.mode("overwrite").parquet(f"{path}/nodes")

    def load_tables(self, spark, path):
        self.below = spark.read.parquet(f"{path}/nodes") if self.in_table else None

    def __getstate__(self):
        return {**self.__dict__, "below": None}   # tasks walk the arrays alone
