"""A forest too large for scoring tasks: its upper levels are arrays, its lower levels a table that rows walk by joins."""

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.storage import materialize, owned


def held_depth(nodes: DataFrame, max_nodes: int) -> int | None:
    """The greatest depth down to which all nodes are at most ``max_nodes``; None if that is all of them.

    The roots are always held, at one node for each tree.
    """
    depth = (F.length(F.bin("node")) - 1).alias("depth")
    counts = sorted(nodes.groupBy(depth).count().collect())   # one row for each level, 63 at most
    total, held = 0, 0
    for level, n in counts:
        total += n
        if total <= max_nodes:
            held = level
    return None if total <= max_nodes else held


def unsuccessful_path(n: Column) -> Column:
    """Mean path length of a failed search in a binary tree of n rows."""
    m = n.cast("double")
    return (F.when(m > 2, 2.0 * (F.log(m - 1.0) + float(np.euler_gamma)) - 2.0 * (m - 1.0) / m)
            .when(m == 2, 1.0).otherwise(0.0))


def walked(open_rows: DataFrame, nodes: DataFrame, depth: int, width: int, explain: bool) -> DataFrame:
    """(_row, parts): for each row its open trees in order, with the path length from ``depth`` on and, on request, the
    weights of the ``width`` features met there.

    ``open_rows`` has (_row, x, tree, node): inputs as an array and the node of ``depth`` that the walk has reached. Each level is
    an equi-join on (tree, node) with the nodes of that level alone; rows and trees that have ended leave. A level
    has at least as many keys as the nodes held in arrays, unless most walks have ended; what stays hot is split by the skew join.
    """
    extra = ["weight"] if explain else []
    with owned(open_rows.sparkSession) as write:
        zeros = F.array(*[F.lit(0.0)] * width)
        going = open_rows.withColumn("weight", zeros) if explain else open_rows
        ended, level = [], depth
        while True:
            here = nodes.where((F.col("node") >= 1 << level) & (F.col("node") < 1 << (level + 1)))
            passed = F.lit(1.0 / (level + 1))
            right = F.when(F.element_at("x", F.greatest("feature", F.lit(0)) + 1) <= F.col("threshold"), 0).otherwise(1)
            met = F.transform("weight", lambda w, i: F.when(i == F.col("feature"), w + passed).otherwise(w)) if explain else None
            step = write(going.join(here, ["tree", "node"]).select(
                "_row", "x", "tree", "feature", "n", (2 * F.col("node") + right).alias("node"),
                *([met.alias("weight")] if explain else [])), "forest-walk")
            length = F.lit(float(level - depth)) + unsuccessful_path(F.col("n"))
            ended.append(step.where("feature < 0").select("_row", "tree", length.alias("length"), *extra))
            going = step.where("feature >= 0").select("_row", "x", "tree", "node", *extra)
            if going.isEmpty():
                break
            level += 1
        parts = reduce(DataFrame.unionByName, ended).groupBy("_row").agg(
            F.array_sort(F.collect_list(F.struct("tree", "length", *extra))).alias("parts"))   # one entry for each tree
        return materialize(parts, "forest-walked")


def summed(rows: DataFrame, parts: DataFrame, explain: bool) -> DataFrame:
    """(_row, length, weight) of all rows: what the upper levels gave, and the parts added in the order of the trees."""
    both = rows.join(parts, "_row", "left")
    none = F.col("parts").isNull()
    length = F.aggregate("parts", F.col("length"), lambda total, p: total + p["length"])
    out = [F.when(none, F.col("length")).otherwise(length).alias("length")]
    if explain:
        weight = F.aggregate("parts", F.col("weight"), lambda total, p: F.zip_with(total, p["weight"], lambda a, b: a + b))
        out.append(F.when(none, F.col("weight")).otherwise(weight).alias("weight"))
    return both.select("_row", *out)
