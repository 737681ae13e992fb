"""Connected components of an edge table, by alternating star contractions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.storage import materialize


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller end."""
    return (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _is_forest(edges: DataFrame) -> bool:
    """Every node points to one node that points nowhere."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return (ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
            .where("out > 1 OR (out = 1 AND into = 1)").isEmpty())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that is not the smallest of its component.

    A large star hangs every larger neighbour of a node, a small star every smaller one, under the
    smallest; both keep components whole and end in stars. The rounds grow with the logarithm of a
    component's width, each is written to shared storage, and minima are combined before a shuffle. They are
    written before they are joined, so that the join deals its rows anew and can split a node of many edges.
    """
    now = materialize(_oriented(edges), "edges")
    while not _is_forest(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = materialize(least, "least-neighbours")
        large = _oriented(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = materialize(large, "edges")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least-neighbours")
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now = materialize(_oriented(small), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
