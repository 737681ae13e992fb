"""Running totals over a total order, without sorting everything in one task."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.storage import materialize


def running_totals(df: DataFrame, by: list[str], order: list[str | Column], sums: list[str],
                   tag: str = "ranged") -> DataFrame:
    """For each ``s`` in ``sums`` adds ``s_upto`` (this row and all before it) and ``s_all``.

    Rows are range-partitioned by (by, order), so even one group spreads over many slices. Each
    slice sums its own rows; the totals of the slices before it, one row per slice and group,
    are added on top.
    """
    ranged = materialize(
        df.repartitionByRange(*by, *order).withColumn("_slice", F.spark_partition_id()), tag)
    earlier = (Window.partitionBy(*by).orderBy("_slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy(*by)
    offsets = (ranged.groupBy(*by, "_slice").agg(*[F.sum(s).alias(s) for s in sums])
               .select(*[F.col(b).alias(f"_by_{b}") for b in by], F.col("_slice").alias("_at"),
                       *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_{s}_before") for s in sums],
                       *[F.sum(s).over(whole).alias(f"{s}_all") for s in sums]))
    same = reduce(and_, [F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by],
                  F.col("_slice") == F.col("_at"))
    local = (Window.partitionBy(*by, "_slice").orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ranged.join(offsets, same)
            .withColumns({f"{s}_upto": F.sum(s).over(local) + F.col(f"_{s}_before") for s in sums})
            .select(*df.columns, "_slice", *[f"{s}_{e}" for s in sums for e in ("upto", "all")]))
