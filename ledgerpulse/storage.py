"""Where intermediate tables go: the shared folder the cluster names in spark.checkpoint.dir."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """Shared folder for written tables. A temporary one is made only on a local master."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerpulse-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unused path under the shared folder."""
    return f"{shared_root(spark)}/ledgerpulse/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage on storage that outlives an executor, and fixes every value (a partition
    number above all) so that several readers see the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str, below: str) -> None:
    """Delete a folder that lies below another one, on whatever storage holds it."""
    root = below.rstrip("/") + "/"
    if not path.startswith(root) or ".." in path:
        raise ValueError(f"{path} does not lie below {below}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def owned(spark: SparkSession) -> Iterator:
    """A ``materialize`` whose tables are deleted at the end of the block, when their readers are done."""
    paths = []

    def write(df: DataFrame, tag: str) -> DataFrame:
        paths.append(scratch_path(spark, tag))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield write
    finally:
        for path in paths:
            delete_folder(spark, path, f"{shared_root(spark)}/ledgerpulse")
