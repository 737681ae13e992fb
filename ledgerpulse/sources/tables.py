"""Lakehouse tables as Parquet folders, partitioned by calendar day where they hold events."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerpulse.schema import TABLES
from ledgerpulse.storage import delete_folder

BATCH = "batch_id"
INSIDE = "_batches"      # file that names the batches of a compacted folder; readers of Parquet pass over it
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def table_path(root: str, table: str) -> str:
    return f"{root}/{table.replace('.', '/')}"


def create_tables(spark: SparkSession, root: str, prefix: str = "", reset: bool = False) -> list[str]:
    """Databases bronze, silver, gold and their seven tables over ``root``, if not there yet.

    ``reset`` drops the catalog entries and deletes the tables' folders first.
    """
    names = []
    for table, (schema, daily) in TABLES.items():
        layer, short = table.split(".")
        db = prefix + layer
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/{layer}'")
        if reset:
            spark.sql(f"DROP TABLE IF EXISTS {db}.{short}")
            delete_folder(spark, table_path(root, table), root)
        columns = schema.fields + ([T.StructField("date", T.DateType()), T.StructField(BATCH, T.LongType())]
                                   if daily else [])
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        parts = f"PARTITIONED BY (date, {BATCH})" if daily else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{short} ({ddl}) USING parquet {parts} "
                  f"LOCATION '{table_path(root, table)}'")
        names.append(f"{db}.{short}")
    return names


def append_rows(df: DataFrame, root: str, table: str, batch_id: int, catalog: str | None = None) -> int:
    """Append one batch and return its row count, observed while writing.

    Folders go by day, then batch: a day is found without listing every batch, and a repeated batch
    replaces its own folders. With ``catalog``, the prefix given to ``create_tables``, the rows go through
    the catalog table, which registers new folders.
    """
    schema, daily = TABLES[table]
    if not daily:
        raise ValueError(f"{table} is replaced as a whole, use overwrite_table")
    written, spark = Observation(), df.sparkSession
    writer = (df.select(*schema.fieldNames(), F.to_date("Time").alias("date"),
                        F.lit(batch_id).cast("bigint").alias(BATCH))
              .observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite"))
    if catalog is None:
        writer.option(OVERWRITE.rsplit(".", 1)[1], "dynamic").partitionBy("date", BATCH).parquet(table_path(root, table))
        return written.get["rows"]
    before = spark.conf.get(OVERWRITE)       # a table insert takes the mode from the session only
    spark.conf.set(OVERWRITE, "dynamic")
    try:
        writer.insertInto(catalog + table)
    finally:
        spark.conf.set(OVERWRITE, before)
    return written.get["rows"]


def overwrite_table(df: DataFrame, root: str, table: str, catalog: str | None = None) -> int:
    """Replace the whole table and return its row count."""
    schema, _ = TABLES[table]
    written = Observation()
    (df.select(*schema.fieldNames()).observe(written, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").parquet(table_path(root, table)))
    if catalog is not None:
        df.sparkSession.catalog.refreshTable(catalog + table)
    return written.get["rows"]


def compact_day(spark: SparkSession, root: str, table: str, day: str, batch_id: int = -1, catalog: str | None = None) -> None:
    """Merge one day's batches into a single one, ``batch_id``; for days that no batch writes any more.

    The merged rows are written to a folder no reader sees, then the old folders go and it takes their place, so no
    row is ever read twice. A call that was interrupted is finished by the next one. With ``catalog``, the prefix given to
    ``create_tables``, the table's partitions are changed as well.
    """
    folder = f"{table_path(root, table)}/date={day}"
    hidden, path = f"{folder}/_merged", spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(folder)):
        return
    old = [int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(path(folder))
           if f.getPath().getName().startswith(f"{BATCH}=")]        # folders of one day
    if not fs.exists(path(f"{hidden}/_SUCCESS")):
        if not old or old == [batch_id]:
            return
        rows = read_table(spark, root, table).where(F.col("date") == F.lit(day).cast("date"))
        inside = sorted({c for b in old for c in merged_batches(spark, root, table, day, b) or {b}})
        rows.drop("date", BATCH).repartition(max(1, len(old) // 8)).write.mode("overwrite").parquet(hidden)
        note = fs.create(path(f"{hidden}/{INSIDE}"), True)
        note.write(bytearray(" ".join(map(str, inside)), "ascii"))
        note.close()
    for b in old:
        delete_folder(spark, f"{folder}/{BATCH}={b}", table_path(root, table))
    fs.rename(path(hidden), path(f"{folder}/{BATCH}={batch_id}"))
    if catalog is not None:
        name = catalog + table
        for b in old:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (date = DATE'{day}', {BATCH} = {b})")
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (date = DATE'{day}', {BATCH} = {batch_id}) "
                  f"LOCATION '{folder}/{BATCH}={batch_id}'")
        spark.catalog.refreshTable(name)


def merged_batches(spark: SparkSession, root: str, table: str, day: str, batch_id: int) -> set[int]:
    """The batches a compacted folder was made of; empty for the folder of a batch."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{table_path(root, table)}/date={day}/{BATCH}={batch_id}/{INSIDE}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if batch_id >= 0 or not fs.exists(path):
        return set()
    stream = fs.open(path)
    try:
        return set(map(int, jvm.org.apache.commons.io.IOUtils.toString(stream, "US-ASCII").split()))
    finally:
        stream.close()


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    schema, daily = TABLES[table]
    if daily:
        schema = T.StructType([*schema.fields, T.StructField("date", T.DateType()),
                               T.StructField(BATCH, T.LongType())])
    return spark.read.schema(schema).parquet(table_path(root, table))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
