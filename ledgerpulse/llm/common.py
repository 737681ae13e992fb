"""Small helpers shared by the text operators."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def fold(col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % modulus


def packed(names: list[str]) -> Column:
    """The named columns as one struct ``kept``, whose fields have numbers: no name can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)] or [F.lit(0).alias("none")]).alias("kept")


def unpacked(names: list[str]) -> list[Column]:
    """The columns of ``packed`` under their own names again."""
    return [F.col("kept").getField(f"c{k}").alias(c) for k, c in enumerate(names)]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches into small ones, so that Python holds few texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The text column as Python strings, a null as the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def _same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int, keys: list[str]) -> bool:
    return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in keys)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroups key-sorted batches into tables that never split a group of equal keys.

    Holds one batch and the group that is open at its end.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and _same(held[-1], held[-1].num_rows - 1, batch, batch.num_rows - 1, keys):
            held.append(batch)  # the open group goes on past this batch
            continue
        end = batch.num_rows - 1  # first row of the last group
        low, last = 0, batch.num_rows - 1
        while low < end:
            mid = (low + end) // 2
            if _same(batch, mid, batch, last, keys):
                end = mid
            else:
                low = mid + 1
        done = [*held, batch.slice(0, end)]
        if sum(b.num_rows for b in done):
            yield pa.Table.from_batches(done)
        held = [batch.slice(end)]
    if held:
        yield pa.Table.from_batches(held)


def column(data: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    """A column without nulls as a NumPy array."""
    return data.column(name).to_numpy(zero_copy_only=False) if isinstance(data, pa.RecordBatch) \
        else data.column(name).to_numpy()


def starts(*keys: np.ndarray) -> np.ndarray:
    """Indices at which a new run of equal keys begins."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)
