"""Operator 9: Order MinHash fingerprints, sensitive to edit distance.

A text's UTF-8 bytes give k-mers of ``K`` bytes, each numbered by its occurrence. For every one of
``SKETCHES`` hash functions the ``PICKED`` smallest numbered k-mers are taken, put back into text order
and hashed as a tuple. Likeness of two fingerprints is the share of equal entries.

Null and empty texts have a fingerprint of zeros; a text below ``K`` bytes is one k-mer. Texts of any
length are read whole, in blocks. Repeated rows and tied ids stand in the order (doc_id, text); in a
table of one row the next document is the row itself; an empty table gives an empty table.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.llm.common import slices, texts
from ledgerpulse.storage import materialize

K, SKETCHES, PICKED, BLOCK = 8, 32, 2, 1 << 14
GOLDEN = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


with np.errstate(over="ignore"):
    FACTORS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(GOLDEN)) | np.uint64(1)


def numbered_kmers(data: bytes) -> np.ndarray:
    """One hash for each k-mer together with its occurrence number, in text order."""
    data = data + bytes(K - len(data)) if len(data) < K else data
    windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), K)
    kmers = windows.copy().view(np.uint64).ravel()
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    again = np.flatnonzero(ranked[1:] == ranked[:-1]) + 1   # second and later occurrences
    head = np.flatnonzero(np.diff(again, prepend=-1) != 1)
    number = np.arange(1, len(again) + 1) - np.repeat(head, np.diff(np.r_[head, len(again)]))
    kmers[order[again]] += number.astype(np.uint64) * np.uint64(GOLDEN)
    return mixed(kmers)


def signature(text: str) -> np.ndarray:
    """The ``SKETCHES`` entries of a text's fingerprint."""
    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return np.zeros(SKETCHES, np.uint32)
    h = numbered_kmers(data)
    rows = np.arange(SKETCHES)
    value = np.zeros((SKETCHES, 0), np.uint64)
    place = np.zeros((SKETCHES, 0), np.int64)
    for start in range(0, len(h), BLOCK):
        keyed = h[None, start:start + BLOCK] * FACTORS[:, None]
        for _ in range(min(PICKED, keyed.shape[1])):
            best = keyed.argmin(axis=1)
            value = np.c_[value, keyed[rows, best]]
            place = np.c_[place, best + start]
            keyed[rows, best] = np.uint64(2**64 - 1)
        if value.shape[1] > PICKED:
            least = np.argsort(value, axis=1, kind="stable")[:, :PICKED]
            value, place = np.take_along_axis(value, least, 1), np.take_along_axis(place, least, 1)
    taken = h[np.sort(place, axis=1)]
    entry = np.full(SKETCHES, len(data) if len(h) < PICKED else 0, np.uint64)
    for column in taken.T:
        entry = mixed(entry * np.uint64(GOLDEN) + column)
    return (entry >> np.uint64(32)).astype(np.uint32)


def as_bytes(entries: np.ndarray) -> bytes:
    return entries.astype(">u4").tobytes()


def as_text(entries: np.ndarray) -> str:
    return as_bytes(entries).hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``fingerprint``."""
    keep = [c for c in docs.columns if c not in (text, "fingerprint")]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "fingerprint string"])

    def apply(batches):
        for batch in slices(batches):
            marks = [as_text(signature(t)) for t in texts(batch, text)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(marks, pa.string())],
                                             [*keep, "fingerprint"])

    return docs.select(*[F.col(f"`{c}`") for c in [*keep, text]]).mapInArrow(apply, schema)


# digests travel as bytes and are spelled out in the result
FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.binary()),
          ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()),
          ("near_next", pa.float64())]
RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
          "near_edited double, near_next double")
EDGES = [("part", pa.int32()), ("edge", pa.string()), ("text", pa.string())]


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as many first characters of ``following``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def compared(doc_id, text: str, mark: np.ndarray, following: str, next_mark: np.ndarray) -> dict:
    change = edited(text, following)
    edited_mark = signature(change)
    return {"doc_id": doc_id, "n_chars": len(text),
            "edited_sha256": hashlib.sha256(change.encode("utf-8", "surrogatepass")).digest(),
            "fingerprint": as_bytes(mark), "edited_fingerprint": as_bytes(edited_mark),
            "near_edited": likeness(mark, edited_mark), "near_next": likeness(mark, next_mark)}


def with_next(docs: DataFrame) -> DataFrame:
    """Each document (doc_id, text) next to its edited text and to the document with the next id.

    One range shuffle puts neighbours into the same task, which walks them in order. Only the first
    and last document of each partition meet across partitions, one pair for each partition.
    """
    ordered = (docs.select(F.col("doc_id").cast("bigint"), "text")
               .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text"))

    def walk(batches):
        part, before = TaskContext.get().partitionId(), None
        kinds = pa.schema([*FIELDS, *EDGES])
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                mark = signature(text)
                if before is None:
                    out.append({"part": part, "edge": "first", "doc_id": doc_id, "text": text})
                else:
                    out.append(compared(*before, text, mark))
                before = (doc_id, text, mark)
            yield pa.RecordBatch.from_pylist(out, schema=kinds)
        if before:
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "edge": "last", "doc_id": before[0], "text": before[1]}], schema=kinds)

    walked = materialize(ordered.mapInArrow(walk, f"{RESULT}, part int, edge string, text string"), "next-document")
    first = walked.where("edge = 'first'").select("part", F.col("text").alias("next_text"))
    parts = first.select("part")   # one number for each partition
    one = Window.orderBy("part")
    whole = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chain = parts.select("part", F.coalesce(F.lead("part").over(one), F.min("part").over(whole)).alias("next_part"))
    pairs = (walked.where("edge = 'last'").select("part", "doc_id", "text").join(chain, "part")
             .join(first.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "text", "next_text"))

    def finish(batches):
        for batch in slices(batches, 16):
            out = [compared(i, t, signature(t), n, signature(n)) for i, t, n in zip(
                batch.column("doc_id").to_pylist(), texts(batch), texts(batch, "next_text"), strict=True)]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(FIELDS))

    names = [F.lower(F.hex(n)).alias(n) if kind == pa.binary() else n for n, kind in FIELDS]
    found = walked.where("edge IS NULL").select(*[n for n, _ in FIELDS])
    return found.unionByName(pairs.mapInArrow(finish, RESULT)).select(*names)
