"""Operator 7: benchmark decontamination by greedy string tiling.

Running Karp-Rabin hashes of ``SEED`` words are taken over every benchmark item and every whole document.
A bitmap of fixed size keeps document hashes that may occur in the benchmark; these are joined with the
benchmark's hashes. Matches of a document and an item are runs of seeds on one diagonal. Tiling marks the
longest match, then the longest of what is left unmarked on both sides, until nothing of ``SEED`` words
remains, so reordered passages are covered as well. A document is contaminated by an item if its tiles
cover at least ``COVERAGE`` of the item's words.

An item of fewer than ``SEED`` words is one seed of its own length and is found where all its words stand together;
documents are hashed at that length too if the benchmark has such items, one place for each seed and document.

Words are runs of letters, digits and underscores, lower-cased. Null and empty texts match nothing. Texts of any length are read whole. Rows that repeat in id and text
give one result, items with equal text one result each. An empty table on either side gives an empty
table; columns beyond id and text are ignored.
"""

import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import column, slices, starts, texts, whole_groups
from ledgerpulse.storage import materialize

SEED, COVERAGE = 5, 0.6
SLOT_BITS = 22          # the bitmap has 2^22 bits whatever the size of the benchmark
CACHE = 400_000
WORD = re.compile(r"\w+")
BASE = 0x9E3779B97F4A7C15


def rolling(codes: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of each window of ``size`` words, as signed 64-bit numbers."""
    total = np.full(max(len(codes) - size + 1, 0), size % SEED, np.uint64)   # lengths do not meet each other
    for k in range(size):
        total = total * np.uint64(BASE) + codes[k:k + len(total)]
    return (total ^ (total >> np.uint64(29))).view(np.int64)


def coded(text: str, known: dict[str, int]) -> np.ndarray:
    """A hash of each word of the text."""
    words = WORD.findall(text.lower())
    for w in set(words):
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def seeds(docs: DataFrame, allowed=None, short: list[int] | None = None) -> DataFrame:
    """(doc_id, h, p, seed, size): the hash of ``size`` words at word ``p`` of a text, if its bit is set in ``allowed``.

    Windows have ``SEED`` words. Of the lengths in ``short`` too, each at its first place only; where that is None,
    a text of fewer words is one window.
    """
    def windows(codes: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        if short is None:
            size = min(SEED, len(codes)) or SEED
            found = rolling(codes, size)
            return [(size, np.arange(len(found)), found)]
        out = [(SEED, np.arange(max(len(codes) - SEED + 1, 0)), rolling(codes, SEED))]
        for size in short:
            found, place = np.unique(rolling(codes, size), return_index=True)
            out.append((size, place, found))
        return out

    def apply(batches):
        bits = None if allowed is None else np.frombuffer(allowed.value, np.uint8)
        known: dict[str, int] = {}
        for batch in slices(batches):
            if len(known) > CACHE:
                known = {}
            found = [(k, *w) for k, t in enumerate(texts(batch)) for w in windows(coded(t, known))]
            length = [len(f[3]) for f in found]
            row, size = (np.repeat(np.array([f[i] for f in found], np.int64), length) for i in (0, 1))
            place, seed = (np.concatenate([f[i] for f in found]) for i in (2, 3))
            if bits is not None:
                slot = seed & ((1 << SLOT_BITS) - 1)
                hit = np.flatnonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                row, size, place, seed = row[hit], size[hit], place[hit], seed[hit]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), batch.column("h").take(pa.array(row)),
                 pa.array(place.astype(np.int32)), pa.array(seed), pa.array(size.astype(np.int32))],
                ["doc_id", "h", "p", "seed", "size"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
            .mapInArrow(apply, f"doc_id {kind}, h bigint, p int, seed bigint, size int"))


def bitmap(seed_table: DataFrame):
    """Broadcast bitmap of 2^SLOT_BITS bits, set where a seed of the table falls."""
    slot = F.col("seed").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    slots = seed_table.select(slot.cast("int").alias("slot")).distinct().toPandas()["slot"].to_numpy(np.int64)
    bits = np.zeros(1 << SLOT_BITS, np.uint8)
    bits[slots] = 1
    return seed_table.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little").tobytes())


def matches(p: np.ndarray, q: np.ndarray, size: int = SEED) -> list[tuple[int, int, int]]:
    """Maximal matches (length, p, q) in words, from the places of seeds of ``size`` words in text and item."""
    order = np.lexsort((p, p - q))
    p, q = p[order], q[order]
    head = starts(p - q, p - np.arange(len(p)))
    length = np.diff(np.r_[head, len(p)]) + size - 1
    return list(zip(length.tolist(), p[head].tolist(), q[head].tolist(), strict=True))


def tiles(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Greedy string tiling of maximal matches: non-overlapping (length, p, q), longest first."""
    heap = [(-size, p, q) for size, p, q in found]
    heapify(heap)
    text_marked, item_marked, out = set(), set(), []
    while heap:
        size, p, q = heappop(heap)
        size = -size
        free = [p + k not in text_marked and q + k not in item_marked for k in range(size)]
        if all(free):
            out.append((size, p, q))
            text_marked.update(range(p, p + size))
            item_marked.update(range(q, q + size))
            continue
        start = None   # the unmarked stretches compete again at their own lengths
        for k, ok in enumerate([*free, False]):
            if ok and start is None:
                start = k
            elif not ok and start is not None:
                if k - start >= SEED:
                    heappush(heap, (start - k, p + start, q + start))
                start = None
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, h, item_id, coverage, n_words, spans) of documents (doc_id, text) and items (item_id, text).

    ``spans`` lists the tiles as (first word in the document, first word in the item, words).
    """
    items = benchmark.select(F.col("item_id").alias("doc_id"), "text")
    item_seeds = materialize(seeds(items).select(F.col("doc_id").alias("item_id"), F.col("h").alias("item_h"),
                                                 F.col("p").alias("q"), "seed", "size").distinct(), "item-seeds")
    sizes = item_seeds.groupBy("item_id", "item_h").agg((F.max("q") + F.max("size")).alias("n_words"))
    short = [r["size"] for r in item_seeds.where(F.col("size") < SEED).select("size").distinct().collect()]   # four at most
    kept = seeds(docs, bitmap(item_seeds), sorted(short)).distinct()
    # a pair can only reach the coverage if that many item words lie in seeds at all
    hits = materialize(kept.join(item_seeds, ["seed", "size"]).select(
        "doc_id", "h", "item_id", "item_h", "p", "q", "size"), "seed-hits")
    pair = ["doc_id", "h", "item_id", "item_h"]
    able = (hits.groupBy(*pair, "q").agg(F.max("size").alias("size")).groupBy(*pair).agg(F.sum("size").alias("most"))
            .join(sizes, ["item_id", "item_h"]).where(F.col("most") >= F.col("n_words") * coverage)
            .select(*pair, "n_words"))
    able = able.withColumnsRenamed({c: f"a_{c}" for c in pair})
    same = F.lit(True)
    for c in pair:
        same = same & hits[c].eqNullSafe(able[f"a_{c}"])
    chosen = hits.join(able, same).select(*pair, "n_words", "size", "p", "q")
    kinds = {c: docs.schema["doc_id"].dataType.simpleString() if c == "doc_id" else "bigint" for c in pair}
    kinds["item_id"] = benchmark.schema["item_id"].dataType.simpleString()

    def tile(batches):
        for group in whole_groups(batches, pair):
            p, q = column(group, "p").astype(np.int64), column(group, "q").astype(np.int64)
            number = np.zeros(len(p), np.int64)   # nulls are allowed in ids, so they are numbered first
            for c in pair:
                number = number * len(p) + group.column(c).combine_chunks().dictionary_encode("encode").indices.to_numpy()
                number = np.unique(number, return_inverse=True)[1]
            head = starts(number)
            size = column(group, "size").astype(np.int64)     # one for each item
            spans = [tiles(matches(p[a:b], q[a:b], int(size[a]))) for a, b in zip(head, [*head[1:], len(p)], strict=True)]
            first = group.take(pa.array(head))
            n = column(first, "n_words")
            share = np.array([sum(t[0] for t in s) for s in spans]) / n
            text = ["; ".join(f"{a}:{b}+{size}" for size, a, b in sorted(s, key=lambda t: t[1])) for s in spans]
            yield pa.RecordBatch.from_arrays(
                [*(first.column(c).combine_chunks() for c in pair[:3]), pa.array(share), pa.array(n.astype(np.int32)),
                 pa.array(text)], [*pair[:3], "coverage", "n_words", "spans"])

    return (chosen.repartition(*pair).sortWithinPartitions(*pair, "p", "q")
            .mapInArrow(tile, ", ".join(f"{c} {kinds[c]}" for c in pair[:3]) + ", coverage double, n_words int, spans string")
            .where(F.col("coverage") >= coverage))
