"""Operator 4: SimHash near-duplicates by bit-sliced comparison.

A fingerprint bit is 1 if it is set in over half of the XXH64 hashes (seed 42) of the text's shingles.
Two fingerprints that differ in at most ``radius`` bits agree on all but ``radius`` of any ``blocks``
blocks of bits, so every choice of the remaining blocks is a bucket key. Inside a bucket, 64 fingerprints
form a word per bit plane; a query's distances to all 64 are counted at once in carry-save bit counters,
and a word is abandoned as soon as all its distances exceed the radius. A task emits a spanning forest of
the links it finds, not every pair, and the components of all forests are the classes.

Buckets with more than ``TILE`` different fingerprints are cut into tiles, every pair of which meets in
some task. Null and empty texts have fingerprint zero and link like any other. Texts of any length are
hashed whole, repeated rows share a class, an empty table gives an empty table, other columns are ignored.

``near_duplicates`` is the search for a similarity of shingle sets rather than for a radius. A Jaccard similarity of 0.8
moves about ten of 64 bits, more than agreeing blocks can index, so there the buckets are bands of least
hashes of the shingle set; the bit-sliced comparison within them gives candidates, whose components meet in tiles,
where every link is confirmed on the shingle sets themselves.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import column, slices, starts, texts, whole_groups
from ledgerpulse.llm.components import components
from ledgerpulse.storage import materialize

RADIUS, SHINGLE, SEED, TILE = 4, 4, 42, 4096
STEP = 1 << 15          # (query, word) pairs compared at a time
ONES = np.uint64(2**64 - 1)
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str, size: int = SHINGLE) -> list[int]:
    words = text.encode("utf-8", "surrogatepass").lower().split()   # on bytes, only A-Z and ASCII blanks
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    return [xxhash.xxh64_intdigest(b" ".join(w), SEED) for w in zip(*(words[k:] for k in range(size)), strict=False)]


def majority(hashes: list[list[int]]) -> np.ndarray:
    """One fingerprint for each list of hashes: the bits set in over half of them."""
    size = np.fromiter(map(len, hashes), np.int64, len(hashes))
    out = np.zeros(len(hashes), np.uint64)
    some = np.flatnonzero(size)
    if not len(some):
        return out
    h = np.fromiter((x for row in hashes for x in row), np.uint64, int(size.sum()))
    first = (np.cumsum(size) - size)[some]
    # byte lanes hold at most 255 ones, so rows are summed in blocks of 255 first
    blocks = -(-size[some] // 255)
    head = np.cumsum(blocks) - blocks
    begin = np.repeat(first, blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(head, blocks))
    bits = np.zeros((len(some), 64), np.uint8)
    for b in range(8):
        lanes = np.add.reduceat((h >> np.uint64(b)) & LANES, begin).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(lanes.astype(np.int64), head, axis=0)
        bits[:, b::8] = 2 * ones > size[some][:, None]
    out[some] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, h): the fingerprint as a signed number and a hash of the text, one row for each row."""
    def apply(batches):
        for batch in slices(batches):
            fp = majority([shingle_hashes(t) for t in texts(batch)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fp.view(np.int64)), batch.column("h")], ["doc_id", "fp", "h"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(
        apply, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint, h bigint")


def exceeds(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose bit-sliced count is above ``radius``."""
    above, equal = np.zeros_like(counter[0]), np.full_like(counter[0], ONES)
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            equal = equal & counter[k]
        else:
            above = above | (equal & counter[k])
            equal = equal & ~counter[k]
    return above


def compare_words(planes: np.ndarray, fp: np.ndarray, query: np.ndarray, word: np.ndarray, mask: np.ndarray,
                  radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of lanes in ``mask`` within ``radius`` bits of their query."""
    counter = [np.zeros(len(query), np.uint64) for _ in range(radius.bit_length())]
    over = ~mask
    for p in range(64):
        x = planes[p][word] ^ (np.uint64(0) - (fp[query] >> np.uint64(p) & np.uint64(1)))
        for k in range(len(counter)):
            counter[k], x = counter[k] ^ x, counter[k] & x
        over |= x
        if p % 8 == 7:
            over |= exceeds(counter, radius)
            live = over != ONES
            if p < 63 and live.sum() < 0.7 * len(live):   # abandon words that hold no candidate any more
                query, word, over = query[live], word[live], over[live]
                counter = [c[live] for c in counter]
                if not len(query):
                    break
    row, lane = np.nonzero(np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return query[row], word[row] * 64 + lane


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after linking positions ``i`` and ``j``: the smallest position of each component."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return label
        i, j, low = i[differ], j[differ], np.minimum(a, b)[differ]
        np.minimum.at(label, a[differ], low)
        np.minimum.at(label, b[differ], low)
        while (label[label] != label).any():
            label = label[label]


def forest(fp: np.ndarray, run: np.ndarray, radius: int) -> np.ndarray:
    """For each position the smallest linked position of its run; ``run`` holds the runs' first positions."""
    n = len(fp)
    end = np.repeat(np.r_[run[1:], n], np.diff(np.r_[run, n]))
    width = -(-n // 64)
    padded = np.r_[fp, np.zeros(width * 64 - n, np.uint64)]
    planes = np.stack([np.packbits((padded >> np.uint64(p) & np.uint64(1)).astype(np.uint8), bitorder="little")
                       .view(np.uint64) for p in range(64)])
    at = np.arange(n)
    words = np.where(end - 1 > at, (end - 1) // 64 - at // 64 + 1, 0)
    upto, label, first = np.cumsum(words), np.arange(n), 0
    while first < n:
        done = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, done + STEP, "right")))
        query = np.repeat(at[first:last], words[first:last])
        word = query // 64 + np.arange(len(query)) - np.repeat(upto[first:last] - words[first:last] - done,
                                                               words[first:last])
        later = np.where(word == query // 64, ONES << (query % 64).astype(np.uint64) << np.uint64(1), ONES)
        tail = end[query] - word * 64
        inside = np.where(tail < 64, (np.uint64(1) << np.minimum(tail, 63).astype(np.uint64)) - np.uint64(1), ONES)
        if len(query):
            label = joined(label, *compare_words(planes, fp, query, word, later & inside, radius))
        first = last
    return label


def masks(n: int, radius: int) -> list[int]:
    """Bit masks of the bucket keys: more, and longer ones, for more fingerprints."""
    for blocks in range(radius + 2, 65):
        kept = blocks - radius
        if n >> (64 // blocks * kept) <= 32:
            break
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(c) for c in combinations(parts, kept)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) that span every set of fingerprints linked within ``radius``; ``fps`` (fp) is distinct."""
    keys = masks(fps.count(), radius)
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
        for k, m in enumerate(keys)])).alias("b")).select("b.t", "b.key", "fp", F.col("fp").alias("node"))
    return bucket_links(keyed, radius)


def tiled(keyed: DataFrame, by: list[str], node: str, tile: int) -> DataFrame:
    """Rows of each key in pairs of tiles (a, b) of about ``tile`` rows; keys of a single row leave."""
    size = keyed.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1")
    cuts = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64(node), F.col("cuts")).cast("int")
    return (keyed.join(size, by).withColumn("cuts", cuts).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
            .where("cuts = 1 OR own <> other")   # a pair of tiles also compares each with itself
            .select(*keyed.columns, F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")))


def bucket_links(keyed: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) between nodes that span what lies within ``radius`` in a bucket of ``keyed`` (t, key, fp, node)."""
    by = ["t", "key", "a", "b"]

    def compare(batches):
        for group in whole_groups(batches, by):
            fp, node = column(group, "fp").view(np.uint64), column(group, "node")
            label = forest(fp, starts(*(column(group, k) for k in by)), radius)
            at = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[label[at]])], ["u", "v"])

    return (tiled(keyed, ["t", "key"], "node", TILE).repartition(*by).sortWithinPartitions(*by, "fp", "node")
            .mapInArrow(compare, "u bigint, v bigint").distinct())


def classes(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, h, root, component_id) for every row of ``docs`` (doc_id, text).

    ``root`` is a fingerprint that names the class, ``component_id`` its smallest id, ``h`` a hash of the text.
    """
    marks = materialize(fingerprints(docs), "simhash")
    least = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = components(links(marks.select("fp").distinct(), radius))
    rooted = (least.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    rooted = materialize(rooted, "simhash-roots")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").drop("least")
    return marks.join(named, "fp").select("doc_id", "fp", "h", "root", "component_id")


# --- similarity of shingle sets ----------------------------------------------------------------

WORDS, SIMILARITY, WIDE = 5, 0.8, 17     # bits two fingerprints of that similarity stay within, but for about one in a hundred
BANDS, ROWS = 10, 4                      # 1 - (1 - 0.8 ** 4) ** 10: all but 0.5 % of the pairs at 0.8 share a band
SETS = 512                               # shingle sets in a tile


def shingle_set(text: str, size: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, size), np.uint64))


def band_keys(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Sets x bands: a hash of ``rows`` least hashes each; of an empty set 0."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    some = np.flatnonzero(size)
    out = np.zeros((len(sets), bands), np.uint64)
    if len(some):
        flat = np.concatenate(sets)
        head = (np.cumsum(size) - size)[some]
        rng = np.random.default_rng(SEED)
        for k in range(bands * rows):
            step, add = (np.uint64(x | 1) for x in rng.integers(0, 1 << 63, 2).tolist())
            x = flat * step + add
            least = np.minimum.reduceat(x ^ x >> np.uint64(29), head)
            out[some, k // rows] = (out[some, k // rows] ^ least) * np.uint64(0x9E3779B97F4A7C15)
    return out


def shingled(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, h, g, fp, keys): ``g`` is a hash of the shingle set, equal for texts of equal sets."""
    def apply(batches):
        for batch in slices(batches):
            sets = [shingle_set(t, words) for t in texts(batch)]
            g = np.fromiter((xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets), np.uint64, len(sets))
            keys = band_keys(sets, BANDS, ROWS).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(g.view(np.int64)),
                 pa.array(majority(sets).view(np.int64)), pa.array(list(keys), pa.list_(pa.int64()))],
                ["doc_id", "h", "g", "fp", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(
        apply, f"doc_id {kind}, h bigint, g bigint, fp bigint, keys array<bigint>")


def confirmed(sets: list[np.ndarray], fp: np.ndarray, radius: int, similarity: float) -> list[tuple[int, int]]:
    """Pairs that span all pairs of sets within ``radius`` and of ``similarity`` or more."""
    label, out = np.arange(len(sets)), []
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    for i in range(len(sets) - 1):
        near = np.flatnonzero(np.bitwise_count(fp[i + 1:] ^ fp[i]) <= radius) + i + 1
        least, most = np.minimum(size[near], size[i]), np.maximum(size[near], size[i])
        for j in near[least >= similarity * most].tolist():
            if label[i] == label[j]:
                continue
            both = np.isin(sets[i], sets[j], assume_unique=True).sum()
            if both >= similarity * (size[i] + size[j] - both):
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def near_duplicates(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, radius: int = WIDE) -> DataFrame:
    """(doc_id, h, root) for every row of ``docs`` (doc_id, text): rows of one ``root`` are linked by pairs of shingle sets
    with a Jaccard similarity of ``similarity`` or more, ``h`` is a hash of the text.

    Null and empty texts have an empty set and share a class; texts of fewer words have themselves as their one
    shingle. Texts are read whole, repeated rows share a class, an empty table gives an empty table.
    """
    marks = materialize(shingled(docs, words), "shingles")
    nodes = marks.groupBy("g").agg(F.min(F.struct("fp", "keys")).alias("m")).select("g", "m.*")
    keyed = nodes.select(F.posexplode("keys").alias("t", "key"), "fp", F.col("g").alias("node"))
    maybe = materialize(components(bucket_links(keyed, radius)), "near-candidates")
    grouped = maybe.unionByName(maybe.select(F.col("root").alias("node"), "root").distinct())
    source = (marks.where(F.size("keys") > 0).groupBy("g").agg(F.min(F.struct("doc_id", "h")).alias("s"))
              .join(grouped, F.col("g") == F.col("node")).select("root", "g", "s.doc_id", "s.h"))
    source = materialize(source, "near-sources").withColumnsRenamed({"doc_id": "s_id", "h": "s_h"})
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).dropDuplicates(["doc_id", "h"])
    rows = rows.join(source, rows["doc_id"].eqNullSafe(source["s_id"]) & (rows["h"] == source["s_h"])).select("root", "g", "text")
    by = ["root", "a", "b"]

    def sets_of(batches):
        for batch in slices(batches):
            sets = [shingle_set(t, words) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("root"), batch.column("g"), pa.array(majority(sets).view(np.int64)),
                 pa.array([x.tobytes() for x in sets], pa.binary())], ["root", "g", "fp", "items"])

    def confirm(batches):
        for group in whole_groups(batches, by):
            g, fp = column(group, "g"), column(group, "fp").view(np.uint64)
            items, head = group.column("items"), starts(*(column(group, k) for k in by))
            for low, high in zip(head, [*head[1:], len(g)], strict=True):
                sets = [np.frombuffer(x, np.uint64) for x in items.slice(low, high - low).to_pylist()]
                pairs = np.array(confirmed(sets, fp[low:high], radius, similarity), np.int64).reshape(-1, 2) + low
                yield pa.RecordBatch.from_arrays([pa.array(g[pairs[:, 0]]), pa.array(g[pairs[:, 1]])], ["u", "v"])

    sets = materialize(rows.mapInArrow(sets_of, "root bigint, g bigint, fp bigint, items binary"), "near-sets")
    edges = (tiled(sets, ["root"], "g", SETS).repartition(*by).sortWithinPartitions(*by, "g")
             .mapInArrow(confirm, "u bigint, v bigint").distinct())
    linked = materialize(components(edges).withColumnRenamed("root", "r"), "near-classes")
    return marks.join(linked, F.col("g") == F.col("node"), "left").select("doc_id", "h", F.coalesce("r", "g").alias("root"))
