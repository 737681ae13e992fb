"""Operator 13: importance resampling towards a target by hashed n-grams, words found by an Aho-Corasick automaton.

A dictionary holds the distinct words of a block of texts, each between two delimiters, with the word's CRC-32, the
CRC-32 of a blank and the word, and its length. The automaton of these words runs over the following texts and
emits the payload of each word it meets. The CRC of two or three neighbouring words follows from their payloads
alone: the CRC so far is moved on by the length of the next word and joined with that word's own. No n-gram is
ever put together as a text. A word outside the dictionary gets its payload from the same rule, so results do not
depend on what the dictionary holds; one that misses ``MISSES`` of the words of a block is made anew from that block.

CRCs modulo ``buckets`` are counted over all documents and all target texts, which gives each bucket its gain; a
document's weight is the sum over its n-grams. With a Gumbel number of its id added, the highest scores are a
sample drawn by weight without replacement. Ranks come from a range-partitioned sort: the place in a partition
plus the rows of the partitions before it.

Null and empty texts have no words: weight 0, never drawn. Texts are read whole. Repeated rows are documents of their
own; equal scores go by doc_id, then by the number of n-grams and the weight; a missing id counts as the empty
text in the draw and comes first. An empty table gives an empty table. Columns other than doc_id and text are
ignored, whatever their names.
"""

import math
import zlib
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import slices, texts
from ledgerpulse.storage import materialize

BUCKETS, LEAST_WORDS, SEED = 10_000, 20, 42
SHARE = (5, 100)         # drawn of the eligible documents
MISSES = 0.25            # share of unknown words at which a dictionary is made anew; no effect on results
BLOCK = 512              # texts scanned at a time
SHORT = 64               # lengths with a table of their own

BLANK = 32
#: A-Z lowered, all other ASCII but a-z and 0-9 blank
PLAIN = bytes(b if b >= 128 or chr(b).islower() or chr(b).isdigit() else ord(chr(b).lower()) if chr(b).isupper() else BLANK
              for b in range(256))


def crc_steps() -> np.ndarray:
    """What one more zero byte makes of a CRC's lowest byte."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ np.uint32(0xEDB88320), step >> 1)
    return step


def _moved(tables: np.ndarray, at: np.ndarray | int, crc: np.ndarray) -> np.ndarray:
    """CRCs moved on by ``tables[at]``, byte by byte."""
    out = tables[at, 0, crc & 255]
    for k in (1, 2, 3):
        out = out ^ tables[at, k, crc >> np.uint32(8 * k) & 255]
    return out


def _length_tables() -> tuple[np.ndarray, np.ndarray]:
    """Tables of each CRC byte for lengths below ``SHORT``, and for the powers of two."""
    step = crc_steps()
    now = np.arange(256, dtype=np.uint32)[None] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    short = [now]
    for _ in range(SHORT - 1):
        now = now >> 8 ^ step[now & 255]
        short.append(now)
    powers = [short[1]]
    for _ in range(39):
        powers.append(_moved(powers[-1][None], 0, powers[-1]))
    return np.array(short), np.array(powers)


LENGTHS, POWERS = _length_tables()


def moved(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs as they stand after ``length`` zero bytes: crc(ab) is ``moved(crc(a), len(b)) ^ crc(b)``."""
    out = _moved(LENGTHS, np.minimum(length, SHORT - 1), crc)
    long = np.flatnonzero(length >= SHORT)
    if len(long):
        rest, part = length[long], crc[long]
        for k in range(int(rest.max()).bit_length()):
            on = np.flatnonzero(rest >> k & 1)
            part[on] = _moved(POWERS, k, part[on])
        out[long] = part
    return out


class Dictionary:
    """Automaton of words between delimiters, with their payloads: CRC, CRC after a blank, length."""

    def __init__(self):
        self.automaton = None
        self.crc = self.led = np.zeros(0, np.uint32)
        self.size = np.zeros(0, np.int64)

    def learn(self, words: list[bytes]) -> None:
        self.automaton = ahocorasick.Automaton()
        for k, w in enumerate(words):
            self.automaton.add_word(f" {w.decode('latin-1')} ", k)
        self.automaton.make_automaton()
        self.crc, self.led, self.size = payloads(words)

    def emitted(self, raw: bytes, end: np.ndarray) -> np.ndarray:
        """Number of the word that ends at each of ``end``, -1 for one outside the dictionary."""
        word = np.full(len(end), -1)
        if self.automaton is not None and len(self.crc):
            found = np.fromiter(chain.from_iterable(self.automaton.iter(raw.decode("latin-1"))), np.int64).reshape(-1, 2)
            word[np.searchsorted(end, found[:, 0])] = found[:, 1]
        return word

    def scan(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First word of each row (and the end), and the payloads of all words, row after row."""
        plain = [r.translate(PLAIN) for r in rows]
        raw = b" " + b" ".join(plain) + b" "
        letter = np.frombuffer(raw, np.uint8) != BLANK
        turn = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        start, end = turn[::2], turn[1::2]
        word = self.emitted(raw, end)
        missed = np.flatnonzero(word < 0)
        if len(missed) > MISSES * len(word):
            self.learn(list({raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)}))
            word = self.emitted(raw, end)
            missed = np.flatnonzero(word < 0)
        crc, led, size = (x[word] if len(x) else np.zeros(len(word), x.dtype) for x in (self.crc, self.led, self.size))
        if len(missed):
            crc[missed], led[missed], size[missed] = payloads(
                [raw[a:b] for a, b in zip(start[missed].tolist(), end[missed].tolist(), strict=True)])
        row_at = np.cumsum([1, *(len(p) + 1 for p in plain)])
        return np.searchsorted(start, row_at), crc, led, size


def payloads(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, blank = len(words), zlib.crc32(b" ")
    return (np.fromiter(map(zlib.crc32, words), np.uint32, n),
            np.fromiter((zlib.crc32(w, blank) for w in words), np.uint32, n),
            np.fromiter(map(len, words), np.int64, n))


def ngram_buckets(first: np.ndarray, crc: np.ndarray, led: np.ndarray, size: np.ndarray,
                  buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For runs of one, two and three words: the first words they start at, and their buckets."""
    stop = np.repeat(first[1:], np.diff(first))      # end of each word's row
    at, now, out = np.arange(len(crc)), crc, []
    for k in range(3):
        if k:
            stay = np.flatnonzero(at + k < stop[at])
            at = at[stay]
            now = moved(now[stay], size[at + k] + 1) ^ led[at + k]
        out.append((at, now % np.uint32(buckets)))
    return out


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): n-grams of all texts by bucket."""
    def count(batches):
        known, total = Dictionary(), np.zeros(buckets, np.int64)
        for batch in slices(batches, BLOCK):
            for _, found in ngram_buckets(*known.scan([t.encode() for t in texts(batch)]), buckets):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return docs.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket, in thousandths, rounded down; at most ``buckets`` rows reach the driver."""
    counts = []
    for docs in (raw, target):
        n = [0] * buckets
        for r in bucket_counts(docs, buckets).collect():
            n[r["bucket"]] = r["n"]
        counts.append(n)
    s, t = counts
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t))) for a, b in zip(s, t, strict=True)],
                    np.int64)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def weigh(batches):
        known = Dictionary()
        for batch in slices(batches, BLOCK):
            first, *words = known.scan([t.encode() for t in texts(batch)])
            own = np.zeros(len(words[0]), np.int64)
            for at, found in ngram_buckets(first, *words, len(gain)):
                own[at] += gain[found]
            total = np.r_[0, np.cumsum(own)]
            n = np.diff(first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(n + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)),
                 pa.array(total[first[1:]] - total[first[:-1]])], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(
        weigh, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS,
             seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): rank from 1 for the drawn documents, else null.

    ``share`` is the drawn part of the documents of at least ``least_words`` words, rounded down.
    """
    spark = docs.sparkSession
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighed(docs, gains(docs, target, buckets)).withColumn("score", F.col("weight") + gumbel)
    scored = materialize(scored, "importance")
    eligible = scored.where(F.col("n_words") >= least_words)
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("n_features"), F.asc("weight")]
    ordered = materialize(eligible.repartitionByRange(*order).sortWithinPartitions(*order)
                          .withColumn("place", F.monotonically_increasing_id()), "importance-order")
    part = F.shiftright("place", 33)
    sizes = sorted(ordered.groupBy(part.alias("p")).count().collect())     # one row for each partition
    before, total = [], 0
    for p, n in sizes:
        before.append((p, total))
        total += n
    offsets = spark.createDataFrame(before, "p bigint, before bigint")
    drawn = total * share[0] // share[1]
    rank = F.col("before") + F.col("place") - F.shiftleft(part, 33) + 1
    ranked = (ordered.join(F.broadcast(offsets), part == F.col("p")).withColumn("rank", rank)
              .withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).drop("p", "before", "place"))
    return ranked.unionByName(scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint")))
