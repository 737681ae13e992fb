"""Operator 1: removal of repeated line runs by a suffix array over line ids.

The non-blank lines of all documents are numbered in one total order (that of their 128-bit hashes); lines
that occur once cannot be part of a repeat and end every sequence they stand in. Prefix doubling sorts the
suffixes: a suffix's rank for the first 2^(k+1) lines is the rank of the pair of its own and its 2^k-th
successor's ranks for 2^k lines, ranks being positions in a range-partitioned sort of the distinct pairs.
Suffixes whose prefix is unique leave. Suffixes of equal rank are an interval of the suffix array with a
longest common prefix of at least 2^k lines; the interval of depth m, for any m up to 2^(k+1), is fixed by
the two ranks that cover its m lines.

A run of lines counts if it holds ``MIN_WORDS`` words. Each line begins one shortest such run and ends
another, and every longer repeated run is a union of these, so doubling ends at a depth of ``MIN_WORDS``
lines, whatever the length of documents. In every interval the first copy, by (doc_id, text hash, line),
stays and the lines of all later ones are removed. Copies may overlap, so of a line that is repeated over
and over in one place the first stays.

Lines are compared without blanks at their ends. Blank lines are not compared; those after a removed line
go with it. Null texts stay null, empty ones empty, and texts of any length are read whole. Rows equal in
id and text are one document and get one result each. An empty table gives an empty table. Other columns
are kept, whatever their names, but those named as the added ones.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.llm.common import column, packed, slices, starts, texts, unpacked, whole_groups
from ledgerpulse.storage import materialize

MIN_WORDS = 25
DOC = ["doc_id", "h"]
ADDED = ["n_lines", "n_removed", "removed"]


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, h, i, line, upto, words, a, b): non-blank line ``i`` of a text, its place and 128-bit hash.

    ``upto`` is the last blank line that follows it, or the line itself.
    """
    def apply(batches):
        for batch in slices(batches):
            row, i, place, upto, words, high, low = [], [], [], [], [], [], []
            for k, text in enumerate(texts(batch)):
                parts = [p.strip() for p in text.split("\n")]
                full = [n for n, p in enumerate(parts) if p]
                row += [k] * len(full)
                i += range(len(full))
                place += full
                upto += [n - 1 for n in full[1:]] + [len(parts) - 1] * bool(full)
                words += [len(parts[n].split()) for n in full]
                code = b"".join(xxhash.xxh3_128_digest(parts[n].encode("utf-8", "surrogatepass")) for n in full)
                pair = np.frombuffer(code, np.int64).reshape(-1, 2)
                high.append(pair[:, 0])
                low.append(pair[:, 1])
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("h").take(at),
                 *(pa.array(x, pa.int32()) for x in (i, place, upto, words)),
                 pa.array(np.concatenate(high)), pa.array(np.concatenate(low))],
                [*DOC, "i", "line", "upto", "words", "a", "b"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(
        apply, f"doc_id {kind}, h bigint, i int, line int, upto int, words int, a bigint, b bigint")


def ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose key occurs more than once, with ``rank``: the place of the key in sorted order.

    Keys are counted before they are shuffled and sorted, so a frequent one is a single row there. The
    numbers are increasing from partition to partition of the range-partitioned keys.
    """
    order = (rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
             .repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("rank", F.monotonically_increasing_id()))
    return rows.join(order, keys).drop(*keys)


def doubled(level: DataFrame, span: int) -> DataFrame:
    """Ranks for 2 * ``span`` lines from those for ``span`` lines."""
    within = Window.partitionBy(*DOC).orderBy("i")
    pairs = level.select(*DOC, "i", F.col("rank").alias("r1"), F.lead("rank", span).over(within).alias("r2"),
                         F.lead("i", span).over(within).alias("j"))
    return ranked(pairs.where(F.col("j") == F.col("i") + span).drop("j"), ["r1", "r2"])


def suffix_ranks(docs: DataFrame, depth: int) -> DataFrame:
    """(doc_id, h, i, k, rank, line, upto, words): ranks of suffixes for 2^k lines, 2^k up to ``depth``."""
    rows = materialize(lines(docs), "lines")
    level = ranked(rows, ["a", "b"]).dropDuplicates([*DOC, "i"])
    level = materialize(level, "suffix-ranks")
    out, k = level.withColumn("k", F.lit(0)), 0
    while 2 << k <= depth and not level.isEmpty():
        level = materialize(doubled(level.select(*DOC, "i", "rank"), 1 << k), "suffix-ranks")
        k += 1
        out = out.unionByName(level.withColumn("k", F.lit(k)), allowMissingColumns=True)
    return out


def shortest_runs(i: np.ndarray, words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions and line numbers of the shortest runs of ``least`` words that begin or end at a line.

    Positions index the given lines; a run needs consecutive ``i``.
    """
    n = len(i)
    total = np.r_[0, np.cumsum(words)]
    head = starts(i - np.arange(n))
    size = np.diff(np.r_[head, n])
    begin, end = np.repeat(head, size), np.repeat(head + size, size)
    at = np.arange(n)
    stop = np.searchsorted(total, total[:-1] + least)          # first end at which the words suffice
    start = np.searchsorted(total, total[1:] - least, "right") - 1
    forward, backward = stop <= end, start >= begin
    pairs = np.unique(np.r_[np.c_[at[forward], stop[forward] - at[forward]],
                            np.c_[start[backward], at[backward] + 1 - start[backward]]], axis=0)
    return pairs[:, 0], pairs[:, 1]


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, h, first_line, last_line, source, m): shortest runs that repeat an earlier one.

    ``source`` is the (doc_id, h, i) of the copy that stays, ``m`` the number of non-blank lines.
    """
    ranks = suffix_ranks(docs, min_words)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def windows(batches):
        for group in whole_groups(batches, DOC):
            ids = group.column("doc_id").combine_chunks()
            code = ids.dictionary_encode("encode").indices.to_numpy() if len(ids) else np.zeros(0)
            h, k, i = (column(group, c) for c in ("h", "k", "i"))
            doc = starts(code, h)
            out = []
            for a, b in zip(doc, [*doc[1:], len(i)], strict=True):
                cut = np.searchsorted(k[a:b], np.arange(k[b - 1] + 2)) + a    # the levels lie one after the other
                base = slice(cut[0], cut[1])
                own = i[base]
                words = group.column("words").slice(cut[0], cut[1] - cut[0]).to_numpy()
                first, m = shortest_runs(own, words, min_words)
                level = np.log2(m).astype(np.int64) if len(m) else m
                for step in np.unique(level):
                    if step > k[b - 1]:
                        continue
                    part = slice(cut[step], cut[step + 1])
                    at, length = first[level == step], m[level == step]
                    left = own[at]
                    right = left + length - (1 << step)
                    known, rank = i[part], column(group, "rank")[part]
                    p, q = np.searchsorted(known, left), np.searchsorted(known, right)
                    ok = (p < len(known)) & (q < len(known))
                    ok[ok] = (known[p[ok]] == left[ok]) & (known[q[ok]] == right[ok])
                    out.append(np.c_[np.full(ok.sum(), cut[0]), at[ok] + cut[0], length[ok], rank[p[ok]], rank[q[ok]]])
            rows = np.concatenate(out) if out else np.zeros((0, 5), np.int64)
            at = pa.array(rows[:, 1])
            last = pa.array(rows[:, 1] + rows[:, 2] - 1)
            yield pa.RecordBatch.from_arrays(
                [ids.take(at), pa.array(h[rows[:, 1]]), pa.array(i[rows[:, 1]]), pa.array(rows[:, 2].astype(np.int32)),
                 pa.array(rows[:, 3]), pa.array(rows[:, 4]), group.column("line").combine_chunks().take(at),
                 group.column("upto").combine_chunks().take(last)],
                [*DOC, "i", "m", "r1", "r2", "first_line", "last_line"])

    runs = (ranks.repartition(*DOC).sortWithinPartitions(*DOC, "k", "i")
            .select(*DOC, "k", "i", "rank", "line", "upto", "words")
            .mapInArrow(windows, f"doc_id {kind}, h bigint, i int, m int, r1 bigint, r2 bigint, first_line int, "
                                 "last_line int"))
    runs = materialize(runs, "line-runs")
    interval = ["m", "r1", "r2"]
    # written, so that the join deals its rows anew and can split an interval with very many copies
    copies = materialize(runs.groupBy(*interval).agg(F.min(F.struct(*DOC, "i")).alias("source"), F.count("*").alias("n"))
                         .where("n > 1").drop("n"), "line-intervals")
    return (runs.join(copies, interval).where(~F.struct(*DOC, "i").eqNullSafe(F.col("source")))
            .select(*DOC, "first_line", "last_line", "source", "m"))


def without(text: str, spans: list[dict]) -> tuple[str, int, int, str]:
    """Text without the lines in ``spans``; its lines, the number removed, and the merged spans."""
    parts = text.split("\n")
    edge = np.zeros(len(parts) + 1, np.int64)
    for s in spans:
        edge[s["first_line"]] += 1
        edge[s["last_line"] + 1] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    turn = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
    merged = ",".join(f"{a}-{b - 1}" for a, b in zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True))
    return "\n".join(p for p, g in zip(parts, gone, strict=True) if not g), len(parts), int(gone.sum()), merged


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs cut from ``text``, and n_lines, n_removed and the removed line spans."""
    kept = [c for c in docs.columns if c not in ADDED]
    spans = (repeated_runs(docs.select("doc_id", "text"), min_words).groupBy(*DOC)
             .agg(F.collect_set(F.struct("first_line", "last_line")).alias("spans"))
             .withColumnsRenamed({"doc_id": "s_id", "h": "s_h"}))
    others = [c for c in kept if c != "text"]
    rows = docs.select(packed(others), "doc_id", "text", F.xxhash64("text").alias("h"))
    joined = (rows.join(spans, rows["doc_id"].eqNullSafe(spans["s_id"]) & (rows["h"] == spans["s_h"]), "left")
              .select("kept", "text", "spans"))
    schema = f"kept {joined.schema['kept'].dataType.simpleString()}, text string, n_lines int, n_removed int, removed string"

    def cut(batches):
        for batch in slices(batches):
            found = [without(t, s or []) if t is not None else (None, 0, 0, "") for t, s in zip(
                batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)]
            text, n, gone, merged = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(text, pa.string()), pa.array(n, pa.int32()), pa.array(gone, pa.int32()),
                 pa.array(merged, pa.string())], ["kept", "text", *ADDED])

    found = joined.mapInArrow(cut, schema).select(*unpacked(others), F.col("text").alias("text"), *ADDED)
    return found.select(*[F.col(f"`{c}`") for c in [*kept, *ADDED]])
