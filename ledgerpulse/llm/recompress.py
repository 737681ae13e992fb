"""Operator 11: removal of repeated word windows by recompression.

Every round of the recompression first names the maximal runs of one symbol, then pairs of a left and a right
symbol, sides being a bit of the symbol's hash. Names are 128-bit hashes of what they stand for, so they are global
and equal word sequences get equal symbols inside, up to a few at their ends. Documents are parsed in blocks
by numpy; Spark compares the names of all blocks in two rounds:

1. Each block asks whether its symbols of ``window`` words or more occur in a document with a smaller id, and its
   symbols after ``PRUNE`` rounds of naming in any other one. A large symbol that does reveals a repeat: all its words go. A
   small one that does not rules out every window that surely holds it, that is, all the words its being there depends on.
2. The windows left that cover a word not yet removed are asked for by a 128-bit hash of their words, which
   verifies them one by one. The windows and the words removed so far go along as two bits a word, so that the last pass over
   the texts hashes words and windows but names no symbols again.

A question is a symbol's name, the smallest id that has it in the block and whether another one has, once for each
block, so a passage of millions of documents is one entry of each block. Names are grouped by ranges of the hash and answered by one bit.
Between the rounds blocks lie in a table bucketed by block, so answers join them without a shuffle of texts.

Null and empty texts have no words. Texts are read whole. Documents of equal id do not make each other's windows
repeats; repeated rows get the same result each. A missing id counts as smaller than every other. An empty
table gives an empty table. Columns other than doc_id (an integer) and text are ignored, whatever their names.
"""

import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import column, starts, whole_groups
from ledgerpulse.storage import materialize, scratch_path

WINDOW = 13
PRUNE = 2                  # rounds after which small symbols rule out windows; no effect on results
ROUNDS = 24                # rounds of naming; windows find what is left after them
BLOCK = 8 << 20            # bytes of text in a block; a longer text is a block of its own
BUCKET = 64 << 20          # bytes of text for each bucket
FAR = 1 << 40              # beyond every word
NO_ID = -(1 << 63)
SMALL, LARGE, WINDOWS, STATE = 0, 1, 2, 3     # kinds of questions; what a block found so far goes along with them
MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _times(x: np.uint64, k: int) -> np.uint64:
    return np.uint64(int(x) * k & (1 << 64) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * MIX[1]
    x = (x ^ x >> np.uint64(27)) * MIX[2]
    return x ^ x >> np.uint64(31)


def named(x: np.ndarray, y: np.ndarray, salt: int) -> np.ndarray:
    """Names of ordered pairs."""
    return mixed(x * MIX[0] + mixed(y + _times(MIX[3], salt + 1)))


class Symbols:
    """A row of symbols: two names, the words [s, e) they stand for, and the words [ds, de) their being there depends on."""

    FIELDS = ("a", "b", "s", "e", "ds", "de", "doc")

    def __init__(self, *parts: np.ndarray):
        self.a, self.b, self.s, self.e, self.ds, self.de, self.doc = parts

    def take(self, at: np.ndarray) -> "Symbols":
        a, b, s, e, doc = (x[at] for x in (self.a, self.b, self.s, self.e, self.doc))
        return Symbols(a, b, s, e, *((s, e) if self.ds is self.s else (self.ds[at], self.de[at])), doc)


def _beside(x: np.ndarray, doc: np.ndarray, step: int, edge: int) -> np.ndarray:
    """The value of the neighbour ``step`` to the right, ``edge`` where there is none in the document."""
    out = np.full(len(x), edge, x.dtype)
    same = doc[1:] == doc[:-1]
    if step == 1:
        out[:-1][same] = x[1:][same]
    else:
        out[1:][same] = x[:-1][same]
    return out


def runs_named(z: Symbols, word: np.ndarray, depend: bool) -> tuple[Symbols, np.ndarray]:
    """Maximal runs of a symbol as one symbol, and which symbols are new.

    That a run ends at a border is plain from the next word if that differs from the one the run would go on
    with, and else from the neighbour symbol.
    """
    head = starts(z.doc, z.a)
    size = np.diff(np.r_[head, len(z.a)])
    out, last = z.take(head), head + size - 1
    if depend:
        out.de = z.de[last]
    out.e = z.e[last]
    long = np.flatnonzero(size > 1)
    for name, salt in (("a", 0), ("b", 1)):
        x = getattr(out, name)
        x[long] = named(x[long], size[long].astype(np.uint64), salt + 2)
    if depend and len(head):
        after, before = np.minimum(last + 1, len(z.a) - 1), np.maximum(head - 1, 0)    # the symbols beside the run
        right = np.where(word[z.s[after]] != word[out.s], out.e + 1, z.de[after])
        left = np.where(word[z.e[before] - 1] != word[out.e - 1], out.s - 1, z.ds[before])
        right[(after == last) | (z.doc[after] != out.doc)] = FAR
        left[(before == head) | (z.doc[before] != out.doc)] = -FAR
        out.de, out.ds = np.maximum(out.de, right), np.minimum(out.ds, left)
    new = np.zeros(len(head), bool)
    new[long] = True
    return out, new


def pairs_named(z: Symbols, turn: int, depend: bool) -> tuple[Symbols, np.ndarray]:
    """Each left symbol with a right one behind it as one symbol, and which symbols are new."""
    right_side = mixed(z.a + _times(MIX[4], turn + 1)) & np.uint64(1) == 1
    first = np.flatnonzero(~right_side[:-1] & right_side[1:] & (z.doc[1:] == z.doc[:-1]))
    keep = np.ones(len(z.a), bool)
    keep[first + 1] = False
    new = np.zeros(len(z.a), bool)
    new[first] = True
    out = Symbols(z.a.copy(), z.b.copy(), z.s, z.e.copy(), z.ds, z.de, z.doc)
    out.a[first] = named(z.a[first], z.a[first + 1], 0)
    out.b[first] = named(z.b[first], z.b[first + 1], 1)
    out.e[first] = z.e[first + 1]
    if depend:
        # a pair depends on its two symbols; one that is left alone also on the neighbour it could have joined
        reach_r, low_r = _beside(z.de, z.doc, 1, FAR), _beside(z.ds, z.doc, 1, FAR)
        reach_l, low_l = _beside(z.de, z.doc, -1, -FAR), _beside(z.ds, z.doc, -1, -FAR)
        out.de = np.maximum(z.de, np.where(right_side, reach_l, reach_r))
        out.ds = np.minimum(z.ds, np.where(right_side, low_l, low_r))
    return out.take(np.flatnonzero(keep)), new[keep]


def _merged(docs: pa.Table) -> tuple[np.ndarray, list[list[bytes]]]:
    ids = docs.column("doc_id").cast(pa.int64()).fill_null(NO_ID).combine_chunks().to_numpy()
    return ids, [(t or "").encode().split() for t in docs.column("text").to_pylist()]   # only ASCII blanks part words


class Block:
    """The parse of a block of documents, its questions, and what the answers remove. A block with a ``state``, that of
    its windows, needs no parse."""

    def __init__(self, docs: pa.Table, window: int, answers: dict[int, np.ndarray] | None = None, state: bytes | None = None):
        self.window, self.answers = window, answers or {}
        self.id, self.words = _merged(docs)
        self.first = np.cumsum([0, *map(len, self.words)])
        size = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(size)), size)
        self.state = state
        code = b"".join(map(xxhash.xxh3_128_digest, chain.from_iterable(self.words)))
        self.name = np.frombuffer(code, np.uint64).reshape(-1, 2).T.copy()
        if state is None:
            self.parse()

    def parse(self) -> None:
        """Sets ``small``, the symbols after ``PRUNE`` rounds, and ``large``, all of ``window`` words or more."""
        at = np.arange(len(self.doc))
        z, large = Symbols(*self.name, at, at + 1, at, at + 1, self.doc), []
        for turn in range(ROUNDS):
            for step in (runs_named, pairs_named):
                z, new = step(z, self.name[0], turn < PRUNE) if step is runs_named else step(z, turn, turn < PRUNE)
                large.append(z.take(np.flatnonzero(new & (z.e - z.s >= self.window))))
            if turn == PRUNE - 1:
                self.small = z.take(np.flatnonzero(z.de - z.ds <= self.window))
                z.ds, z.de = z.s, z.e       # not followed any further
        self.large = Symbols(*(np.concatenate([getattr(p, f) for p in large]) for f in Symbols.FIELDS))

    # --- questions and answers --------------------------------------------------------------

    def asked(self, a: np.ndarray, b: np.ndarray | None, doc: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct names in order, their smallest id, whether they have several ids, and of every given name its number."""
        order = np.argsort(a, kind="stable") if b is None else np.lexsort((b, a))
        head = starts(a[order]) if b is None else starts(a[order], b[order])
        number = np.empty(len(a), np.int64)
        number[order] = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(a)]))
        ids = self.id[doc[order]]
        least, most = (f.reduceat(ids, head) if len(head) else ids for f in (np.minimum, np.maximum))
        at = order[head]
        return a[at], None if b is None else b[at], least, least < most, number

    def shared(self) -> np.ndarray:
        """Which small symbols occur in documents of two ids or more."""
        z = self.small
        *_, several, number = self.asked(z.a, None, z.doc)
        return (self.answers.get(SMALL, np.zeros(len(several), bool)) | several)[number]

    def earlier(self, kind: int, a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Which names occur in a document with a smaller id than the document at hand."""
        _, _, least, _, number = self.asked(a, b, doc)
        return self.answers.get(kind, np.zeros(len(least), bool))[number] | (least[number] < self.id[doc])

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Windows that may repeat and cover a word that the large symbols leave, and the words these remove."""
        n, k = len(self.doc), self.window
        if self.state is not None:
            if not n:
                return np.zeros(0, np.int64), np.zeros(0, bool)
            bits = np.unpackbits(np.frombuffer(self.state, np.uint8).reshape(2, -1), axis=1, count=n).astype(bool)
            return np.flatnonzero(bits[0]), bits[1]
        x, z = self.large, self.small
        hit = self.earlier(LARGE, x.a, x.b, x.doc)
        gone, alone = covered(n, x.s[hit], x.e[hit]), ~self.shared()
        low = np.maximum(z.de[alone] - k, self.first[z.doc[alone]])
        out = covered(n, low, z.ds[alone] + 1)
        last = self.first[1:][self.doc] - k
        removed = np.r_[0, np.cumsum(gone)]
        at = np.flatnonzero(~out & (np.arange(n) <= last))
        return at[removed[at + k] - removed[at] < k], gone

    def stated(self, at: np.ndarray, gone: np.ndarray) -> bytes:
        """What ``windows`` found, one bit a word for either part."""
        bits = np.zeros((2, len(gone)), bool)
        bits[0, at], bits[1] = True, gone
        return np.packbits(bits, axis=1).tobytes()

    def window_names(self, at: np.ndarray) -> list[np.ndarray]:
        out = []
        for x, step in zip(self.name, (MIX[0], MIX[3]), strict=True):
            h = np.zeros(len(at), np.uint64)
            for k in range(self.window):
                h = h * step + x[at + k]
            out.append(mixed(h))
        return out

    def questions(self, kind: int, a: np.ndarray, b: np.ndarray | None, doc: np.ndarray, buckets: int):
        """(bucket, blob) of the distinct names."""
        a, b, least, several, _ = self.asked(a, b, doc)
        bucket = bucket_of(a, buckets)
        cut = np.r_[starts(bucket), len(a)]
        for low, high in zip(cut, cut[1:], strict=False):
            yield int(bucket[low]), kind, packed(
                a[low:high], None if b is None else b[low:high], least[low:high], several[low:high])

    def removed(self) -> np.ndarray:
        at, gone = self.windows()
        hit = at[self.earlier(WINDOWS, *self.window_names(at), self.doc[at])]
        return gone | covered(len(gone), hit, hit + self.window)


def covered(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in one of the stretches [low, high)."""
    edge = np.bincount(low[low < high], minlength=n + 1) - np.bincount(high[low < high], minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def bucket_of(a: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the name, so that buckets keep the order of names."""
    return ((a >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def packed(a: np.ndarray, b: np.ndarray | None, least: np.ndarray, several: np.ndarray) -> bytes:
    """Names and ids as bytes: six of a small symbol's name, for its equality only rules windows out less often;
    all sixteen of others; ids as distances from the lowest."""
    base = int(least.min())
    far = least.astype(np.uint64) - np.uint64(base & (1 << 64) - 1)
    width = max(1, (int(far.max()).bit_length() + 7) // 8)
    names = [a.view(np.uint8).reshape(-1, 8)[:, :6]] if b is None else [x.view(np.uint8).reshape(-1, 8) for x in (a, b)]
    head = np.array([len(a), base, width, 6 if b is None else 16], np.int64)
    return head.tobytes() + b"".join(
        x.tobytes() for x in [*names, far.view(np.uint8).reshape(-1, 8)[:, :width], np.packbits(several)])


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What ``packed`` was given."""
    n, base, width, size = np.frombuffer(blob, np.int64, 4).tolist()

    def read(at: int, w: int) -> np.ndarray:
        out = np.zeros((n, 8), np.uint8)
        out[:, :w] = np.frombuffer(blob, np.uint8, n * w, at).reshape(n, w)
        return out.view(np.uint64).ravel()

    a = read(32, min(size, 8))
    b = read(32 + 8 * n, 8) if size == 16 else np.zeros(n, np.uint64)
    several = np.unpackbits(np.frombuffer(blob, np.uint8, offset=32 + n * (size + width)), count=n).astype(bool)
    return a, b, (read(32 + n * size, width) + np.uint64(base & (1 << 64) - 1)).view(np.int64), several


def answered(questions: DataFrame) -> DataFrame:
    """(block, kind, bucket, n, bits): of every name of a question whether it occurs with a smaller id elsewhere, of a
    small symbol with any two ids. States come back as they are."""
    by = ["kind", "bucket"]

    def answer(batches):
        for group in whole_groups(batches, by):
            kind, bucket = column(group, "kind"), column(group, "bucket")
            block, blobs = column(group, "block"), group.column("blob").to_pylist()
            head = starts(kind, bucket)
            for low, high in zip(head, [*head[1:], len(kind)], strict=True):
                if kind[low] == STATE:
                    yield from group.slice(low, high - low).select(["block", *by]).append_column(
                        "n", pa.array(np.zeros(high - low, np.int64))).append_column("bits", pa.array(blobs[low:high], pa.binary())).to_batches()
                    continue
                parts = [unpacked(x) for x in blobs[low:high]]
                a, b, least, several = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = np.lexsort((least, b, a))
                new = starts(a[order], b[order])
                lowest, end = least[order[new]], np.r_[new[1:], len(a)] - 1
                yes = np.empty(len(a), bool)
                if kind[low] == SMALL:
                    found = (lowest < least[order[end]]) | np.logical_or.reduceat(several[order], new)
                    yes[order] = np.repeat(found, end + 1 - new)
                else:
                    yes[order] = np.repeat(lowest, end + 1 - new) < least[order]
                cut = np.cumsum([0, *(len(p[0]) for p in parts)])
                bits = [np.packbits(yes[i:j]).tobytes() for i, j in zip(cut, cut[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[low:high]), pa.array(kind[low:high]), pa.array(bucket[low:high]),
                     pa.array(np.diff(cut)), pa.array(bits, pa.binary())], ["block", *by, "n", "bits"])

    return questions.repartition(*by).sortWithinPartitions(*by).mapInArrow(
        answer, "block bigint, kind int, bucket bigint, n bigint, bits binary")


def _read(answers: pa.Table) -> tuple[dict[int, np.ndarray], bytes | None]:
    """Answers of a block by kind, in the order of its names, and its state."""
    out: dict[int, list] = {}
    state = None
    for r in answers.sort_by([("kind", "ascending"), ("bucket", "ascending")]).to_pylist():
        if r["kind"] == STATE:
            state = r["bits"]
            continue
        out.setdefault(r["kind"], []).append(np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]).astype(bool))
    return {k: np.concatenate(v) for k, v in out.items()}, state


def blocks(docs: DataFrame, size: int) -> DataFrame:
    """(block, doc_id, text): rows of each task in blocks of ``size`` bytes of text."""
    def cut(batches):
        block, used = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            length = batch.column("text").cast(pa.binary()).to_pylist()
            number = []
            for t in length:
                if used and used + len(t or b"") > size:
                    block, used = block + 1, 0
                used += len(t or b"")
                number.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), *batch.columns], ["block", "doc_id", "text"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, "block bigint, doc_id bigint, text string")


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` in files bucketed by block in the shared folder; the catalog keeps no trace of it."""
    spark, name = df.sparkSession, f"ledgerpulse_blocks_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "block").sortBy("block").option("path", scratch_path(spark, "blocks")).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")      # of an external table the files stay
    return out


def removed_windows(docs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, text) of every document.

    Every word goes that lies in ``window`` consecutive words which also stand in a document of smaller id. ``removed`` holds
    the stretches of removed words as "first-last", words counted from 0; ``text`` is the words kept, joined by one blank.
    """
    spark = docs.sparkSession
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    table = _bucketed(blocks(docs, block), buckets)
    out_schema = "block bigint, kind int, bucket bigint, blob binary"

    def rows(number: int, asked: list) -> pa.Table:
        return pa.table({"block": pa.array([number] * len(asked), pa.int64()), "kind": pa.array([k for _, k, _ in asked], pa.int32()),
                         "bucket": pa.array([b for b, _, _ in asked], pa.int64()), "blob": pa.array([x for *_, x in asked], pa.binary())})

    def ask_symbols(texts: pa.Table) -> pa.Table:
        own = Block(texts, window)
        small, large = own.small, own.large
        return rows(texts.column("block")[0].as_py(), [*own.questions(SMALL, small.a, None, small.doc, buckets),
                                                       *own.questions(LARGE, large.a, large.b, large.doc, buckets)])

    def ask_windows(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return rows(0, [])
        number, own = texts.column("block")[0].as_py(), Block(texts, window, *_read(answers))
        at, gone = own.windows()
        return rows(number, [*own.questions(WINDOWS, *own.window_names(at), own.doc[at], buckets),
                             (((number >> 32) + number) % buckets, STATE, own.stated(at, gone))])

    def cut(texts: pa.Table, answers: pa.Table) -> pa.Table:
        own = Block(texts, window, *_read(answers))
        gone = own.removed()
        edge = np.flatnonzero(np.diff(np.r_[0, gone, 0]))
        low, high = edge[::2], edge[1::2]
        sums, kept, spans = np.r_[0, np.cumsum(gone)], [], []
        for k, words in enumerate(own.words):
            a, b = int(own.first[k]), int(own.first[k + 1])
            if sums[b] == sums[a]:
                kept.append(b" ".join(words).decode())
                spans.append("")
                continue
            i, j = np.searchsorted(high, a, "right"), np.searchsorted(low, b)
            part = [(max(x, a) - a, min(y, b) - a) for x, y in zip(low[i:j].tolist(), high[i:j].tolist(), strict=True)]
            spans.append(",".join(f"{x}-{y - 1}" for x, y in part))
            ends = [0, *chain.from_iterable(part), len(words)]
            kept.append(b" ".join(chain.from_iterable(words[x:y] for x, y in zip(ends[::2], ends[1::2], strict=True))).decode())
        return pa.table({"doc_id": texts.column("doc_id"), "n_words": pa.array(np.diff(own.first)),
                         "n_removed": pa.array(np.diff(sums[own.first])), "removed": pa.array(spans, pa.string()),
                         "text": pa.array(kept, pa.string())})

    def with_answers(answers: DataFrame):
        return table.groupBy("block").cogroup(answers.groupBy("block"))

    first = materialize(answered(table.groupBy("block").applyInArrow(ask_symbols, out_schema)), "symbol-answers")
    second = materialize(answered(with_answers(first).applyInArrow(ask_windows, out_schema)), "window-answers")
    return with_answers(second).applyInArrow(
        cut, "doc_id bigint, n_words bigint, n_removed bigint, removed string, text string")
