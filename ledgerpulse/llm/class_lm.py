"""Operator 6: class-based n-gram language model with exchange clustering.

Word and bigram counts cover every training text, and every word of them is exchanged between ``CLASSES``
classes: it moves to the class that raises the likelihood of the class bigrams most. The ``head`` most frequent
words start from an exchange of their own, one word at a time; then all words choose at once, round after
round, each from its own bigrams and the table of class bigrams; those that gain most, ``TURNS`` of them, move one after the other, and half
of the others that gain (in the first round all) at once. A round counts only if the likelihood rises; if it falls, fewer words
move, at last the one that gains most. This ends when no word gains by moving or, with a ``least_gain``, when a round raises the log
likelihood by less than that a token; the rule is the same for all words, each of which is rated in every round. A text's log10 probability adds class transitions, smoothed towards class frequencies, and
word emissions with one count added to every word of a class and to one unseen word. A word that no training
text holds has no class: it counts as in the base, and the word after it by its class frequency.

Texts are read once, into chunks of numbered words, bucketed so that the numbers of their words meet them without a
shuffle. Words and bigrams travel as blobs. Bigrams lie in packs of about ``PACK`` entries, each word's in one pack; words of more
than a ``HUBS``-th of all tokens are spread over packs and their sums added up. A pass over the packs counts the class bigrams
and rates all words by what these were expected to be. Of every word the driver and the tasks hold one byte, its class; the
``LOOKUP`` most frequent words are numbered on the driver, all others part by part. Packs of up to ``LOCAL`` entries in all are
exchanged on the driver by the same functions.

Null and empty texts consist of the end alone; texts of any length are read whole. Rows are scored one by
one, also repeated ones. Without training texts every count is zero. An empty table gives an empty table;
other columns are kept unless their names clash with the added ones.
"""

import uuid
import zlib
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import column, packed as kept_of, slices, starts, texts, unpacked, whole_groups
from ledgerpulse.storage import materialize, scratch_path

HEAD, CLASSES, LOOKUP = 1024, 48, 200_000
END = b""                       # words are never empty
FLUSH, TOKENS = 300_000, 1_000_000      # TOKENS: also of a chunk
PACK, HUBS, LOCAL = 200_000, 5_000, 3_000_000
FILE = 4                        # packs in a file
TURNS = 4096                    # words moved one by one in a round
SHARE = 0.5                     # of the other words that gain, at most so many move at once
BLOCK, TABLED = 256, 64         # words rated at a time; counts whose gains are tabled
KIND = np.random.default_rng(42).integers(1, 1 << 63, 512).astype(np.uint64) | np.uint64(1)   # marks by class and side
TOLERANCE = 1e-6                # gains below it are none
LEAST_GAIN = 1e-4               # of the log likelihood a token: what the registered query takes for ``least_gain``
VOCABULARY = 200_000            # words of chunks, repeats included, for each part that counts words
BUCKET = 16 << 20               # bytes of text for each bucket of chunks
BINS = 16 * 64                  # counts in steps of a sixteenth of a doubling
NEAR, OWN, SIZE = 0, 1, 2       # what a pass over the packs counts at the start
PRIOR = 20.0                    # weight of the class frequencies in a transition
ADDED = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]


def words_of(text: str) -> list[bytes]:
    """Words of a text; on bytes, only A-Z are lowered and only ASCII blanks part words."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def split_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words_of`` all texts, one after the other, and how many each has; a null has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text.fill_null("")))
    words, size = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0    # blanks at an end leave an empty word there
    return words.filter(pa.array(full)), np.bincount(np.repeat(np.arange(len(size)), size)[full], minlength=len(size))


def key_of(word: bytes) -> int:
    """Negative number of a word outside the dictionary."""
    return (xxhash.xxh64_intdigest(word, 42) | 1 << 63) - (1 << 64)


def symbols_packed(x: np.ndarray) -> bytes:
    """Small numbers, most of them below 65,535, as low and high bytes apart; the others by themselves."""
    near = np.minimum(x, 0xFFFF).astype(np.uint16)
    return b"".join(y.tobytes() for y in (np.array([len(x)], np.int64), x[near == 0xFFFF].astype(np.int32),
                                          (near & 0xFF).astype(np.uint8), (near >> 8).astype(np.uint8)))


def symbols_unpacked(blob: bytes) -> np.ndarray:
    size = int(np.frombuffer(blob, np.int64, 1)[0])
    planes = np.frombuffer(blob, np.uint8, 2 * size, len(blob) - 2 * size).reshape(2, size)
    out = planes[0] | planes[1].astype(np.int64) << 8
    out[out == 0xFFFF] = np.frombuffer(blob[8:len(blob) - 2 * size], np.int32)
    return out


def chunks(rows: DataFrame) -> tuple[DataFrame, int]:
    """Texts as numbers, in a table bucketed by chunk, and its number of buckets. ``rows``: kept, text, learn, scored.

    A chunk is about ``TOKENS`` tokens of whole texts, in which words are numbered by their training count. ``words`` are
    joined by blanks, in the order of their checksums, and ``n`` holds their training counts in that order.
    """
    spark = rows.sparkSession

    def read(batches):
        number, held, tokens = TaskContext.get().partitionId() << 32, [], 0

        def out():
            words, kept, size, learn, scored = zip(*held, strict=True)
            coded, kept = pa.concat_arrays(words).dictionary_encode(), pa.concat_arrays(kept)
            at, words = coded.indices.to_numpy(), coded.dictionary.cast(pa.binary()).to_pylist()
            size, learn, scored = (np.concatenate(x) for x in (size, learn, scored))
            n = np.bincount(at[np.repeat(learn, size)], minlength=len(words))
            order = np.argsort(np.fromiter(map(zlib.crc32, words), np.int64, len(words)), kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[order[np.argsort(-n[order], kind="stable")]] = np.arange(len(words))
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept),
                 pa.array([symbols_packed(rank[at])]), *(pa.array([x.tobytes()]) for x in (size, learn, scored)),
                 pa.array([int(learn.sum())]), pa.array([b" ".join([words[i] for i in order.tolist()])]), pa.array([n[order].tobytes()])],
                ["chunk", "kept", "tokens", "size", "learn", "scored", "ends", "words", "n"])

        for batch in slices(batches):
            words, size = split_words(batch.column("text"))
            held.append((words, batch.column("kept"), size, column(batch, "learn"), column(batch, "scored")))
            tokens += len(words)
            if tokens > TOKENS:
                yield out()
                held, tokens, number = [], 0, number + 1
        if held:
            yield out()

    kind = rows.schema["kept"].dataType.simpleString()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    return bucketed(rows.mapInArrow(read, f"chunk bigint, kept array<{kind}>, tokens binary, size binary, learn binary, "
                                          "scored binary, ends bigint, words binary, n binary"), buckets), buckets


def bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` in files bucketed by chunk in the shared folder; the catalog keeps no trace of it."""
    spark, name = df.sparkSession, f"ledgerpulse_chunks_{uuid.uuid4().hex}"
    (df.write.option("compression", "zstd").bucketBy(buckets, "chunk").sortBy("chunk")
     .option("path", scratch_path(spark, "chunks")).saveAsTable(name))
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")      # of an external table the files stay
    return out


def word_parts(table: DataFrame) -> DataFrame:
    """Words of all chunks and their training counts ``c``, in parts dealt by the words' checksums.

    A part also holds, for each ``chunk`` that has words of it, their number ``size`` and places ``at`` in the part.
    """
    entries = table.agg(F.coalesce(F.sum(F.octet_length("n")), F.lit(0)).alias("n")).first()["n"] // 8
    parts = max(1, -(-entries // VOCABULARY))

    def deal(batches):
        for batch in batches:
            for chunk, words, n in zip(*(batch.column(c).to_pylist() for c in ("chunk", "words", "n")), strict=True):
                words, n = words.split(b" ") if words else [], np.frombuffer(n, np.int64)
                p = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) * parts >> 32
                head = starts(p)
                cut = list(zip(head.tolist(), [*head[1:].tolist(), len(p)], strict=False))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p[head].astype(np.int32)), pa.array(np.full(len(head), chunk, np.int64)),
                     pa.array([b" ".join(words[i:j]) for i, j in cut], pa.binary()),
                     pa.array([n[i:j].tobytes() for i, j in cut], pa.binary())], ["p", "chunk", "words", "n"])

    def add(batches):
        for group in whole_groups(batches, ["p"]):
            p, chunk = column(group, "p"), column(group, "chunk")
            words, n = group.column("words").to_pylist(), group.column("n").to_pylist()
            head = starts(p)
            for low, high in zip(head, [*head[1:], len(p)], strict=True):
                number: defaultdict = defaultdict()
                number.default_factory = number.__len__
                size = [len(x) // 8 for x in n[low:high]]
                at = np.fromiter(chain.from_iterable(map(number.__getitem__, x.split(b" ")) for x in words[low:high]), np.int64, sum(size))
                c = np.zeros(len(number), np.int64)
                np.add.at(c, at, np.frombuffer(b"".join(n[low:high]), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p[low:low + 1]), pa.array([b" ".join(number)]), *(pa.array([x.tobytes()]) for x in (
                        c, chunk[low:high], np.array(size, np.int64), at.astype(np.int32)))], ["p", "words", "c", "chunk", "size", "at"])

    return (table.select("chunk", "words", "n").mapInArrow(deal, "p int, chunk bigint, words binary, n binary")
            .repartition("p").sortWithinPartitions("p")
            .mapInArrow(add, "p int, words binary, c binary, chunk binary, size binary, at binary"))


def steps_of(c: np.ndarray) -> np.ndarray:
    """Which sixteenth of a doubling a count lies in; -1 for none."""
    return np.where(c > 0, np.floor(np.log2(np.maximum(c, 1)) * 16), -1).astype(np.int64)


def rows_of(table: DataFrame, names: list[str], fn, schema: str) -> DataFrame:
    """``fn`` of the named columns of each row; int64 blobs come as arrays."""
    def apply(batches):
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                yield from fn(*row)
    return table.select(*names).mapInArrow(apply, schema)


def numbered(left: pa.Table, right: pa.Table) -> tuple:
    """Of a chunk: word numbers (-1: of no training text) of its tokens, their counts, sizes of the texts and the flags."""
    n, blob, *rest = (left.column(c)[0].as_py() for c in ("n", "tokens", "size", "learn", "scored"))
    right = right.sort_by("p")
    number, c = (np.frombuffer(b"".join(right.column(x).to_pylist()), kind) for x, kind in (("id", np.int32), ("c", np.int64)))
    order = np.argsort(-np.frombuffer(n, np.int64), kind="stable")
    return (symbols_unpacked(blob), number[order].astype(np.int64), c[order], np.frombuffer(rest[0], np.int64),
            np.frombuffer(rest[1], bool), np.frombuffer(rest[2], bool))


class Lexicon:
    """Number of the words that tasks hold, the most frequent first."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        self.index = {w: k for k, w in enumerate(words)}
        self.count = np.append(counts, 0).astype(np.int64)   # the last entry stands for words not held here


def chained(size: np.ndarray, symbol: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, previous and current symbol of every token of texts of ``size`` words; each starts after an end and closes with one."""
    row = np.repeat(np.arange(len(size)), size + 1)
    now = np.insert(symbol, np.cumsum(size), end)
    before = np.r_[end, now[:-1]]
    return row, before, now


def edges_packed(u: np.ndarray, v: np.ndarray, n: np.ndarray) -> bytes:
    """Bigrams as bytes: each run of one ``u`` once, ``v`` in four bytes if in the lexicon, counts of 255 and more by themselves."""
    head, rare, large = starts(u), v < 0, np.flatnonzero(n >= 255)
    return b"".join(x.tobytes() for x in (
        np.array([len(u), len(head), rare.sum(), len(large)], np.int64), u[head], v[rare], n[large].astype(np.int64),
        np.diff(np.r_[head, len(u)]).astype(np.int32), v[~rare].astype(np.int32), large.astype(np.int32),
        np.minimum(n, 255).astype(np.uint8), np.packbits(rare)))


def edges_unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``edges_packed`` was given."""
    size, runs, keys, more = np.frombuffer(blob, np.int64, 4).tolist()
    at, parts = 32, []
    for kind, k in ((np.int64, runs), (np.int64, keys), (np.int64, more), (np.int32, runs), (np.int32, size - keys),
                    (np.int32, more), (np.uint8, size)):
        parts.append(np.frombuffer(blob, kind, k, at))
        at += k * np.dtype(kind).itemsize
    u, far, value, times, near, large, count = parts
    rare = np.unpackbits(np.frombuffer(blob, np.uint8, offset=at), count=size).astype(bool)
    v, n = np.empty(size, np.int64), count.astype(np.int64)
    v[rare], v[~rare], n[large] = far, near, value
    return np.repeat(u, times), v, n


def bigrams(docs: DataFrame, lexicon, parts: int) -> DataFrame:
    """(u, v, n) of adjacent words over all texts: 0 is the end, words of the lexicon count from 1, others are keys.

    Tasks send their bigrams as blobs to ``parts`` parts dealt by a hash of both words, each of which adds up its own.
    """
    def count(batches):
        lex: Lexicon = lexicon.value
        local, keys, held, size = {}, [0], [], 0

        def out():
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            key = np.array(keys, np.int64)
            u, v = key[pair >> 32], key[pair & 0xFFFFFFFF]
            mix = (u.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ v.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            p = ((mix >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.uint16 if parts < 1 << 16 else np.int64)
            order = np.argsort(p, kind="stable")     # words stay together
            p, u, v, n = (x[order] for x in (p, u, v, n))
            head = starts(p)
            return pa.RecordBatch.from_arrays(
                [pa.array(p[head].astype(np.int32)), pa.array([edges_packed(u[i:j], v[i:j], n[i:j]) for i, j in zip(
                    head, [*head[1:], len(p)], strict=True)], pa.binary())], ["p", "blob"])

        for batch in slices(batches):
            rows = [words_of(t) for t in texts(batch)]
            for w in set().union(*rows).difference(local):
                local[w] = len(keys)
                k = lex.index.get(w)
                keys.append(key_of(w) if k is None else k + 1)
            symbol = np.fromiter((k for r in rows for k in map(local.__getitem__, r)), np.int64, sum(map(len, rows)))
            _, before, now = chained(np.fromiter(map(len, rows), np.int64, len(rows)), symbol, 0)
            held.append(before << 32 | now)
            size += len(now)
            if size > TOKENS or len(keys) > FLUSH:
                yield out()
                local, keys, held, size = {}, [0], [], 0
        if held:
            yield out()

    def add(batches):
        for group in whole_groups(batches, ["p"]):
            p, blobs = column(group, "p"), group.column("blob").to_pylist()
            head = starts(p)
            for low, high in zip(head, [*head[1:], len(p)], strict=True):
                found = zip(*map(edges_unpacked, blobs[low:high]), strict=True)
                rows = pa.table([pa.array(np.concatenate(x)) for x in found], names=["u", "v", "n"])
                rows = rows.group_by(["u", "v"], use_threads=False).aggregate([("n", "sum")])
                yield from rows.select(["u", "v", "n_sum"]).rename_columns(["u", "v", "n"]).to_batches(max_chunksize=FLUSH)

    return (docs.select("text").mapInArrow(count, "p int, blob binary").repartition("p").sortWithinPartitions("p")
            .mapInArrow(add, "u bigint, v bigint, n bigint"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, head: int, classes: int) -> np.ndarray:
    """Class of every symbol. Head symbols move between ``classes`` classes until a pass moves none, the others keep
    one each."""
    symbols = len(pairs)
    label = np.r_[np.arange(head) % classes, classes + np.arange(symbols - head)]
    total = classes + symbols - head
    one = np.zeros((symbols, total))
    one[np.arange(symbols), label] = 1
    right, left = pairs @ one, pairs.T @ one      # of each symbol with each class
    joint = one.T @ right
    use = pairs.sum(axis=1)
    weight = one.T @ use
    while True:
        moved = 0
        for w in range(head):
            a, own = label[w], pairs[w, w]
            r, c = right[w].copy(), left[w].copy()
            r[a] -= own
            c[a] -= own
            joint[a] -= r
            joint[:, a] -= c
            joint[a, a] -= own
            weight[a] -= use[w]
            base = _xlogx(joint[:classes])
            gain_r = _xlogx(joint[:classes] + r) - base
            gain_c = _xlogx(joint[:, :classes] + c[:, None]) - _xlogx(joint[:, :classes])
            at = np.arange(classes)
            corner = joint[at, at]
            gain = (gain_r.sum(axis=1) - gain_r[at, at] + gain_c.sum(axis=0) - gain_c[at, at]
                    + _xlogx(corner + r[:classes] + c[:classes] + own) - _xlogx(corner)
                    - 2 * (_xlogx(weight[:classes] + use[w]) - _xlogx(weight[:classes])))
            b = int(gain.argmax())
            if gain[b] <= gain[a] + TOLERANCE:
                b = a
            joint[b] += r
            joint[:, b] += c
            joint[b, b] += own
            weight[b] += use[w]
            if b != a:
                label[w] = b
                moved += 1
                right[:, a] -= pairs[:, w]
                right[:, b] += pairs[:, w]
                left[:, a] -= pairs[w]
                left[:, b] += pairs[w]
        if not moved:
            return label


def _grown(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(x + n) log(x + n) - x log x, precise also where n is small beside x."""
    x = x.astype(np.float64)
    return n * np.log(np.maximum(x + n, 1)) + x * np.log1p(n / np.maximum(x, 1))


def small_steps(joint: np.ndarray) -> list[np.ndarray]:
    """What -``TABLED`` to ``TABLED`` more bigrams add to each cell, for either side, and to each class's sum."""
    more = np.arange(1, TABLED + 1)[:, None, None]

    def steps(x):
        fewer = np.maximum(x[None] - more, 0)      # cells never lose more than they hold
        return np.concatenate([-_grown(fewer, more)[::-1], np.zeros((1, *x.shape)), _grown(x[None], more)])

    return [steps(joint.T), steps(joint), steps(joint.sum(axis=1)[None])[:, 0]]


def gains(sums: np.ndarray, own: np.ndarray, label: np.ndarray, joint: np.ndarray,
          steps: list[np.ndarray] | None = None) -> np.ndarray:
    """Words x classes: what the likelihood gains if a word, taken out of its class ``label``, joins a class.

    ``sums`` (words x 2 x classes) counts the classes after and before each word without ``own``, its bigrams with
    itself; ``joint`` counts the class bigrams, the words in their present classes; ``steps`` saves time.
    """
    words, total = len(sums), len(joint)
    use = sums[:, 0].sum(axis=1) + own
    at = np.arange(words)
    gain = np.zeros((words, total))

    def small(n):
        return n <= TABLED if steps else np.zeros(len(n), bool)

    def filled(out, few, tabled, direct):
        """``out`` by ``tabled`` of the places of small counts and by ``direct`` of the others."""
        for k, f in ((np.flatnonzero(few), tabled), (np.flatnonzero(~few), direct)):
            if len(k):
                out[k] = f(k)
        return out

    for side, table in ((0, joint.T), (1, joint)):     # table[c]: bigrams of c with each class on the word's side
        mine, other = sums[:, side], sums[:, 1 - side]
        i, c = np.nonzero(mine)
        if not len(i):
            continue
        x, a = mine[i, c], label[i]
        few, step = small(x), steps[side] if steps else None
        if few.all():
            g = step[x + TABLED, c]
        else:
            g = filled(np.empty((len(i), total)), few, lambda k: step[x[k] + TABLED, c[k]], lambda k: _grown(table[c[k]], x[k, None]))
        g[np.arange(len(i)), a] = filled(np.empty(len(i)), few, lambda k: -step[TABLED - x[k], c[k], a[k]],
                                         lambda k: _grown(table[c[k], a[k]] - x[k], x[k]))
        m = np.flatnonzero(c == a)                     # bigrams with the class the word has left
        y, z, d = x[m], other[i[m]], c[m]
        g[m] = filled(np.empty((len(m), total)), small(y) & small(z.max(axis=1)) if len(m) else np.zeros(0, bool),
                      lambda k: step[y[k, None] - z[k] + TABLED, d[k, None], np.arange(total)]
                      - step[TABLED - z[k], d[k, None], np.arange(total)],
                      lambda k: _grown(table[d[k]] - z[k], y[k, None]))
        g[np.arange(len(i)), c] = 0.0                  # of a class with itself: below
        head = starts(i)
        gain[i[head]] += np.add.reduceat(g, head, axis=0)
    both = sums[:, 0] + sums[:, 1] + own[:, None]
    i, c = np.nonzero(both)
    x = both[i, c]
    gain[i, c] += filled(np.empty(len(i)), small(x) & (c != label[i]), lambda k: steps[0][x[k] + TABLED, c[k], c[k]],
                         lambda k: _grown(joint[c[k], c[k]] - x[k] * (c[k] == label[i[k]]), x[k]))
    weight = joint.sum(axis=1)
    grown = filled(np.empty((words, total)), small(use), lambda k: steps[2][use[k] + TABLED],
                   lambda k: _grown(weight[None], use[k, None]))
    grown[at, label] = _grown(weight[label] - use, use)
    return gain - 2 * grown


def choose(sums: np.ndarray, own: np.ndarray, label: np.ndarray, joint: np.ndarray,
           classes: int, steps: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Class each word wants and what it gains by it; words of no class (the last one) must choose one."""
    gain = gains(sums, own, label, joint, steps)
    want = gain[:, :classes].argmax(axis=1)
    more = gain[np.arange(len(want)), want] - gain[np.arange(len(want)), label]
    move = (more > TOLERANCE) | (label > classes)
    return np.where(move, want, label), np.where(move & (want != label), more, 0.0)


class Pack:
    """Bigrams of some words: ``nbr`` stands after (``side`` 0) or before ``word``. Packs below 0 share their words."""

    def __init__(self, p: int, blob: bytes | pa.Buffer):
        self.p = p
        n, words, large = np.frombuffer(blob, np.int64, 3).tolist()
        at = 24
        parts = []
        for kind, size in ((np.int32, words), (np.int32, words), (np.int32, n), (np.uint8, n), (np.int32, large), (np.int64, large)):
            parts.append(np.frombuffer(blob, kind, size, at))
            at += size * np.dtype(kind).itemsize
        word, times, end, count, place, value = parts
        self.word = np.repeat(word, times)
        self.side = (end < 0).astype(np.int8)
        self.nbr = np.where(end < 0, ~end, end)
        self.n = count.astype(np.int64)
        self.n[place] = value

    @staticmethod
    def bytes_of(word: np.ndarray, nbr: np.ndarray, side: np.ndarray, n: np.ndarray) -> bytes:
        """Entries sorted by word, in about six bytes each: the words once, the side as the neighbour's sign, and
        counts of 255 and more by themselves."""
        head = starts(word)
        large = np.flatnonzero(n >= 255)
        return b"".join([np.array([len(word), len(head), len(large)], np.int64).tobytes(), word[head].astype(np.int32).tobytes(),
                         np.diff(np.r_[head, len(word)]).astype(np.int32).tobytes(), np.where(side, ~nbr, nbr).astype(np.int32).tobytes(),
                         np.minimum(n, 255).astype(np.uint8).tobytes(), large.astype(np.int32).tobytes(), n[large].astype(np.int64).tobytes()])

    def bigrams(self, label: np.ndarray, total: int) -> np.ndarray:
        right = self.side == 0
        return np.bincount(label[self.word[right]].astype(np.int64) * total + label[self.nbr[right]], self.n[right],
                           total * total).astype(np.int64)

    def shared(self, label: np.ndarray, total: int, hubs: int) -> np.ndarray:
        other = self.word != self.nbr
        return np.bincount((self.word[other].astype(np.int64) * 2 + self.side[other]) * total + label[self.nbr[other]],
                           self.n[other], hubs * 2 * total).astype(np.int64)

    def drift(self, label: np.ndarray, want: np.ndarray, first: int, moves: np.ndarray, total: int) -> np.ndarray:
        """What the class bigrams change by if the words flagged in ``moves`` move and their neighbours stay."""
        at = np.flatnonzero(moves[self.word - first])
        word, side, n = self.word[at], self.side[at], self.n[at]
        c = label[self.nbr[at]].astype(np.int64)
        both, cells = word == self.nbr[at], total * total
        out = np.zeros(cells, np.int64)
        for k, sign in ((label[word].astype(np.int64), -1), (want[word - first].astype(np.int64), 1)):
            out += sign * np.bincount(np.where(both, k * (total + 1), np.where(side, c * total + k, k * total + c)),
                                      n * ~(both & (side > 0)), cells).astype(np.int64)
        return out

    def wanted(self, label: np.ndarray, joint: np.ndarray, classes: int, first: int, last: int, most: int, steps: list):
        """Wanted class of the words from ``first`` to before ``last``, and those that gain most by it as (gain, word, own, sums).

        Words of equal class and equal sums, as most rare ones are, gain the same: one of each kind is rated.
        """
        total = len(joint)
        near = np.where(self.word == self.nbr, 2 * total, self.side * total + label[self.nbr])
        mark = KIND[near] * self.n.astype(np.uint64)
        head = starts(self.word)
        kind = KIND[-1 - label[first:last].astype(np.int64)]
        if len(head):
            kind[self.word[head] - first] += np.add.reduceat(mark, head)
        _, rated, same = np.unique(kind, return_index=True, return_inverse=True)
        order = np.argsort(rated)
        rated, same = rated[order], np.argsort(order)[same]
        want, gain = label[first + rated], np.zeros(len(rated))
        number, n = self.word - first, self.n
        if len(rated) < len(kind):
            place = np.full(len(kind), -1)
            place[rated] = np.arange(len(rated))
            number = place[number]                # of the entry's word, -1 if another word stands for it
            at = np.flatnonzero(number >= 0)
            number, near, n = number[at], near[at], n[at]
        own, sums = np.zeros(len(rated), np.int64), []
        for low in range(0, len(rated), BLOCK):
            high = min(low + BLOCK, len(rated))
            a, b = np.searchsorted(number, (low, high))
            table = np.bincount((number[a:b] - low) * (2 * total + 1) + near[a:b], n[a:b],
                                (high - low) * (2 * total + 1)).astype(np.int64).reshape(-1, 2 * total + 1)
            # a bigram of a word with itself has an entry on either side
            own[low:high] = table[:, -1] // 2
            sums.append(table[:, :-1].reshape(-1, 2, total))
            want[low:high], gain[low:high] = choose(sums[-1], own[low:high], label[first + rated[low:high]].astype(np.int64),
                                                    joint, classes, steps)
        k = np.flatnonzero(gain[same])
        k = k[np.lexsort((k, -gain[same[k]]))[:most]]
        r = same[k]
        picked = np.array([sums[x // BLOCK][x % BLOCK] for x in r.tolist()], np.int64).reshape(-1, 2, total)
        return want[same], (gain[r], first + k, own[r], picked)


class Packs:
    """The bigrams of all words in packs, and the two passes of a round over them."""

    def __init__(self, spark, table: DataFrame, first: np.ndarray, hubs: int, own: np.ndarray, local: bool):
        self.spark, self.table, self.first, self.hubs, self.own = spark, table, first, hubs, own
        self.local = [Pack(r["p"], bytes(r["blob"])) for r in table.orderBy("p").collect()] if local else None

    def measure(self, label: np.ndarray, classes: int) -> np.ndarray:
        """Class bigrams alone."""
        return self._passed(label, None, classes, 0.0, 0)[2]

    def wanted(self, label: np.ndarray, guess: np.ndarray, classes: int, share: float, turn: int):
        """One pass: class every word wants if ``guess`` are the class bigrams, of the words that gain most by it (gain, word,
        own, sums), the class bigrams themselves, and what they change by if the words of ``sampled`` that want to move do."""
        return self._passed(label, guess, classes, share, turn)

    def _passed(self, label: np.ndarray, guess: np.ndarray | None, classes: int, share: float, turn: int):
        first, hubs, total, most = self.first, self.hubs, classes + 2, max(1, TURNS // (len(self.first) - 1 or 1))
        steps, cells = None if guess is None else small_steps(guess), total * total

        def rate(packs, label, guess, first, steps):
            """Per pack (p, want, gain, word, own, sums); at the end what all of them add up to."""
            out = np.zeros(2 * cells + hubs * 2 * total, np.int64)
            for pack in packs:
                out[:cells] += pack.bigrams(label, total)
                if pack.p < 0:
                    out[2 * cells:] += pack.shared(label, total, hubs)
                if pack.p < 0 or guess is None:
                    continue
                low, high = int(first[pack.p]), int(first[pack.p + 1])
                want, rows = pack.wanted(label, guess, classes, low, high, most, steps)
                moves = (want != label[low:high]) & sampled(np.arange(low, high), share, turn)
                moves[rows[1] - low] = False
                out[cells:2 * cells] += pack.drift(label, want, low, moves, total)
                yield pack.p, want, *rows
            yield -1, out

        out, found, sums = label.copy(), [], np.zeros(2 * cells + hubs * 2 * total, np.int64)
        if self.local is not None:
            for p, want, *rows in rate(self.local, label, guess, first, steps):
                if rows:
                    out[first[p]:first[p + 1]] = want
                    found.append(rows)
                else:
                    sums += want
        else:
            shared = self.spark.sparkContext.broadcast((label, guess, first, steps))
            names = ["gain", "word", "own", "sums"]

            def apply(batches):
                for p, want, *rows in rate(_packs(batches), *shared.value):
                    at = np.flatnonzero(want) if not rows else None
                    blobs = [want, *rows] if rows else [want[at], np.zeros(0), at, *[np.zeros(0, np.int64)] * 2]
                    yield pa.RecordBatch.from_arrays([pa.array([p]), *(pa.array([x.tobytes()]) for x in blobs)], ["p", "want", *names])

            rows = self.table.mapInArrow(apply, "p bigint, want binary, " + ", ".join(f"{c} binary" for c in names))
            for r in rows.collect():   # one byte for each word, the sums of about TURNS words, and of each task the class bigrams
                gain, word, own, around = (np.frombuffer(bytes(r[c]), np.float64 if c == "gain" else np.int64) for c in names)
                if r["p"] < 0:
                    sums[word] += np.frombuffer(bytes(r["want"]), np.int64)
                else:
                    out[first[r["p"]]:first[r["p"] + 1]] = np.frombuffer(bytes(r["want"]), np.int8)
                    found.append((gain, word, own, around.reshape(-1, 2, total)))
            shared.destroy()
        joint, drift = sums[:2 * cells].reshape(2, total, total)
        around, own = sums[2 * cells:].reshape(hubs, 2, total)[1:], self.own[1:]
        out[1:hubs], gain = choose(around, own, label[1:hubs].astype(np.int64), joint, classes)
        k = np.flatnonzero(gain)
        found.append((gain[k], k + 1, own[k], around[k]))
        return out, _most(found, TURNS), joint, drift


def sampled(word: np.ndarray, share: float, turn: int) -> np.ndarray:
    """About ``share`` of the words, others in each turn."""
    mix = (word + turn * 7919).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mix >> np.uint64(11)).astype(np.float64) < share * 2.0 ** 53


def _most(rows: list[tuple], most: int) -> tuple:
    """Of rows of (gain, word, own, sums) the ``most`` of highest gain, in that order."""
    gain, word, own, sums = (np.concatenate(x) for x in zip(*rows, strict=True)) if rows else [np.zeros(0)] * 4
    at = np.lexsort((word, -gain))[:most]
    return gain[at], word[at], own[at], sums[at]


def in_turn(rows: tuple, label: np.ndarray, joint: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Labels and class bigrams after the words of ``rows`` moved one by one, each by the class bigrams that those before it left."""
    label, joint = label.copy(), joint.copy()
    for _, word, own, sums in zip(*rows, strict=True):
        a = label[word]
        want, gain = choose(sums[None], own[None], np.array([a], np.int64), joint, classes)
        if gain[0] > 0:
            for k, sign in ((a, -1), (want[0], 1)):
                joint[k] += sign * sums[0]
                joint[:, k] += sign * sums[1]
                joint[k, k] += sign * own
            label[word] = want[0]
    return label, joint


def _packs(batches):
    for batch in batches:
        for p, blob in zip(batch.column("p").to_pylist(), batch.column("blob"), strict=True):
            yield Pack(p, blob.as_buffer())


def packed(table: DataFrame, ids: DataFrame, first: np.ndarray, hubs: int, shares: int) -> DataFrame:
    """(p, blob): both ends of the training texts' bigrams by pack; hubs' ones lie in ``shares`` packs below 0."""
    shared = table.sparkSession.sparkContext.broadcast(first)

    def cut(word, nbr, side, n):
        p = np.searchsorted(shared.value, word, "right") - 1
        few = np.searchsorted(word, hubs)          # words are sorted
        mix = ((nbr[:few] * 2 + side).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64)
        p[:few] = -1 - (mix + word[:few]) % shares
        order = np.r_[np.argsort(p[:few], kind="stable"), np.arange(few, len(p))]
        p, word, nbr, n = (x[order] for x in (p, word, nbr, n))
        head = starts(p)
        sides = np.full(len(p), side, np.int8)
        blobs = [Pack.bytes_of(word[i:j], nbr[i:j], sides[i:j], n[i:j]) for i, j in zip(head, [*head[1:], len(p)], strict=False)]
        return pa.Table.from_arrays([pa.array(p[head].astype(np.int32)), pa.array(blobs, pa.binary())], ["p", "blob"])

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        at, number, _, size, learn, _ = numbered(left, right)
        _, before, now = chained(size[learn], number[at[np.repeat(learn, size)]], 0)
        out = []
        pair, n = np.unique(before << 32 | now, return_counts=True)
        out.append(cut(pair >> 32, pair & 0xFFFFFFFF, 0, n))
        pair = pair >> 32 | (pair & 0xFFFFFFFF) << 32
        order = np.argsort(pair)
        pair, n = pair[order], n[order]
        out.append(cut(pair >> 32, pair & 0xFFFFFFFF, 1, n))
        return pa.concat_tables(out)

    def pack(batches):
        for group in whole_groups(batches, ["p"]):
            p, blobs = column(group, "p"), group.column("blob").to_pylist()
            head = starts(p)
            for low, high in zip(head, [*head[1:], len(p)], strict=True):
                found = [Pack(0, b) for b in blobs[low:high]]
                word, nbr, side, n = (np.concatenate([getattr(x, c) for x in found]) for c in ("word", "nbr", "side", "n"))
                key = word.astype(np.int64) << 32 | nbr.astype(np.int64) << 1 | side
                order = np.argsort(key)
                key = key[order]
                new = starts(key)
                key = key[new]
                yield pa.RecordBatch.from_arrays([pa.array(p[low:low + 1]), pa.array([Pack.bytes_of(
                    key >> 32, key >> 1 & 0x7FFFFFFF, (key & 1).astype(np.int8), np.add.reduceat(n[order], new))], pa.binary())], ["p", "blob"])

    sent = chunked(table, ["chunk", "n", "tokens", "size", "learn", "scored"], ids, send, "p int, blob binary")
    return sent.repartition("p").sortWithinPartitions("p").mapInArrow(pack, "p int, blob binary")


def chunked(table: DataFrame, names: list[str], ids: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` of each chunk and the numbers of its words; both lie in equal buckets, so nothing is shuffled."""
    return table.select(*names).groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(fn, schema)


def likelihood(joint: np.ndarray) -> float:
    def total(x):
        x = x.astype(np.longdouble)
        return (x * np.log(np.maximum(x, 1))).sum()
    return total(joint) - 2 * total(joint.sum(axis=1))


def exchange_all(packs: Packs, label: np.ndarray, classes: int, least_gain: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all words and the class bigrams after exchange rounds, until no word or too little is gained.

    A pass counts the class bigrams of a trial and rates all words by what they were expected to be, so a round takes one pass. An
    expectation that is far off costs gain, never the count: a trial stands only if the likelihood as counted has risen.
    """
    share, turn, last = SHARE, 0, None
    guess = packs.measure(label, classes)
    while True:
        turn += 1
        want, most, joint, drift = packs.wanted(label, guess, classes, share, turn)
        if (label > classes).any():      # all words without a class take one at once
            if not (want != label).any():
                return label, joint
            label, guess = want, packs.measure(want, classes)
            continue
        if last is not None:
            gain = likelihood(joint) - likelihood(last[1])
            if gain > 0:
                if gain < least_gain * joint.sum():
                    return label, joint
                share = min(SHARE, share * 1.25)
            else:
                label, joint, want, most, drift, rated, exact = last
                if n == 1 and not len(some):
                    if exact:
                        return label, joint      # no gain beyond rounding is left
                    guess, last = joint, None
                    continue
                n, drift, share = max(1, n // 4), drift // 2, share / 2
        if last is None or gain > 0:
            n, rated = len(most[0]), turn
            exact = (guess == joint).all()
            last = label, joint, want, most, drift, rated, exact
            movers = np.flatnonzero(want != label)
            if not len(movers):
                if exact:
                    return label, joint
                guess, last = joint, None
                continue
            rest = movers[~np.isin(movers, most[1])]
        some = rest[sampled(rest, share, rated)] if share * len(rest) >= 1 else rest[:0]
        label, guess = in_turn([x[:n] for x in most], label, joint, classes)
        label[some] = want[some]
        guess = np.maximum(guess + drift, 0)


def tables(joint: np.ndarray, tokens: np.ndarray, types: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log10 transition table between classes and log10 emission totals."""
    use = joint.sum(axis=1)
    prior = (use + 1) / (use.sum() + len(joint))
    return np.log10((joint + PRIOR * prior) / (use[:, None] + PRIOR)), np.log10(tokens + types + 1)


class ClassModel:
    """Classes and tables of a bigram table that fits into memory, by the sequential exchange."""

    def __init__(self, pairs: np.ndarray, head: int, classes: int, head_counts: np.ndarray, rule_types: np.ndarray):
        self.label = exchange(pairs.astype(np.float64), head, classes)
        one = np.zeros((len(pairs), int(self.label.max()) + 1))
        one[np.arange(len(pairs)), self.label] = 1
        tokens = np.r_[head_counts, pairs.sum(axis=0)[head:]]
        types = np.r_[np.ones(head), rule_types, 1]
        self.transition, self.emission = tables(one.T @ pairs @ one, one.T @ tokens, one.T @ types)


class Clusters:
    """What ``cluster`` learns: classes and class bigrams, and the chunks of the texts with the numbers of their words."""


def cluster(training: DataFrame, head: int, classes: int, dictionary: int, least_gain: float = 0.0) -> Clusters:
    """Exchange clustering of all words of ``training``. The end is word 0, dictionary words follow by frequency."""
    return learn(training.select(kept_of([]), "text", F.lit(True).alias("learn"), F.lit(False).alias("scored")),
                 head, classes, dictionary, least_gain)


def learn(rows: DataFrame, head: int, classes: int, dictionary: int, least_gain: float) -> Clusters:
    """``cluster`` of the rows (kept, text, learn, scored) flagged ``learn``; texts of all rows are numbered."""
    spark, out = rows.sparkSession, Clusters()
    out.chunks, buckets = chunks(rows)
    parts = materialize(word_parts(out.chunks), "word-counts")

    def count(p, c):
        c = np.frombuffer(c, np.int64)
        bins = np.bincount(steps_of(c[c > 0]), minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), *(pa.array([x]) for x in (
            int(c.sum()), int((c > 0).sum()), bins.tobytes()))], ["p", "tokens", "types", "bins"])

    found = rows_of(parts, ["p", "c"], count, "p int, tokens bigint, types bigint, bins binary").collect()
    out.ends = out.chunks.agg(F.coalesce(F.sum("ends"), F.lit(0)).alias("n")).first()["n"]
    out.tokens = sum(r["tokens"] for r in found) + out.ends
    out.types = sum(r["types"] for r in found) + (out.ends > 0)
    # the lowest count that no more than ``dictionary`` words reach
    reach = np.cumsum(sum((np.frombuffer(r["bins"], np.int64) for r in found), np.zeros(BINS, np.int64))[::-1])[::-1]
    low = int(np.argmax(np.r_[reach, 0] <= dictionary))

    def frequent(p, words, c):
        at = np.flatnonzero(steps_of(np.frombuffer(c, np.int64)) >= low)
        words = words.split(b" ")
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), p, np.int32)), pa.array(at), pa.array([words[k] for k in at.tolist()], pa.binary()),
             pa.array(np.frombuffer(c, np.int64)[at])], ["p", "at", "word", "c"])

    frame = rows_of(parts, ["p", "words", "c"], frequent, "p int, at bigint, word binary, c bigint").toPandas()
    frame = frame.assign(word=frame["word"].map(bytes)).sort_values(["c", "word"], ascending=[False, True])
    counts = frame["c"].to_numpy(np.int64)
    known = len(counts)
    hubs = 1 + int((counts > max(out.tokens // HUBS, PACK // 4)).sum())

    # numbers: known words by frequency, the others part by part
    part, place, number = frame["p"].to_numpy(np.int64), frame["at"].to_numpy(np.int64), np.arange(1, known + 1)
    order = np.lexsort((place, part))
    part, place, number = part[order], place[order], number[order]
    rare = np.zeros(max([r["p"] for r in found], default=0) + 1, np.int64)
    for r in found:
        rare[r["p"]] = r["types"]
    rare -= np.bincount(part, minlength=len(rare))
    shared = spark.sparkContext.broadcast((known + 1 + np.cumsum(rare) - rare, part, place, number))

    def identify(p, c, chunk, size, at):
        offset, part, place, number = shared.value
        c, chunk, size, at = (np.frombuffer(x, kind) for x, kind in ((c, np.int64), (chunk, np.int64), (size, np.int64), (at, np.int32)))
        ids = np.full(len(c), -1, np.int32)
        few = slice(*np.searchsorted(part, [p, p + 1]))
        others = c > 0
        others[place[few]] = False
        ids[others] = offset[p] + np.arange(others.sum())
        ids[place[few]] = number[few]
        cut = np.cumsum(size)[:-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunk), pa.array(np.full(len(chunk), p, np.int32)),
             *(pa.array([y.tobytes() for y in np.split(x[at], cut)], pa.binary()) for x in (ids, c))], ["chunk", "p", "id", "c"])

    out.ids = bucketed(rows_of(parts, ["p", "c", "chunk", "size", "at"], identify, "chunk bigint, p int, id binary, c binary")
                       .repartition(buckets, "chunk"), buckets)

    # packs by their share of the bigrams
    load = np.cumsum(2 * counts[hubs - 1:]) // PACK
    head_of = hubs + starts(load) if len(load) else np.zeros(0, np.int64)
    rare_packs = max(1, -(-2 * (out.tokens - out.ends - int(counts.sum())) // PACK))
    words = known + 1 + int(rare.sum())
    first = np.r_[head_of, np.unique(known + 1 + np.arange(rare_packs) * int(rare.sum()) // rare_packs), words].astype(np.int64)
    hub_tokens = out.ends + int(counts[:hubs - 1].sum())
    path = scratch_path(spark, "packs")
    table = packed(out.chunks, out.ids, first, hubs, max(1, -(-2 * hub_tokens // PACK)))
    table.write.option("maxRecordsPerFile", FILE).parquet(path)   # a task reads few files, so few packs, at a time
    table = spark.read.schema(table.schema).parquet(path)

    # start: the head words by themselves, the end in a class of its own, all others in none
    head = min(head, known)
    own, pairs, size = started(table, head, hubs)
    packs = Packs(spark, table, first, hubs, own, size <= LOCAL)
    classes = min(classes, max(head, 1))
    label = np.full(words, classes + 1, np.int8)
    label[0] = classes
    label[1:head + 1] = exchange(pairs, head, classes)[:head]
    out.label, joint = exchange_all(packs, label, classes, least_gain)
    types = np.bincount(out.label, minlength=classes + 2)
    out.transition, out.emission = (x[..., :classes + 1] for x in tables(
        joint[:classes + 1, :classes + 1], joint.sum(axis=0)[:classes + 1], types[:classes + 1]))
    # an unseen word has its base probability, the word after it that of its class
    after = np.log10((joint.sum(axis=1) + 1) / (out.tokens + classes + 1))[:classes + 1]
    out.transition = np.block([[out.transition, np.zeros((classes + 1, 1))], [after[None], np.zeros((1, 1))]])
    out.emission = np.append(out.emission, np.log10(out.tokens + out.types + 1))
    return out


def started(table: DataFrame, head: int, hubs: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bigrams of each hub with itself, bigrams of the head (then all others as one, then the end), and the number of entries."""
    width = head + 2

    def count(batches):
        near, own, size = np.zeros(width * width, np.int64), np.zeros(hubs, np.int64), 0
        for pack in _packs(batches):
            size += len(pack.n)
            right = pack.side == 0
            u, v, n = pack.word[right], pack.nbr[right], pack.n[right]
            if pack.p < 0:
                np.add.at(own, u[u == v], n[u == v])
            u, v = (np.where(x > head, head, np.where(x == 0, head + 1, x - 1)).astype(np.int64) for x in (u, v))
            np.add.at(near, u * width + v, n)
        for what, x in ((NEAR, near), (OWN, own), (SIZE, np.array([size]))):
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), what, np.int32)), pa.array(at), pa.array(x[at])], ["what", "at", "n"])

    found = table.mapInArrow(count, "what int, at bigint, n bigint").groupBy("what", "at").agg(F.sum("n").alias("n")).toPandas()
    out = []
    for what, size in ((NEAR, width * width), (OWN, hubs), (SIZE, 1)):
        x, rows = np.zeros(size, np.int64), found[found["what"] == what]
        x[rows["at"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
        out.append(x)
    return out[1], out[0].reshape(width, width).astype(np.float64), int(out[2][0])


def score(docs: DataFrame, training: DataFrame | Column, head: int = HEAD, classes: int = CLASSES,
          lookup: int = LOOKUP, least_gain: float = 0.0) -> DataFrame:
    """``docs`` (any columns, text) with n_tokens, n_known, train_tokens, base_score, score and perplexity.

    ``training`` is a table of texts, or a condition on the rows of ``docs``, which are then read once. ``head`` words start the
    clustering, which goes on while rounds gain ``least_gain`` a token. ``lookup`` has no effect any more: the counts of
    words come with the texts.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c != "text" and c not in ADDED]
    flag = F.coalesce(training, F.lit(False)) if isinstance(training, Column) else F.lit(False)
    rows = docs.select(kept_of(keep), "text", flag.alias("learn"), F.lit(True).alias("scored"))
    if not isinstance(training, Column):
        rows = rows.unionByName(training.select(F.lit(None).cast(rows.schema["kept"].dataType).alias("kept"), "text",
                                                F.lit(True).alias("learn"), F.lit(False).alias("scored")))
    learned = learn(rows, head, classes, LOOKUP, least_gain)
    end, base = learned.transition.shape[0] - 2, float(np.log10(learned.tokens + learned.types + 1))   # the last class stands for unseen words
    model = spark.sparkContext.broadcast((learned.label, learned.transition, learned.emission, learned.ends))   # one byte for each word

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        label, transition, emission, ends = model.value
        at, number, c, size, _, scored = numbered(left, right)
        kept = left.column("kept").combine_chunks().flatten().filter(pa.array(scored))
        at, size = at[np.repeat(scored, size)], size[scored]
        kind = np.where(number < 0, end + 1, label[number]).astype(np.int64)
        logs, rows = np.log10(c + 1.0), len(size)
        row, a, b = chained(size, kind[at], end)
        word_row = np.repeat(np.arange(rows), size)
        total = np.bincount(word_row, logs[at], rows) + np.log10(ends + 1.0)
        steps = (np.bincount(row, transition[a, b], rows) + np.bincount(word_row, (logs - emission[kind])[at], rows)
                 + np.log10(ends + 1.0) - emission[end])
        held = np.bincount(word_row, c[at] > 0, rows).astype(np.int64) + (ends > 0)
        return pa.Table.from_arrays([kept, pa.array(size + 1), pa.array(held), pa.array(total - (size + 1) * base), pa.array(steps)],
                                    ["kept", "n_tokens", "n_known", "base_score", "score"])

    done = chunked(learned.chunks, ["chunk", "kept", "n", "tokens", "size", "learn", "scored"], learned.ids, rate,
                   f"kept {rows.schema['kept'].dataType.simpleString()}, n_tokens bigint, n_known bigint, base_score double, score double")
    return (done.select(*unpacked(keep), "n_tokens", "n_known", F.lit(learned.tokens).cast("bigint").alias("train_tokens"),
                        "base_score", "score")
            .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))))
