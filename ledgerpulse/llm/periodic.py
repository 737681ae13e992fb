"""Operator 12: periodic runs of words by a sparse diagonal dynamic program.

A run of period q is a stretch in which every word equals the one q words before; on the diagonal of lag q the match
length grows with each word. Words are read in order, and each takes up the lags of its earlier occurrences: a lag
that goes on makes its match longer, one that stops is emitted at once as a run if it was long enough.

What keeps the diagonals few is the length a run must have. A run of period q holds at least ``REPEATS`` times q
words, so its diagonal holds (REPEATS - 1) * q matches: a lag of 2^k up to 2^(k+1) - 1 counts only together with
the 3 * 2^k words that follow. For such a context the nearest earlier occurrence is the only lag that can be a
smallest period: two lags of one scale, or a nearer occurrence of a smaller one, would give the context, and with
it the whole stretch, a smaller period dividing the lag. So each scale has one active lag for each word, contexts
that occur once in their document leave, and a text of n words takes n log n steps even if it repeats one word.

Null and empty texts have no words and no runs. Texts are read whole, each in one task. Documents are handled one by
one, so repeated rows and tied ids get a result each; an empty table gives an empty table. Columns other than
doc_id and text are ignored, whatever their names.
"""

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerpulse.llm.common import slices, starts, texts

REPEATS, LEAST = 4, 6     # a run has at least LEAST words and REPEATS periods; contexts below need REPEATS of 4 or more


def _named(pos: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose key occurs again, and a number for each key."""
    _, code, n = np.unique(key, return_inverse=True, return_counts=True)
    again = n[code] > 1
    return pos[again], code[again]


def _joined(pos: np.ndarray, code: np.ndarray, step: int, stop: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of ``size`` words from those at each position and ``step`` words on, within a document."""
    at = np.minimum(np.searchsorted(pos, pos + step), max(len(pos) - 1, 0))
    ok = (pos[at] == pos + step) & (pos + size <= stop[pos]) if len(pos) else np.zeros(0, bool)
    width = int(code.max()) + 1 if len(code) else 1
    return _named(pos[ok], code[ok] * width + code[at[ok]])


def diagonals(pos: np.ndarray, code: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last position and lag of every diagonal of a lag in [low, high).

    ``code`` numbers the context at ``pos``; its lag is the distance of its nearest earlier occurrence.
    """
    order = np.argsort(code, kind="stable")
    lag = np.zeros(len(pos), np.int64)
    same = code[order[1:]] == code[order[:-1]]
    lag[order[1:][same]] = (pos[order[1:]] - pos[order[:-1]])[same]
    active = np.flatnonzero((lag >= low) & (lag < high))
    at, d = pos[active], lag[active]
    head = starts(at - np.arange(len(at)), d)           # a diagonal goes on while the next word keeps the lag
    tail = np.r_[head[1:], len(at)] - 1 if len(head) else head
    return at[head], at[tail], d[head]


def runs_of(word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs, by start and period.

    ``word`` numbers the words of all documents, which begin at ``first`` (the end included).
    """
    size = np.diff(first)
    doc, stop = np.repeat(np.arange(len(size)), size), np.repeat(first[1:], size)
    width = int(word.max()) + 1 if len(word) else 1
    pos, code = _named(np.arange(len(word)), doc * width + word)
    pos, code = _joined(pos, code, 1, stop, 2)
    pos, code = _joined(pos, code, 1, stop, 3)
    found, scale = [np.zeros((0, 3), np.int64)], 1
    while len(pos):
        context = 3 * scale
        begin, last, lag = diagonals(pos, code, scale, 2 * scale)
        length = last + context - begin + lag
        ok = length >= np.maximum(LEAST, REPEATS * lag)
        found.append(np.c_[begin - lag, length, lag][ok])
        pos, code = _joined(pos, code, context, stop, 2 * context)
        scale *= 2
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return rows[:, 0], rows[:, 1], rows[:, 2]


def _split(rows: list[str]) -> tuple[list[list[bytes]], np.ndarray]:
    words = [t.encode().split() for t in rows]     # on bytes, only ASCII blanks part words
    return words, np.cumsum([0, *map(len, words)])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): runs as (start, length, period) by start and period, and the text without
    what follows the first period of a run, words joined by one blank."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    item = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def detect(batches):
        for batch in slices(batches):
            words, first = _split(texts(batch))
            number = {w: k for k, w in enumerate(set(chain.from_iterable(words)))}
            word = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, first[-1])
            start, length, period = runs_of(word, first)
            edge = np.zeros(len(word) + 1, np.int64)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, start + length, -1)
            keep = np.cumsum(edge[:-1]) == 0
            cut = np.searchsorted(start, first)
            begin = start - np.repeat(first[:-1], np.diff(cut))
            runs = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.StructArray.from_arrays(
                [pa.array(x) for x in (begin, length, period)], fields=list(item)))
            kept = [" ".join([w.decode() for w, k in zip(ws, keep[a:b].tolist(), strict=True) if k])
                    if r else b" ".join(ws).decode()
                    for ws, a, b, r in zip(words, first[:-1], first[1:], np.diff(cut), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(first)), runs, pa.array(kept, pa.string())],
                                             ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(
        detect, f"doc_id {kind}, n_words bigint, runs array<struct<start bigint, length bigint, period bigint>>, "
                "collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by the CRC of their id, ends in repeats of some of its words.

    A missing id counts as the empty text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def plant(batches):
        for batch in slices(batches):
            out = texts(batch)
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
                if h % 10 == 0 and (words := out[k].encode().split()):
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    times = -(-(n - a) // p)
                    out[k] = b" ".join(words[:a] + (words[a:a + p] * times)[:n - a]).decode()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(plant, f"doc_id {kind}, text string")
