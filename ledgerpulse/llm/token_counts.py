"""Operator 2: token counts of whole texts by rank-synchronous merging of ragged arrays.

Distinct pre-tokens of a batch lie one after the other in a flat symbol array. In every round each
sequence finds its lowest-ranked adjacent pair, all sequences apply theirs at once, and sequences
without a pair left leave the array with the number of symbols they still hold.

Null and empty texts have no tokens. Texts of any length are counted whole. Repeated rows and tied
ids are counted row by row, an empty table gives an empty table, and other columns are ignored.
"""

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import slices, texts

CACHE = 400_000   # chunks a worker remembers before it starts anew; no effect on results
# Fixed value: the pre-token pattern of the vocabulary file.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in set(shown))
    names = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class Merges:
    """Vocabulary and merge ranks as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.final = np.array([ids[c + end] for c in letters], np.int64)
        self.width = len(ids) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] * self.width + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)   # by rank
        self.special = regex.compile("|".join(
            regex.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.pre = regex.compile(PRE_TOKEN)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols left of each non-empty byte sequence after all merges."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym, seq = self.inner[raw], np.repeat(np.arange(len(words)), size)
        last = np.cumsum(size) - 1
        sym[last] = self.final[raw[last]]
        never = len(self.made)
        while len(sym) > 1:
            left = np.flatnonzero(seq[1:] == seq[:-1])
            if not len(left):
                break
            pair = sym[left] * self.width + sym[left + 1]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            rank = np.where(self.keys[at] == pair, self.rank[at], never)
            own = seq[left]
            head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            lowest = np.full(len(words), never)
            lowest[own[head]] = np.minimum.reduceat(rank, head)
            hit = left[(rank < never) & (rank == lowest[own])]
            if not len(hit):
                break
            # in a run such as "aaaa" every second pair overlaps the one before it
            run = np.flatnonzero(np.r_[True, np.diff(hit) != 1])
            offset = np.arange(len(hit)) - np.repeat(run, np.diff(np.r_[run, len(hit)]))
            hit = hit[offset % 2 == 0]
            sym[hit] = self.made[lowest[seq[hit]]]
            size -= np.bincount(seq[hit], minlength=len(words))
            stay = lowest[seq] < never
            stay[hit + 1] = False
            sym, seq = sym[stay], seq[stay]
        return size

    def pre_tokens(self, part: str) -> list[bytes]:
        part = unicodedata.normalize("NFC", part)
        part = part.replace("Σ", "σ").lower()   # sigma has no word-final form here
        return [w.encode() for w in self.pre.findall(part)]


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


def chunk_counts(model: Merges, chunks: list[str]) -> list[int]:
    """Tokens of each space-free chunk, strings of special tokens counting one each."""
    words: dict[bytes, int] = {}
    owner, word, fixed = [], [], []
    for k, chunk in enumerate(chunks):
        found = model.special.findall(chunk) if "<" in chunk else []
        fixed.append(len(found))
        for part in model.special.split(chunk) if found else (chunk,):
            for w in model.pre_tokens(part):
                owner.append(k)
                word.append(words.setdefault(w, len(words)))
    if not words:
        return fixed
    per_word = model.counts(list(words))
    total = np.bincount(np.array(owner), per_word[np.array(word)], minlength=len(chunks))
    return (total.astype(np.int64) + np.array(fixed, np.int64)).tolist()


def count_texts(model: Merges, rows: list[str], known: dict[str, int]) -> list[int]:
    """Tokens of each text. No pre-token crosses a space, so distinct chunks are counted once."""
    cut = [t.replace("\n", " ").split(" ") for t in rows]
    fresh = list({c for chunks in cut for c in chunks if c not in known})
    known.update(zip(fresh, chunk_counts(model, fresh), strict=True))
    return [sum(map(known.__getitem__, chunks)) for chunks in cut]


def token_counts(docs: DataFrame, path: str, limit: int = 2048, text: str = "text") -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``over_limit`` to ``docs`` (columns other than ``text``)."""
    keep = [c for c in docs.columns if c != text and c not in ("n_bytes", "n_tokens", "over_limit")]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep),
                        "n_bytes bigint", "n_tokens bigint"])

    def count(batches):
        model, known = merges(path), {"": 0}
        for batch in slices(batches):
            rows = texts(batch, text)
            n = count_texts(model, rows, known)
            if len(known) > CACHE:
                known = {"": 0}
            size = [len(t.encode()) for t in rows]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(size, pa.int64()), pa.array(n, pa.int64())],
                [*keep, "n_bytes", "n_tokens"])

    return (docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text)).mapInArrow(count, schema)
            .withColumn("over_limit", F.col("n_tokens") > limit))
