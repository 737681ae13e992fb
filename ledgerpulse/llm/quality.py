"""Operator 3: quality classifier. Hashed word n-grams, logistic regression, FTRL updates.

Training uses at most ``max_rows`` labelled documents, those with the smallest hash of their id, in
groups of about ``SHARD_ROWS``; each group runs follow-the-regularised-leader over its documents and the
weights are averaged. Scoring is a sparse dot product over every whole text.

A null text counts as empty and gets the score of the intercept alone. Labels that are null are
ignored, of several labels for one id the lowest counts. Without labels every score is 0.5. Repeated
rows are scored row by row; columns beyond id and text are kept out of the score.
"""

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import slices, texts

BITS = 18
SHARD_ROWS = 1024
MAX_ROWS = 8192
SCALE = 16.0      # of the frequencies that are a text's values
TOKEN = re.compile(r"\w+|[^\w\s]+")
CACHE = 400_000
MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(1_000_003)
LOWER, TITLE, CAPITAL, NUMBER, MARK, ECHO, NEAR_ECHO = range(7)


def code(token: str) -> int:
    """32 bits of hash, above them the kind of the token."""
    kind = (MARK if not (token[0].isalnum() or token[0] == "_") else NUMBER if token.isdigit() else
            LOWER if token.islower() else CAPITAL if token.isupper() and len(token) > 1 else TITLE)
    return kind << 32 | zlib.crc32(token.encode("utf-8", "surrogatepass"))


def hashed(text: str, known: dict[str, int]) -> list[np.ndarray]:
    """Slots of a text's n-grams: words, word pairs, kinds and pairs of kinds, repeats included.

    A kind is lower case, capitalised, upper case, number or the very punctuation mark; a token equal to the
    one before it, or to the one before that, has a kind of its own. Slot 0 is the intercept's.
    """
    tokens = TOKEN.findall(text)
    for t in tokens:
        if t not in known:
            known[t] = code(t)
    one = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    kind = np.where(one >> np.uint64(32) == MARK, one, (one >> np.uint64(32)) + np.uint64(1 << 40))
    kind[2:][one[2:] == one[:-2]] = (1 << 40) + NEAR_ECHO
    kind[1:][one[1:] == one[:-1]] = (1 << 40) + ECHO
    grams = [one, one[:-1] * STEP + one[1:] + np.uint64(1 << 33),
             kind + np.uint64(1 << 34), kind[:-1] * STEP + kind[1:] + np.uint64(1 << 35)]
    return [np.maximum((g * MIX >> np.uint64(64 - BITS)).astype(np.int64), 1) for g in grams]


def frequencies(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots and values: each n-gram group's frequencies times ``SCALE``, the intercept first."""
    slot = np.concatenate(grams)
    share = np.concatenate([np.full(len(g), SCALE / max(len(g), 1)) for g in grams])
    index, at = np.unique(slot, return_inverse=True)
    return np.r_[0, index], np.r_[1.0, np.bincount(at, share, len(index))]


def margin(weights: np.ndarray, grams: list[np.ndarray]) -> float:
    """The sparse dot product of the weights with a text's values."""
    return float(weights[0] + SCALE * sum(weights[g].mean() for g in grams if len(g)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 5,
         alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> np.ndarray:
    """Weights after ``epochs`` passes of FTRL-proximal over the rows in their order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weight(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(epochs):
        for (i, x), y in zip(rows, labels, strict=True):
            w = weight(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            grown = n[i] + g * g
            z[i] += g - (np.sqrt(grown) - np.sqrt(n[i])) / alpha * w
            n[i] = grown
    return weight(np.arange(1 << BITS))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS,
          doc_id: str = "doc_id", text: str = "text") -> np.ndarray:
    """Weights learned from at most ``max_rows`` rows of ``labels`` (doc_id, label 0 or 1)."""
    picked = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
              .groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).cast("double").alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    shards = max(1, -(-picked.count() // SHARD_ROWS))
    rows = (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
            .join(F.broadcast(picked), "_id")   # bounded by max_rows
            .withColumn("_shard", F.pmod(F.xxhash64("_id", F.lit("shard")), F.lit(shards))))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(_text=frame["_text"].fillna(""), _order=pd.util.hash_array(frame["_id"].to_numpy()))
        frame = frame.sort_values(["_order", "_id", "_text"])
        known: dict[str, int] = {}
        w = ftrl([frequencies(hashed(t, known)) for t in frame["_text"]], frame["_y"].to_numpy())
        at = np.append(np.flatnonzero(w), -1)   # slot -1 counts the shards
        return pd.DataFrame({"slot": at, "w": np.append(w[at[:-1]], 1.0)})

    learned = (rows.groupBy("_shard").applyInPandas(fit, "slot long, w double")
               .groupBy("slot").agg(F.sum("w").alias("w")).toPandas())   # at most 2^BITS rows
    weights = np.zeros((1 << BITS) + 1)
    weights[learned["slot"].to_numpy(np.int64)] = learned["w"].to_numpy()
    return weights[:-1] / max(weights[-1], 1)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the estimated probability of label 1, from the whole text."""
    model = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))   # 2^BITS numbers
    keep = [c for c in docs.columns if c != out]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), f"{out} double"])

    def apply(batches):
        w, known = model.value.astype(np.float64), {}
        for batch in slices(batches):
            if len(known) > CACHE:
                known = {}
            total = np.array([margin(w, hashed(t, known)) for t in texts(batch, text)])
            p = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(p)], [*keep, out])

    return docs.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(apply, schema)
