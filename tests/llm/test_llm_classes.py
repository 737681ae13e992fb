"""Exchange clustering of op6 over every word, not only over the frequent ones."""

import math

import numpy as np
import pyarrow as pa
from llm_fixtures import ODD, frame, invented
from pyspark.sql import functions as F

from ledgerpulse.llm import class_lm


def test_words_beyond_the_head_learn_their_class(spark):
    rng = np.random.default_rng(5)
    kinds = [[f"x{a}{b}" for a in "abcde" for b in "fghij"], [f"x{a}{b}" for a in "klmno" for b in "pqrst"]]
    pick = lambda k: kinds[k][rng.integers(25)]
    training = frame(spark, [(k, " ".join(pick(j % 2) for j in range(60))) for k in range(40)])
    good, bad = " ".join(kinds[j % 2][j] for j in range(24)), " ".join(kinds[j // 12][j] for j in range(24))
    docs = frame(spark, [(1, good), (2, bad)])
    got = {r["doc_id"]: r["score"] for r in class_lm.score(docs, training, head=2, classes=2).collect()}
    assert got[1] > got[2] + 5   # the same shapes of words; only the order of learned classes tells them apart
    learned = class_lm.cluster(training, 2, 2, 10)
    assert len(learned.label) == 51 and (learned.label[1:] < 2).all()


def test_rounds_in_spark_equal_those_on_the_driver(spark, monkeypatch):
    docs = frame(spark, invented(40) + ODD)
    monkeypatch.setattr(class_lm, "PACK", 400)
    monkeypatch.setattr(class_lm, "LOOKUP", 25)
    monkeypatch.setattr(class_lm, "BLOCK", 70)
    scores, stopped = [], []
    inner = class_lm.Packs.wanted

    def wanted(self, label, *more):
        out = inner(self, label, *more)
        stopped.append((out[0] == label).all())
        return out

    monkeypatch.setattr(class_lm.Packs, "wanted", wanted)
    for local in (class_lm.LOCAL, 0):
        monkeypatch.setattr(class_lm, "LOCAL", local)
        scores.append(sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["score"])
                             for r in class_lm.score(docs, docs, head=10, classes=4).collect()))
        assert stopped[-1]   # no word wants to move any more
    assert all(a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-9) for a, b in zip(*scores, strict=True))


def test_packs_come_back_as_written():
    """Words of one and of many entries, both sides, counts around the escape."""
    rng = np.random.default_rng(3)
    word = np.sort(rng.integers(5, 60, 400))
    nbr, side = rng.integers(0, 1 << 31, 400), rng.integers(0, 2, 400).astype(np.int8)
    n = rng.choice([1, 2, 254, 255, 256, 1 << 40], 400)
    for part in (slice(0, 400), slice(0, 1), slice(0, 0)):
        pack = class_lm.Pack(0, class_lm.Pack.bytes_of(word[part], nbr[part], side[part], n[part]))
        for got, want in zip((pack.word, pack.nbr, pack.side, pack.n), (word, nbr, side, n), strict=True):
            assert (got == want[part]).all() and len(got) == len(want[part])


def test_gains_equal_the_change_of_the_likelihood():
    rng = np.random.default_rng(3)
    for size, tabled in ((9, False), (100, True)):
        n = rng.integers(0, 4, (size, size)) * rng.integers(0, 40, (size, size))
        symmetric = n + n.T   # as in a closed chain, a word is as often first as second
        label = rng.integers(0, 4, size)
        table = lambda l: np.eye(4, dtype=np.int64)[l].T @ symmetric @ np.eye(4, dtype=np.int64)[l]
        own = np.diag(symmetric)
        rest = symmetric - np.diag(own)
        one = np.eye(4, dtype=np.int64)[label]
        gain = class_lm.gains(np.stack([rest @ one, rest.T @ one], axis=1), own, label, table(label),
                              class_lm.small_steps(table(label)) if tabled else None)
        for w in range(9):
            for b in range(4):
                moved = label.copy()
                moved[w] = b
                change = class_lm.likelihood(table(moved)) - class_lm.likelihood(table(label))
                assert math.isclose(gain[w, b] - gain[w, label[w]], change, rel_tol=1e-6, abs_tol=1e-4)


def test_equal_words_are_rated_once(monkeypatch):
    """A thousand words, each between the same two words: one rating tells what all of them want and gain."""
    words, total = 1000, 5
    word = np.repeat(np.arange(10, 10 + words), 2)
    nbr, side = np.tile([3, 4], words), np.tile(np.array([0, 1], np.int8), words)
    label = np.r_[np.zeros(3, np.int8), np.int8(1), np.int8(2), np.zeros(5 + words, np.int8)]
    joint = np.full((total, total), 5000)
    joint[1, 1] += 90_000
    rated, choose = [], class_lm.choose
    monkeypatch.setattr(class_lm, "choose", lambda sums, *more: rated.append(len(sums)) or choose(sums, *more))
    pack = class_lm.Pack(0, class_lm.Pack.bytes_of(word, nbr, side, np.ones(2 * words, np.int64)))
    want, (gain, found, own, sums) = pack.wanted(label, joint, 3, 10, 10 + words, 7, class_lm.small_steps(joint))
    assert sum(rated) == 1 and len(set(want)) == 1 and len(want) == words
    alone, more = choose(sums[:1], own[:1], np.zeros(1, np.int64), joint, 3)
    assert (want == alone[0]).all() and np.allclose(gain, more[0]) and len(gain) == (7 if more[0] else 0)
    assert (found == 10 + np.arange(len(found))).all()


def test_bigrams_as_blobs_add_up(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "TOKENS", 300)
    docs = frame(spark, invented(60) + ODD)
    texts = [class_lm.words_of(r["text"] or "") for r in docs.collect()]
    words = sorted({w for t in texts for w in t})[::2]
    number = {w: k + 1 for k, w in enumerate(words)} | {b"": 0}
    want = {}
    for t in texts:
        row = [number[w] if w in number else class_lm.key_of(w) for w in [b"", *t, b""]]
        for pair in zip(row, row[1:], strict=False):
            want[pair] = want.get(pair, 0) + 1
    lexicon = spark.sparkContext.broadcast(class_lm.Lexicon(words, np.ones(len(words), np.int64)))
    got = class_lm.bigrams(docs, lexicon, 7).collect()
    assert len(got) == len(want) and {(r["u"], r["v"]): r["n"] for r in got} == want


def test_texts_are_read_once_in_many_chunks(spark, monkeypatch):
    """A condition on the rows trains like a table of those rows; words and blanks of odd texts are split alike."""
    monkeypatch.setattr(class_lm, "TOKENS", 300)
    docs = frame(spark, invented(30) + ODD)
    condition = F.coalesce("doc_id", F.lit(0)) % 3 != 1
    a, b = (sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["base_score"], r["score"])
                   for r in class_lm.score(docs, training, head=10, classes=4).collect())
            for training in (condition, docs.where(condition)))
    assert len(a) == docs.count()
    assert all(x[:3] == y[:3] and np.allclose(x[3:], y[3:], rtol=1e-9) for x, y in zip(a, b, strict=True))
    odd = ["  A\x1cb \x0b\x0cC\r\n", "", " ", None, "É x\x85Y \x1fz\t", "one"]
    words, size = class_lm.split_words(pa.array(odd, pa.string()))
    want = [class_lm.words_of(t or "") for t in odd]
    assert words.cast(pa.binary()).to_pylist() == [w for t in want for w in t] and size.tolist() == [len(t) for t in want]
    for x in (np.array([0, 255, 256, 65534, 65535, 65536, 1 << 30]), np.zeros(0, np.int64)):
        assert (class_lm.symbols_unpacked(class_lm.symbols_packed(x)) == x).all()


def test_drift_is_the_change_of_the_class_bigrams():
    """Of one word that moves, with bigrams on either side and with itself; a round so needs no pass to count alone."""
    word, nbr = np.full(5, 7), np.array([3, 4, 7, 3, 7])
    pack = class_lm.Pack(0, class_lm.Pack.bytes_of(word, nbr, np.array([0, 0, 0, 1, 1], np.int8), np.array([5, 1, 2, 300, 2])))
    before = np.array([0, 0, 0, 1, 2, 0, 0, 0], np.int8)
    after = before.copy()
    after[7] = 2

    def counted(label):
        out = np.zeros((3, 3), np.int64)
        for u, v, n in ((7, 3, 5), (7, 4, 1), (7, 7, 2), (3, 7, 300)):
            out[label[u], label[v]] += n
        return out

    drift = pack.drift(before, after[7:8], 7, np.array([True]), 3)
    assert (drift.reshape(3, 3) == counted(after) - counted(before)).all()
    assert not pack.drift(before, after[7:8], 7, np.array([False]), 3).any()
