"""Window removal, periodic runs and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import ODD, SF_DIR, empty, frame, invented

from ledgerpulse.llm import importance, periodic, queries, recompress

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: names of the operators' own columns, given to columns of the input
CLASHES = ["block", "h", "runs", "rank", "weight", "score", "removed", "n_words", "bucket", "place"]


def with_clashes(df):
    return df.selectExpr("*", *(f"'clash' AS `{c}`" for c in CLASHES))


def passages(seed: int) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    letters = "abcdefgh"
    pool = [[rng.choice(letters) for _ in range(rng.randrange(5, 60))] for _ in range(30)]
    docs = [(None, "x " * 40), (1, None), (2, ""), (2, "x " * 30), (3, "x " * 50 + "y"), (3, "x " * 50 + "y"),
            (-5, "é ü " * 20), (4, "é ü\n" * 20)]
    for _ in range(150):
        words = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.random()
            if kind < 0.5:
                p = rng.choice(pool)
                at = rng.randrange(len(p))
                words += p[at:at + rng.randrange(40)]
            elif kind < 0.65:
                words += [rng.choice("ab")] * rng.randrange(25)
            else:
                words += [rng.choice("ijklmnop") + rng.choice(letters) for _ in range(rng.randrange(30))]
        docs.append((rng.randrange(120), " ".join(words)))
    return docs


def brute_windows(docs, window):
    low = -(1 << 63)
    first: dict[tuple, int] = {}
    rows = [(i, low if i is None else i, WORDS.findall(t or "")) for i, t in docs]
    for _, v, w in rows:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, v), v)
    for i, v, w in rows:
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k:k + window])] < v for j in range(window)}
        yield i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)


@pytest.mark.parametrize("block", [8 << 20, 2000])
def test_removed_windows(spark, block):
    docs = passages(3) + ODD + invented(40)
    got = recompress.removed_windows(with_clashes(frame(spark, docs)).repartition(3), block=block).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got) == Counter(brute_windows(docs, 13))
    for r in got:
        spans = [tuple(map(int, x.split("-"))) for x in r["removed"].split(",") if x]
        assert sum(b - a + 1 for a, b in spans) == r["n_removed"]
    assert sum(r["n_removed"] for r in got) > 1000
    assert recompress.removed_windows(empty(spark)).count() == 0


def test_equal_windows_survive_any_surroundings():
    """Two texts that share a core: the later one loses exactly the windows of the first, whatever stands around."""
    import pyarrow as pa
    rng = random.Random(7)
    for letters in ("abc", "abcdefgh") * 150:
        draw = lambda low, high: [rng.choice(letters) for _ in range(rng.randrange(low, high))]
        core = draw(13, 30)
        a, b = draw(0, 6) + core + draw(0, 6), draw(0, 6) + core + draw(0, 6)
        docs = pa.table({"doc_id": pa.array([0, 1]), "text": [" ".join(a), " ".join(b)]})
        gone = recompress.Block(docs, 13).removed()[len(a):]
        assert gone.sum() == [n for *_, n, _ in brute_windows([(0, " ".join(a)), (1, " ".join(b))], 13)][1]


def test_last_pass_names_no_symbols_again(monkeypatch):
    import pyarrow as pa
    for docs in (passages(3) + ODD, [(1, None), (2, "")], [(1, "a b " * 20), (2, "a b " * 20)]):
        docs = pa.table({"doc_id": pa.array([i for i, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs], pa.string())})
        block = recompress.Block(docs, 13)
        state, want = block.stated(*block.windows()), block.removed()
        with monkeypatch.context() as m:
            m.setattr(recompress.Block, "parse", lambda self: 1 / 0)
            again = recompress.Block(docs, 13, None, state)
            assert (again.windows()[0] == block.windows()[0]).all() and (again.removed() == want).all()


def test_questions_come_back_as_packed():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 63, 50).astype(np.uint64) for _ in range(2))
    for least in (np.arange(50), np.r_[-(1 << 63), np.arange(49)], np.full(50, -7)):
        several = rng.random(50) < 0.5
        x, y, ids, more = recompress.unpacked(recompress.packed(a, b, least, several))
        assert (x == a).all() and (y == b).all() and (ids == least).all() and (more == several).all()
        x, _, ids, more = recompress.unpacked(recompress.packed(a, None, least, several))
        assert (x == a % (1 << 48)).all() and (ids == least).all() and (more == several).all()


def brute_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            s, length = i - q, j - i + q
            if j > i and length >= max(6, 4 * q) and not any(
                    all(w[x] == w[x - p] for x in range(s + p, j)) for p in range(1, q)):
                out.append((s, length, q))
            i = max(i + 1, j)
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(seed: int, n: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    docs = []
    for k in range(n):
        w = [rng.choice("abcd"[:rng.randint(1, 4)]) for _ in range(rng.randrange(80))]
        if w and rng.random() < 0.6:
            a, p = rng.randrange(len(w)), rng.randint(1, 12)
            w = [w[i] if i < a else w[min(a + (i - a) % p, len(w) - 1)] for i in range(len(w))]
        docs.append((k, " ".join(w)))
    return docs


def test_periodic_runs(spark):
    docs = [d for d in ODD if len(d[1] or "") < 1000] + repetitive(2, 500) + invented(30) + [(700, "long " * 20_000)]
    got = periodic.periodic_runs(with_clashes(frame(spark, docs))).collect()
    want = Counter()
    for i, t in docs:
        w = WORDS.findall(t or "")
        runs = brute_runs(w) if len(w) < 1000 else [(0, len(w), 1)]
        drop = {x for s, length, q in runs for x in range(s + q, s + length)}
        want[(i, len(w), tuple(runs), " ".join(x for k, x in enumerate(w) if k not in drop))] += 1
    assert Counter((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in got) == want
    assert sum(len(r["runs"]) for r in got) > 200
    assert periodic.periodic_runs(empty(spark)).count() == 0


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]


def test_periodic_runs_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = {r["doc_id"]: r for r in queries.QUERIES["op12_periodic_runs"](spark, SF_DIR).collect()}
    assert len(rows) == len(docs)
    found = 0
    for doc_id in sorted(docs, key=lambda k: len(docs[k] or ""))[:150]:
        r, w = rows[doc_id], planted(doc_id, WORDS.findall(docs[doc_id] or ""))
        runs = brute_runs(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        drop = {x for s, length, q in runs for x in range(s + q, s + length)}
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{length},{q}\n" for s, length, q in runs))
        assert r["collapsed_sha256"] == sha(" ".join(x for k, x in enumerate(w) if k not in drop))
        found += len(runs)
    assert found > 3


def features(text):
    w = PLAIN_WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute_resample(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000)))) for b in s}
    rows = []
    for i, text in docs:
        n, f = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain.__getitem__, f))
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2], r[3]))
    return rows, order[:5 * len(order) // 100]


@pytest.mark.parametrize("misses", [0.25, 0.0, 2.0])
def test_resample(spark, monkeypatch, misses):
    """Also with a dictionary made anew for every block, and with none at all."""
    monkeypatch.setattr(importance, "MISSES", misses)
    docs = ODD + invented(150) + [(600, "ÀÉ kelvinK ÅB " * 30), (601, "x" * 70 + " " + "y" * 5000 + " z " * 30)]
    target = [t for _, t in invented(5, 9)] + [None, ""]
    got = importance.resample(with_clashes(frame(spark, docs)).repartition(5),
                              spark.createDataFrame([(t,) for t in target], "text string")).collect()
    rows, drawn = brute_resample(docs, target)
    columns = ("doc_id", "n_words", "n_features", "weight", "score")
    assert Counter(tuple(r[c] for c in columns) for r in got) == Counter(rows)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1)) and len(drawn) > 3
    assert [tuple(r[c] for c in columns) for r in ranked] == drawn


def test_resample_of_empty_tables(spark):
    some, none = frame(spark, [(1, "a few words " * 30)]), empty(spark)
    assert importance.resample(none, some).count() == 0
    assert importance.resample(some, none).first()["weight"] is not None


def test_moved_crc():
    rng = random.Random(1)
    for size in (0, 1, 5, 63, 64, 65, 1000, 70_000):
        a, b = rng.randbytes(rng.randrange(100)), rng.randbytes(size)
        own = importance.moved(np.array([zlib.crc32(a)], np.uint32), np.array([size]))[0] ^ zlib.crc32(b)
        assert own == zlib.crc32(a + b)
