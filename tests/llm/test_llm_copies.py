"""Line dedup, SimHash classes, decontamination and order MinHash against brute force."""

import hashlib
from collections import Counter

import numpy as np
import xxhash
from llm_fixtures import ODD, empty, frame, invented
from pyspark.sql import functions as F

from ledgerpulse.llm import components, decontaminate, line_dedup, order_minhash, simhash

LEAST = 20


def brute_lines(spark, docs):
    """Text and number of removed lines by looking at every run of every document."""
    hashes = {r["text"]: r["h"] for r in frame(spark, docs).select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0, hashes[d[1]]))
    cut = {d: (d[1] or "").split("\n") for d in order}
    full = {d: [(n, p.strip()) for n, p in enumerate(cut[d]) if p.strip()] for d in order}
    first, out = {}, {}
    for d in order:
        rows = full[d]
        for i in range(len(rows)):
            for j in range(i + 1, min(len(rows), i + LEAST) + 1):
                first.setdefault(tuple(p for _, p in rows[i:j]), (d, i))
    for d in order:
        rows, gone = full[d], set()
        for i in range(len(rows)):
            for j in range(i + 1, min(len(rows), i + LEAST) + 1):
                run = tuple(p for _, p in rows[i:j])
                if sum(len(p.split()) for p in run) >= LEAST and first[run] != (d, i):
                    gone.update(range(rows[i][0], rows[j][0] if j < len(rows) else len(cut[d])))
        out[d] = (None if d[1] is None else "\n".join(p for n, p in enumerate(cut[d]) if n not in gone), len(gone))
    return out


def test_line_dedup(spark):
    docs = invented(70) + ODD + [(910, "the same line of words\n" * 30)]
    got = line_dedup.dedup_lines(frame(spark, docs, "n_lines"), LEAST).collect()
    want = brute_lines(spark, docs)
    assert Counter((r["doc_id"], r["text"], r["n_removed"]) for r in got) == Counter((d[0], *want[d]) for d in docs)
    assert sum(r["n_removed"] for r in got) > 50
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def brute_simhash(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    codes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))


def brute_classes(codes, radius):
    label = list(range(len(codes)))
    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= radius and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_simhash_classes(spark):
    docs = sorted([d for d in invented(80) + ODD if d[0] is not None], key=lambda d: d[0])
    got = {(r["doc_id"], r["h"]): r for r in simhash.classes(frame(spark, docs, "fp")).collect()}
    codes = [brute_simhash(t) for _, t in docs]
    label = brute_classes(codes, 4)
    hashes = [r["h"] for r in frame(spark, docs).select(F.xxhash64("text").alias("h")).collect()]
    for (doc_id, _), code, root, h in zip(docs, codes, label, hashes, strict=True):
        row = got[doc_id, h]
        assert row["fp"] % 2**64 == code and row["component_id"] == docs[root][0]
    assert simhash.classes(empty(spark)).count() == 0


def test_tiles_and_words_find_every_link(spark, monkeypatch):
    rng = np.random.default_rng(4)
    codes = set()
    for base in rng.integers(0, 2**63, 30):
        for _ in range(rng.integers(1, 30)):
            codes.add(int(base) ^ sum(1 << int(b) for b in set(rng.integers(0, 63, rng.integers(0, 5)).tolist())))
    codes = sorted(codes)
    monkeypatch.setattr(simhash, "TILE", 4)
    fps = spark.createDataFrame([(c,) for c in codes], "fp bigint")
    found = {r["node"]: r["root"] for r in components.components(simhash.links(fps)).collect()}
    label = brute_classes(codes, 4)
    same = {}
    for c, root in zip(codes, label, strict=True):
        same.setdefault(root, set()).add(found.get(c, c))
    assert all(len(roots) == 1 for roots in same.values())
    assert len({r for s in same.values() for r in s}) == len(same)


def jaccard(a: str, b: str) -> float:
    x, y = (set(simhash.shingle_hashes(t, 5)) for t in (a, b))
    return len(x & y) / len(x | y)


def test_near_duplicates_find_similar_sets_and_nothing_else(spark, monkeypatch):
    """Recall on each band of similarity from 0.8 on, and no link below; also with tiles of a few sets."""
    import random
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    docs, pairs = [], []
    for k in range(400):
        w = [word() for _ in range(rng.choice([60, 150, 400]))]
        v = list(w)
        for _ in range(max(1, round(len(w) * rng.choice([0.002, 0.006, 0.012, 0.018, 0.022, 0.03])))):
            v[rng.randrange(len(v))] = word()
        docs += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(v))]
        pairs.append((2 * k, 2 * k + 1, jaccard(docs[-2][1], docs[-1][1])))
    crowd = [word() for _ in range(200)]
    docs += [(2000 + k, " ".join(crowd[:k] + [word()] + crowd[k + 1:])) for k in range(60)] + [(3000, None), (3001, ""), (3002, "one two")]
    monkeypatch.setattr(simhash, "SETS", 8)
    root = {r["doc_id"]: r["root"] for r in simhash.near_duplicates(frame(spark, docs, "root")).collect()}
    assert len(root) == len(docs)
    for low, high in ((0.8, 0.85), (0.85, 0.9), (0.9, 0.95), (0.95, 1.0)):
        band = [root[a] == root[b] for a, b, j in pairs if low <= j < high]
        assert len(band) >= 15 and sum(band) >= 0.9 * len(band), (low, sum(band), len(band))
    assert not any(root[a] == root[b] for a, b, j in pairs if j < 0.8)
    assert len({root[2000 + k] for k in range(60)}) == 1 and root[3000] == root[3001] != root[3002]
    assert len(set(root.values())) == len(docs) - 59 - 1 - sum(root[a] == root[b] for a, b, _ in pairs)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "u long, v long")
    found = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert found == {**{k: 0 for k in range(1, 61)}, 101: 100}


def test_decontamination(spark):
    items = [(k, t) for k, (_, t) in enumerate(invented(12, seed=8)) if len(t.split()) >= 15]
    docs = invented(20, seed=9)
    for k, (_, t) in enumerate(items):
        words = t.split()
        half = len(words) // 2
        docs.append((2000 + k, "Some words before it. " + " ".join(words[half:] + words[:half]) + " and after."))
        docs.append((3000 + k, " ".join(words[:len(words) // 4])))
    items += [(98, "Not Found. Anywhere?"), (97, "some words"), (96, "before"), (95, "words before it some"), (94, "some words")]
    docs.append((4000, "before it, some words! Before some words before"))
    bench = spark.createDataFrame([*items, (99, None), (93, " ... ")], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in
           decontaminate.contaminated(frame(spark, docs + ODD, "h"), bench).collect()}

    def tiling(a, b, least=decontaminate.SEED):
        """Greedy string tiling by looking at all places."""
        used_a, used_b, total = set(), set(), 0
        while True:
            best = (0, 0, 0)
            for i in range(len(a)):
                for j in range(len(b)):
                    n = 0
                    while (i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]
                           and i + n not in used_a and j + n not in used_b):
                        n += 1
                    best = max(best, (n, -i, -j))
            n, i, j = best[0], -best[1], -best[2]
            if n < least:
                return total
            used_a.update(range(i, i + n))
            used_b.update(range(j, j + n))
            total += n

    words = lambda t: decontaminate.WORD.findall((t or "").lower())
    want = {}
    for doc_id, text in docs:
        for item, t in items:
            share = tiling(words(text), words(t), min(decontaminate.SEED, len(words(t)))) / len(words(t))
            if share >= decontaminate.COVERAGE:
                want[doc_id, item] = share
    assert got == want
    assert all((2000 + k, item) in got for k, (item, t) in enumerate(items) if len(words(t)) >= decontaminate.SEED)
    assert (4000, 96) in got and (4000, 97) in got and (4000, 95) not in got
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    assert decontaminate.contaminated(frame(spark, docs), bench.where("false")).count() == 0


def test_order_minhash_with_next(spark):
    docs = sorted([d for d in invented(30) + ODD if d[0] is not None], key=lambda d: (d[0], d[1] or ""))
    got = order_minhash.with_next(frame(spark, docs, "edge")).collect()
    want = []
    for k, (doc_id, text) in enumerate(docs):
        text, following = text or "", docs[(k + 1) % len(docs)][1] or ""
        cut = len(text) // 4
        change = text[:len(text) - cut] + following[:cut]
        mark, other, after = (order_minhash.signature(t) for t in (text, change, following))
        want.append((doc_id, len(text), hashlib.sha256(change.encode()).hexdigest(), order_minhash.as_text(mark),
                     order_minhash.as_text(other), float((mark == other).mean()), float((mark == after).mean())))
    assert sorted(tuple(r) for r in got) == sorted(want)
    near = [r["near_edited"] for r in got if r["n_chars"] > 100]
    assert np.mean(near) > 0.2 and len({len(r["fingerprint"]) for r in got}) == 1
    assert order_minhash.with_next(empty(spark)).count() == 0


def test_numbered_kmers():
    data = b"abcabcabcabcabc" * 5
    seen, want = Counter(), []
    for i in range(len(data) - order_minhash.K + 1):
        kmer = int.from_bytes(data[i:i + order_minhash.K], "little")
        want.append((kmer + seen[kmer] * order_minhash.GOLDEN) % 2**64)
        seen[kmer] += 1
    assert (order_minhash.numbered_kmers(data) == order_minhash.mixed(np.array(want, np.uint64))).all()
