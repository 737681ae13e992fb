"""Quality classifier, language model, URL filters and license scans."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import ODD, SF_DIR, empty, frame, invented
from pyspark.sql import functions as F

from ledgerpulse.llm import class_lm, license_scan, quality, queries, url_filter


def test_quality_on_held_out_documents(spark):
    sf = SF_DIR.replace("0.001", "0.01")
    scored = queries.op3_quality(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    right = scored.where("held_out").join(labels, "doc_id").select(F.avg((F.col("predicted") == F.col("quality")).cast("int")))
    assert right.first()[0] > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
               for r in scored.collect())


def test_quality_of_odd_rows(spark):
    docs = frame(spark, ODD, "score")
    labels = spark.createDataFrame([(904, 1), (904, None), (905, 0)], "doc_id bigint, quality int")
    scores = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(scores) == len(ODD) and all(0 <= r["score"] <= 1 for r in scores)
    none = quality.score(docs, quality.train(docs, labels.where("false"))).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.score(empty(spark), np.zeros(1 << quality.BITS)).count() == 0


def test_margin_equals_the_dot_product():
    weights = np.random.default_rng(0).normal(size=1 << quality.BITS)
    grams = quality.hashed("Ha ha! ### one TWO three 4 ha ha", {})
    index, value = quality.frequencies(grams)
    assert math.isclose(quality.margin(weights, grams), weights[index] @ value)


@pytest.mark.parametrize("lookup", [100_000, 40])
def test_language_model(spark, lookup):
    docs = invented(80) + ODD
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) + [""]
    df = frame(spark, docs, "n_known")
    training = df.where(queries.fold("doc_id", 7) != 2)
    got = Counter()
    for r in class_lm.score(df, training, head=30, classes=5, lookup=lookup).collect():
        got[r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)] += 1
        assert r["score"] < 0 and r["perplexity"] > 1
    count = Counter(w for i, t in docs if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2 for w in words(t))
    n, v = sum(count.values()), len(count)
    want = Counter((i, len(words(t)), sum(count[w] > 0 for w in words(t)), n,
                    round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for i, t in docs)
    assert got == want
    assert class_lm.score(empty(spark), training).count() == 0
    none = class_lm.score(df, training.where("false")).collect()
    assert len(none) == len(docs) and {r["base_score"] for r in none} == {0.0}


def test_lookup_size_does_not_change_scores(spark):
    df = frame(spark, invented(80))
    a, b = ({r["doc_id"]: r["score"] for r in class_lm.score(df, df, head=30, classes=5, lookup=k).collect()}
            for k in (100_000, 40))
    assert all(math.isclose(a[k], b[k], rel_tol=1e-9) for k in a)


def test_exchange_raises_the_likelihood_and_transitions_add_to_one():
    rng = np.random.default_rng(2)
    block = np.kron(np.array([[0, 30], [30, 0]]), np.ones((6, 6)))
    order = rng.permutation(12)
    pairs = np.zeros((14, 14))
    pairs[:12, :12] = block[np.ix_(order, order)] + rng.integers(0, 3, (12, 12))
    label = class_lm.exchange(pairs, 12, 2)
    side = order // 6
    assert len({(a, b) for a, b in zip(label[:12], side, strict=True)}) == 2
    model = class_lm.ClassModel(pairs.astype(np.int64), 12, 2, np.full(12, 5), np.ones(1))
    assert np.allclose((10 ** model.transition).sum(axis=1), 1)


def test_language_model_beats_the_base_on_held_out_documents(spark):
    rows = queries.op6_class_lm(spark, SF_DIR.replace("0.001", "0.01")).where("held_out")
    total = rows.agg(F.sum("score"), F.sum("base_score")).first()
    assert total[0] > total[1]


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "https://EN.Example.com/en/x?q=/fr/#a", "http://www.example.com/en/",
            "http://example.com", "http://example.com/en", "ftp://a.b.net/es/1", "http://net/fr/", "http://notexample.com/en/",
            "x://y://example.com/en/", "http://example.com:80/en/", "http://a.com?x=/en/", "http://a.com#/en/", "http://a.com/en/"]
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate([*urls, urls[-1]])], "page_id long, url string, host string")
    rules = url_filter.rule_table(spark, queries.RULES)

    def brute(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.lower()
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in queries.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[2:] if fits else (None, "allow")
        return host, path, rule, verdict

    for bound in (0, url_filter.SMALL):
        small, url_filter.SMALL = url_filter.SMALL, bound
        got = url_filter.filter_urls(pages, rules).orderBy("page_id").collect()
        url_filter.SMALL = small
        assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == [brute(u) for u in [*urls, urls[-1]]]
    assert url_filter.filter_urls(pages.where("false"), rules).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(pages, rules.where("false")).collect()} == {"allow"}


def test_license_scan(spark):
    notes = ["Released under the MIT License.", "released under MIT-License; CC BY 4.0, Apache License Apache License",
             "Licensed under the Apache License, Version 2.0", "licensed under cc by\nnc 4 0", "mit licenses. license mit",
             "This work is licensed under the GNU General Public License, version 3.\nélan mit license é",
             "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files the software to deal with the software",
             "# Permission is hereby granted,\n#  free of charge, to any person obtaining a copy\n# of this software and "
             "associated documentation files\n# (the \"Software\"), to deal in the Software without restriction",
             "/* Redistribution and use in source and binary forms,\n * with or without modification, are permitted\n"
             " * provided that the following conditions\n * are met: */",
             "Licensed under the Apache\nLicense, Version 2.0\n(the License);\nyou may not use this file\nexcept in "
             "compliance with the License.\nYou may obtain a copy\nof the License at",
             "This program is free software:\nyou can redistribute it and/or modify\nit under the terms of the GNU\n"
             "General Public License as\npublished by the Free Software Foundation",
             " x ".join("redistribution and use in source and binary forms with or without modification are permitted "
                        "provided that the following conditions are met".split()),   # too far apart
             "pad " * 4095 + "this work is licensed under a creative commons attribution 4 0 international license " + "pad " * 50]
    docs = list(enumerate(notes)) + ODD
    got = Counter(tuple(r) for r in license_scan.scan(frame(spark, docs, "labels")).collect())
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    want = Counter()
    for doc_id, text in docs:
        words, places, base, more, best = word.findall(low(text)), [], set(), set(), 0.0
        for phrase, label in license_scan.PHRASES:
            p = phrase.split()
            hits = [i for i in range(len(words)) if words[i:i + len(p)] == p]
            places += hits
            base |= {label} if hits else set()
        for label, t in license_scan.TEMPLATES:
            block, t = license_scan.block_words(t, license_scan.THRESHOLD), set(t.split())
            n = max((len(t.intersection(words[i:i + block])) for i in range(len(words)) if words[i] in t), default=0)
            if n >= license_scan.needed(len(t), license_scan.THRESHOLD):
                more.add(label)
                best = max(best, round(n / len(t), 6))
        want[doc_id, len(words), len(places), min(places, default=None), max(places, default=None),
             ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if places else best] += 1
    assert got == want
    labels = {r["doc_id"]: r["labels"] for r in license_scan.scan(frame(spark, docs)).collect()}
    assert [labels[k] for k in range(7, 13)] == ["mit", "bsd", "apache,apache-2.0", "gpl", "", "cc-by-4.0"]
    assert license_scan.scan(empty(spark)).count() == 0


def test_license_blocks_do_not_depend_on_pieces(spark):
    rng = random.Random(3)
    templates = [("a", "one two three four five"), ("b", "two two nine ten")]
    docs = [(k, "\n".join(rng.choice(["one", "two", "three", "four", "five", "nine", "ten", "x", "y"])
                          for _ in range(rng.randint(0, 120)))) for k in range(60)]
    found = [sorted(license_scan.block_matches(frame(spark, docs), templates, 0.8, piece).collect()) for piece in (2048, 16, 7)]
    assert found[0] == found[1] == found[2] and {r["label"] for r in found[0]} == {"a", "b"}
    for r in found[0]:
        t = templates[r["template"]][1]
        block = docs[r["doc_id"]][1].split()[r["start"]:r["start"] + license_scan.block_words(t, 0.8)]
        assert len(set(t.split()) & set(block)) / len(set(t.split())) == r["containment"]
