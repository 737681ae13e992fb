"""Small tables for the text operators: odd rows and a few invented documents."""

import random

from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
ODD = [(900, None), (901, ""), (902, " "), (903, "\n\n"), (None, "a lone text without an id"),
       (904, "one"), (905, "x" * 5000), (906, "Twice the same row"), (906, "Twice the same row"),
       (907, "tied id"), (907, "another text of the tied id"), (908, "long " * 20_000)]


def invented(n: int, seed: int = 1) -> list[tuple[int, str]]:
    """Documents with shared lines, copies and near copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["the", "er", "on", "sh", "ti", "a", "nd"]) for _ in range(rng.randint(1, 4)))
    line = lambda: " ".join(word() for _ in range(rng.randint(1, 14))).capitalize() + "."
    pool = [line() for _ in range(25)]
    docs = []
    for k in range(n):
        lines = []
        for _ in range(rng.randint(1, 9)):
            start = rng.randrange(25)
            lines += [line()] if rng.random() < 0.6 else pool[start:start + rng.randint(1, 7)]
            lines += [""] * (rng.random() < 0.1)
        docs.append((k, "\n".join(lines)))
        if rng.random() < 0.2:
            docs.append((1000 + k, docs[-1][1] if rng.random() < 0.5 else docs[-1][1] + " " + word()))
    return docs


def frame(spark, rows, clash: str | None = None):
    """(doc_id, text), with one more column under a name the operator adds itself."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return df.withColumn(clash, F.lit("clash")) if clash else df


def empty(spark):
    return frame(spark, [])
