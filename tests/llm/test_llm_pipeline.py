"""The pipeline's stages, one after the other and on odd rows."""

import os

import corpus_pipeline
from llm_fixtures import ODD, SF_DIR, frame, invented
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerpulse.llm import decontaminate, line_dedup, sentence_pieces, url_filter
from ledgerpulse.llm.queries import tokenizer_path
from ledgerpulse.llm.simhash import shingle_hashes
from ledgerpulse.storage import shared_root

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def full(spark, rows):
    return frame(spark, rows).select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"),
                                     F.length("text").cast("bigint").alias("n_chars"))


def written(spark, df, k):
    path = f"{shared_root(spark)}/stage-test-{os.getpid()}-{k}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_stages_on_odd_rows(spark):
    docs = full(spark, invented(25) + ODD)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(spark, stage(spark, docs, SF_DIR), k)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == COLUMNS
    assert docs.count() > 0


def test_stages_on_an_empty_table(spark):
    docs = full(spark, [])
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(spark, stage(spark, docs, SF_DIR), f"none-{k}")
    assert docs.count() == 0


def test_near_duplicates_leave_one_document_of_each_group(spark):
    docs = full(spark, invented(40) + [d for d in ODD if d[0] != 907])
    kept = corpus_pipeline.one_of_each_group(spark, docs, SF_DIR)
    rows = sorted({(r["doc_id"] is not None, r["doc_id"] or 0, r["text"]) for r in docs.collect()},
                  key=lambda r: (r[0], r[1], r[2] or ""))
    sets = [frozenset(shingle_hashes(t or "", 5)) for *_, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if label[i] != label[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    groups = {x: [k for k in range(len(rows)) if label[k] == x] for x in set(label)}
    got = {(r["doc_id"], r["text"]) for r in kept.collect()}
    ids = {x: min((r[0], r[1]) for r in (rows[k] for k in g)) for x, g in groups.items()}
    assert len(got) == kept.count() == len(groups) < len(rows)
    assert {(i is not None, i or 0) for i, _ in got} == set(ids.values())


def test_line_copies_and_benchmark_passages_go(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    hits = {r["doc_id"] for r in decontaminate.contaminated(docs.select("doc_id", "text"), bench).collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.no_benchmark_text(spark, docs, SF_DIR).collect()}
    assert hits and not hits & kept and len(hits | kept) == docs.count()
    cut = corpus_pipeline.no_repeated_lines(spark, docs, SF_DIR)
    assert cut.where("n_chars <> length(text)").count() == 0 and cut.columns == docs.columns
    assert cut.count() < docs.count()   # exact copies have no line left


def test_columns_of_any_name_are_kept(spark):
    """Names that the operators use themselves, among them struct fields, keys and results, come out as they went in."""
    names = ["b", "h", "c0", "kept", "root", "spans", "ids_", "key", "_own", "_score", "_h", "_doc", "_spans", "score", "s_id", "k", "no"]
    extra = [(F.lit(7) if k % 2 else F.concat(F.lit("v"), F.col("doc_id").cast("string"))).alias(c) for k, c in enumerate(names)]
    docs = full(spark, invented(25) + [(908, "long words " * 20_000)]).select("*", *extra)
    rows = docs

    def intact(df):
        same = [F.col(f"`{c}`").eqNullSafe(x) for c, x in zip(names, (F.lit(7) if k % 2 else F.concat(
            F.lit("v"), F.col("doc_id").cast("string")) for k in range(len(names))), strict=True)]
        return df.count() > 0 and all(df.where(~s).isEmpty() for s in same)

    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        rows = written(spark, stage(spark, rows, SF_DIR), f"names-{k}")
        assert intact(rows) and (k == len(corpus_pipeline.STAGES) - 1 or rows.columns == docs.columns)
    assert intact(line_dedup.dedup_lines(docs)) and line_dedup.dedup_lines(docs).columns == [*docs.columns, *line_dedup.ADDED]
    assert intact(sentence_pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"), chunk=1000))
    pages = docs.withColumn("url", F.lit("https://www.example.com/en/x"))
    judged = url_filter.filter_urls(pages, url_filter.rule_table(spark, [("com", "/", "allow")]))
    assert intact(judged) and judged.where("rule = 'com/'").count() == docs.count()


def test_registered(spark):
    assert "pipeline" in entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op")) == list(range(1, 14))
