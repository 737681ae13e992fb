"""A document pipeline of five stages; each reads what the one before it wrote.

``run`` applies the stages to ``documents``. SQL cannot express them, so ``ORACLE_SQL`` is None and the
tests compare each stage with a brute-force version.

All stages take texts whole and handle an empty table, giving an empty one. Columns of any name are kept as they
are. A null text counts as an empty one, a missing id as a value of its own. In turn: quality scores every row by itself,
an empty text too. Line dedup keeps null texts null and empty ones empty; rows equal in id and text have one result each.
Near-dedup keeps, of ties in id, the text of the smaller hash and one of equal rows; empty and null texts are one group.
Decontamination judges equal rows alike; empty texts hold no item. Encoding gives empty texts no ids, row by row.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.llm import decontaminate, line_dedup, quality, sentence_pieces, simhash
from ledgerpulse.llm.common import packed, table, unpacked
from ledgerpulse.llm.queries import tokenizer_path
from ledgerpulse.storage import materialize

ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts."""
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select(packed(docs.columns), "text"), weights)
    return scored.where(F.col("score") >= 0.5).select(*unpacked(docs.columns))


def no_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; one that consisted of copies alone goes."""
    cut = line_dedup.dedup_lines(docs.select(packed(docs.columns), "doc_id", "text"))
    emptied = (F.col("n_removed") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return cut.where(~F.coalesce(emptied, F.lit(False))).select(
        *[new[c].alias(c) if c in new else kept for c, kept in zip(docs.columns, unpacked(docs.columns), strict=True)])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the smallest id, of equal rows one.

    Texts are linked if their sets of five-word shingles have a Jaccard similarity of 0.8 or more.
    """
    classes = materialize(simhash.near_duplicates(docs.select("doc_id", "text")), "near-duplicates")
    stay = classes.groupBy("root").agg(F.min(F.struct("doc_id", "h")).alias("k")).select(
        F.col("k.doc_id").alias("s_id"), F.col("k.h").alias("s_h"))
    rows = docs.select(packed(docs.columns), "doc_id", F.xxhash64("text").alias("h"))
    kept = rows.join(stay, rows["doc_id"].eqNullSafe(stay["s_id"]) & (rows["h"] == stay["s_h"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "h"]).select(*unpacked(docs.columns))


def no_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    hits = decontaminate.contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hits = hits.select(F.col("doc_id").alias("s_id"), F.col("h").alias("s_h")).distinct()
    rows = docs.select(packed(docs.columns), "doc_id", F.xxhash64("text").alias("h"))
    return rows.join(hits, rows["doc_id"].eqNullSafe(hits["s_id"]) & (rows["h"] == hits["s_h"]), "left_anti").select(
        *unpacked(docs.columns))


def as_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document in place of its text."""
    return sentence_pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [("quality classifier", good_quality), ("line dedup", no_repeated_lines),
          ("SimHash near-dedup", one_of_each_group), ("benchmark decontamination", no_benchmark_text),
          ("SentencePiece encoding", as_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that pass all stages, in the form the last stage gives them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
