"""Operator 5: URL filters by hashed host-suffix and path-prefix expressions.

Every distinct (host, path) is expanded into host suffixes times path prefixes. Expressions meet the
rules by an equi-join on the first ``PREFIX`` hex digits of their SHA-256; the full digest confirms,
and the longest rule wins (of equally long ones the longer host, then block before allow).

A rule fits its host and all subdomains if the path starts with the rule's path. Paths are expanded
at the distinct lengths of the rules' paths, so no rule is missed. A URL that is null or has no
``://`` has empty host and path. Without a fitting rule the verdict is ``default``. Repeated rows are
judged row by row; an empty table gives an empty table; other columns of ``pages`` are kept, whatever
their names, but those named as the added ones.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.llm.common import lower_ascii, packed, unpacked
from ledgerpulse.storage import materialize

PREFIX = 8
SMALL = 10_000   # rules up to this counted number are broadcast; more are joined by a shuffle
ADDED = ["host", "path", "rule", "verdict"]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return lower_ascii(host), path


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as (host, path, verdict)."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (``host`` + ``path`` of the winner, else null) and verdict."""
    kept = [c for c in pages.columns if c not in ADDED]
    rules = rules.select(
        F.coalesce("host", F.lit("")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"),
        F.col("verdict").alias("r_verdict")).distinct()
    shape = rules.agg(F.count("*").alias("n"), F.collect_set(F.length("r_path")).alias("lengths")).first()
    digest = F.sha2(F.concat("r_host", F.lit("\n"), "r_path"), 256)
    rules = rules.withColumn("r_digest", digest).withColumn("short", F.substring("r_digest", 1, PREFIX))

    host, path = url_parts(F.col(f"`{url}`"))
    parts = pages.select(packed(kept), host.alias("host"), path.alias("path"))
    labels = F.split("host", "[.]", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cuts = F.filter(F.array(*[F.lit(n) for n in sorted(shape["lengths"])]).cast("array<int>"),
                    lambda n: n <= F.length("path"))
    asked = (parts.select("host", "path").distinct()   # repeated URLs are expanded once
             .withColumn("suffix", F.explode(suffixes)).withColumn("cut", F.explode(cuts))
             .select("host", "path", F.sha2(F.concat("suffix", F.lit("\n"), F.expr("left(path, cut)")), 256)
                     .alias("digest"))
             .withColumn("short", F.substring("digest", 1, PREFIX)))
    rules = F.broadcast(rules) if shape["n"] <= SMALL else rules
    wins = F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"), F.col("r_verdict") == "block",
                    F.col("r_host"), F.col("r_path"))
    best = (asked.join(rules, "short").where(F.col("digest") == F.col("r_digest"))
            .groupBy("host", "path")
            .agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict")), wins).alias("b")))
    # written, so that the join deals its rows anew and can split a URL of very many pages
    best = materialize(best, "url-rules")
    return (parts.join(best, ["host", "path"], "left")
            .select(*unpacked(kept), "host", "path", F.col("b.rule").alias("rule"),
                    F.coalesce("b.r_verdict", F.lit(default)).alias("verdict")))
