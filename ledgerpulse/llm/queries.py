"""The registered queries of the text operators, and their SQL where SQL can express them."""

from pyspark.sql import functions as F

from ledgerpulse.llm import (class_lm, decontaminate, importance, license_scan, line_dedup, order_minhash, periodic,
                             quality, recompress, sentence_pieces, simhash, token_counts, url_filter)
from ledgerpulse.llm.common import fold, table

QUERIES, ORACLES = {}, {}
#: allow or block rules as (host, path, verdict)
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def documents(spark, sf_dir, *more):
    return table(spark, sf_dir, "documents").select("doc_id", "text", *more)


@query
def op1_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(documents(spark, sf_dir))


@query
def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


@query
def op3_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1)
    weights = quality.train(docs, labels)
    return (quality.score(docs, weights)
            .select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


@query
def op4_simhash(spark, sf_dir):
    return simhash.classes(documents(spark, sf_dir)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op6_class_lm(spark, sf_dir):
    docs = documents(spark, sf_dir)
    scored = class_lm.score(docs, fold("doc_id", 7) != 2, least_gain=class_lm.LEAST_GAIN)
    return scored.withColumn("held_out", fold("doc_id", 7) == 2)


@query
def op7_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("h")


@query
def op8_license_scan(spark, sf_dir):
    return license_scan.scan(documents(spark, sf_dir))


@query
def op9_order_minhash(spark, sf_dir):
    return order_minhash.with_next(documents(spark, sf_dir))


@query
def op5_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, url_filter.rule_table(spark, RULES)).drop("url")


ORACLES["op5_url_filters"] = r"""
WITH part AS (
  SELECT page_id, row_number() OVER () AS rid,
         CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
cut AS (
  SELECT page_id, rid, regexp_extract(rest, '^[^/?#]*', 0) AS raw,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1), '^[^?#]*', 0) AS path
  FROM part),
url AS (
  SELECT page_id, rid, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM cut),
rules(r_host, r_path, r_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (
  SELECT rid, r_host || r_path AS rule, r_verdict,
         row_number() OVER (PARTITION BY rid ORDER BY length(r_host || r_path) DESC, length(r_host) DESC) AS k
  FROM url JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM url LEFT JOIN (SELECT * FROM fit WHERE k = 1) f USING (rid)
"""


@query
def op10_sentence_pieces(spark, sf_dir):
    path = tokenizer_path("piece_bpe_32k.model")
    encoded = sentence_pieces.encode(documents(spark, sf_dir), path)
    back = sentence_pieces.decode(encoded, path)
    return back.select("doc_id", "n_tokens", "ids", F.sha2("text", 256).alias("decoded_sha256"))


@query
def op11_recompression(spark, sf_dir):
    return recompress.removed_windows(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op11_recompression"] = r"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
place AS (SELECT rid, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM doc),
win AS (SELECT rid, doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM place),
least AS (SELECT k, min(doc_id) AS first_id FROM win GROUP BY k),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 13)) AS p FROM win JOIN least USING (k) WHERE first_id < doc_id),
word AS (SELECT rid, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM doc),
kept AS (SELECT rid, string_agg(t, ' ' ORDER BY p) AS text FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid),
lost AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (rid) LEFT JOIN lost USING (rid)
"""


@query
def op12_periodic_runs(spark, sf_dir):
    found = periodic.periodic_runs(periodic.with_planted_runs(documents(spark, sf_dir)))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    length, start, period = (F.col("longest")[c] for c in ("col1", "col2", "col3"))
    names = "struct<col1:bigint,col2:bigint,col3:bigint>"
    return found.withColumn("longest", longest.cast(names)).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-start).alias("start"), length.alias("length"),
        (-period).alias("period"), F.expr("-1000 * longest.col1 DIV longest.col3").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_importance(spark, sf_dir):
    drawn = importance.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def _license_sql() -> str:
    values = ", ".join(f"({k}, '{label}', string_split('{t}', ' '), {license_scan.block_words(t, license_scan.THRESHOLD)})"
                       for k, (label, t) in enumerate(license_scan.TEMPLATES))
    hits, tags = [], []
    for p, label in license_scan.PHRASES:
        parts = p.split(" ")
        same = " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(parts))
        hit = f"list_filter(range(0, len(words) - {len(parts) - 1}), lambda i: {same})"
        hits.append(hit)
        tags.append(f"CASE WHEN len({hit}) > 0 THEN ['{label}'] ELSE [] END")
    return rf"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
base AS (
  SELECT doc_id, rid, len(words) AS n_words, list_concat({', '.join(hits)}) AS places,
         list_concat({', '.join(tags)}) AS tags FROM doc),
template AS (
  SELECT k, label, unnest(list_distinct(t)) AS w, len(list_distinct(t)) AS size, block
  FROM (VALUES {values}) v(k, label, t, block)),
word AS (SELECT rid, unnest(words) AS w, unnest(range(0, len(words))) AS p FROM doc),
held AS (
  SELECT rid, k, label, size, count(DISTINCT w) OVER (
    PARTITION BY rid, k ORDER BY p RANGE BETWEEN CURRENT ROW AND (block - 1) FOLLOWING) AS n
  FROM word JOIN template USING (w)),
met AS (SELECT rid, label, n / size AS share FROM held WHERE n >= ceil(size * {license_scan.THRESHOLD})),
more AS (SELECT rid, list(DISTINCT label) AS labels, max(share) AS share FROM met GROUP BY rid)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base,
       list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
       array_to_string(list_sort(list_distinct(tags)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(tags, coalesce(labels, [])))), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(round(share, 6), 0.0)::DOUBLE END AS score
FROM base LEFT JOIN more USING (rid)
"""


ORACLES["op8_license_scan"] = _license_sql()
