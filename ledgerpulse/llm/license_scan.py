"""Operator 8: license scans by an exact set-similarity join, in DataFrame functions only.

The blocks of a template are all windows of the text that have as many words as the template has, divided
by ``THRESHOLD``; ends of lines and punctuation are blanks, so a wrapped notice is found like one on a line. A
block meets the template if it contains at least ``THRESHOLD`` of the template's distinct words.

Words are ordered by how often the corpus holds them, rarest first. With ``need`` of ``size`` words to share, the
rarest shared word is among the template's first ``size - need + 1`` (prefix), so only places of these words
are looked at. The blocks around such a place qualify only if they hold ``need`` words (length), counted
from the place's own word on in that order (position). What passes is counted exactly, block by block.

Beside it the places of fixed phrases are counted in the whole text. Null and empty texts have no words,
no labels and score 0. Long texts are read whole, in overlapping pieces of ``PIECE`` words; the overlap holds
every block, so pieces change no result. Repeated rows are scanned row by row with equal results, an empty
table gives an empty table, columns beyond doc_id and text are ignored.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import lower_ascii
from ledgerpulse.storage import materialize

THRESHOLD = 0.8
PIECE = 2048   # words of a text in one row
#: Phrase and its label.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"),
           ("mit license", "mit")]
#: Label and text of the notices looked for, as words.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of "
                   "the license at"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
]
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def needed(size: int, threshold: float) -> int:
    """The smallest overlap that reaches the threshold; exact for thresholds of up to six decimals."""
    return -(-size * round(threshold * 10**6) // 10**6)


def block_words(template: str, threshold: float) -> int:
    """Words of a block: the template's, divided by the threshold."""
    return -(-len(template.split(" ")) * 10**6 // round(threshold * 10**6))


def plain(text: Column) -> Column:
    """Lower-cased words parted by single blanks."""
    return F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), NO_WORD, " "))


def split_words(flat: Column) -> Column:
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def places(words: Column, padded: Column, phrase: str) -> Column:
    """Word numbers at which the phrase starts; only texts that hold it are searched."""
    parts = phrase.split(" ")
    last = F.size(words) - len(parts)
    hits = F.filter(F.sequence(F.lit(0), last),
                    lambda i: reduce(and_, [F.get(words, i + k) == p for k, p in enumerate(parts)]))
    return F.when(F.contains(padded, F.lit(f" {phrase} ")), hits).otherwise(F.array().cast("array<int>"))


def phrase_places(docs: DataFrame, phrases: list[tuple[str, str]]) -> DataFrame:
    """Words and phrase places of every row of ``docs`` (doc_id, text)."""
    base = (docs.select("doc_id", F.xxhash64("text").alias("h"), plain(F.col("text")).alias("flat"))
            .withColumn("words", split_words(F.col("flat")))
            .withColumn("padded", F.concat(F.lit(" "), "flat", F.lit(" "))))
    found = base.select("doc_id", "h", F.size("words").cast("bigint").alias("n_words"), *[
        places(F.col("words"), F.col("padded"), p).alias(f"p{k}") for k, (p, _) in enumerate(phrases)])
    every = F.concat(*[f"p{k}" for k in range(len(phrases))])
    labels = F.concat(*[F.when(F.size(f"p{k}") > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>"))
                        for k, (_, label) in enumerate(phrases)])
    return found.select("doc_id", "h", "n_words", F.size(every).cast("bigint").alias("n_base"),
                        F.array_min(every).cast("bigint").alias("first_word"),
                        F.array_max(every).cast("bigint").alias("last_word"), F.array_distinct(labels).alias("base"))


def text_pieces(docs: DataFrame, margin: int, piece: int = PIECE) -> DataFrame:
    """(doc_id, h, start, skip, flat): ``piece`` words of a text in a row, with ``margin`` words of the text on either side.

    ``start`` is the number of the first word, ``skip`` the length of the margin before.
    """
    words = split_words(plain(F.col("text")))
    # one element for each piece; a text without words has none
    cuts = F.filter(F.sequence(F.lit(0), F.size("words"), F.lit(piece)), lambda at: at < F.size("words"))
    rows = F.transform(cuts, lambda at: F.struct(
        F.greatest(at - margin, F.lit(0)).alias("start"), F.least(at, F.lit(margin)).alias("skip"),
        F.array_join(F.slice("words", F.greatest(at - margin, F.lit(0)) + 1, F.least(at, F.lit(margin)) + piece + margin),
                     " ").alias("flat")))
    return (docs.select("doc_id", F.xxhash64("text").alias("h"), words.alias("words"))
            .select("doc_id", "h", F.inline(rows)))


def block_matches(docs: DataFrame, templates: list[tuple[str, str]], threshold: float = THRESHOLD,
                  piece: int = PIECE) -> DataFrame:
    """(doc_id, h, template, label, start, containment): the best block, of equal ones the first, around each place
    of a rare template word, for all blocks that meet the template. ``start`` is the block's first word in the text."""
    spark = docs.sparkSession
    sets = [(k, label, sorted(set(t.split(" "))), block_words(t, threshold)) for k, (label, t) in enumerate(templates)]
    vocabulary = sorted({w for _, _, words, _ in sets for w in words})
    longest = max(size for *_, size in sets)
    pieces = materialize(text_pieces(docs, longest - 1, piece), "license-pieces")   # two passes read it
    places = pieces.select("doc_id", "h", "start", "skip", F.split("flat", " ").alias("words"))
    places = places.select("*", F.posexplode("words").alias("i", "w")).where(f"i >= skip AND i < skip + {piece}")
    counts = dict(places.where(F.col("w").isin(vocabulary)).groupBy("w").count().collect())   # the templates' words
    place = {w: (counts.get(w, 0), w) for w in vocabulary}

    # the words of a template from its i-th on, one row for each word of its prefix
    index = [(w, k, label, size, len(words), needed(len(words), threshold), ordered[i:], ordered)
             for k, label, words, size in sets for ordered in [sorted(words, key=place.get)]
             for i, w in enumerate(ordered[:len(words) - needed(len(words), threshold) + 1])]
    rare = sorted({row[0] for row in index})
    index = spark.createDataFrame(index, "w string, template int, label string, block int, t_size int, need int, "
                                         "t_rest array<string>, t_words array<string>")
    low = F.greatest(F.col("i") - (longest - 1), F.lit(0))
    near = (places.where(F.col("w").isin(rare))
            .select("doc_id", "h", "w", (F.col("start") + low).alias("start"), (F.col("i") - low).alias("at"),
                    F.slice("words", low + 1, F.col("i") - low + longest).alias("near"))
            .join(F.broadcast(index), "w"))   # as large as the given templates
    first = F.greatest(F.col("at") - F.col("block") + 1, F.lit(0))
    passed = (near.withColumn("first", first)
              .withColumn("own", F.slice("near", F.col("first") + 1, F.col("at") - F.col("first") + F.col("block")))
              .where(F.size(F.array_intersect("own", "t_rest")) >= F.col("need")))
    blocks = F.transform(F.sequence(F.lit(0), F.col("at") - F.col("first")), lambda s: F.struct(
        F.size(F.array_intersect(F.slice("own", s + 1, F.col("block")), "t_words")).alias("overlap"), (-s).alias("back")))
    return (passed.withColumn("best", F.array_max(blocks)).where("best.overlap >= need")
            .select("doc_id", "h", "template", "label", (F.expr("start + first - best.back")).cast("bigint").alias("start"),
                    F.expr("best.overlap / t_size").alias("containment")).distinct())


def scan(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs`` with its words, phrase places, labels and score.

    The score is 1 where a phrase occurs, else the greatest containment of a template that is met, else 0.
    """
    base = phrase_places(docs, phrases)
    met = (block_matches(docs, templates, threshold).groupBy("doc_id", "h")
           .agg(F.collect_set("label").alias("more"), F.max("containment").alias("containment"))
           .withColumnsRenamed({"doc_id": "m_doc", "h": "m_h"}))
    met = materialize(met, "license-met")   # a table of its own, so that the join can split an id of very many rows
    none = F.array().cast("array<string>")
    joined = base.join(met, base["doc_id"].eqNullSafe(met["m_doc"]) & (base["h"] == met["m_h"]), "left")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.round(F.coalesce("containment", F.lit(0.0)), 6)).alias("score"))
