"""License scan by diagonal voting.

A text's words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII. Every pair of neighbouring
words of every text is hashed and joined with the pairs of all templates, a fixed table; the join compares the words
too. A pair at word p that is pair q of a template votes for the diagonal p - q. Votes are counted per text, template
and diagonal as a mask of the template's pairs; diagonals at most GAP apart, which a few inserted or missing words
make of one copy, are merged to a span. A span is verified if it holds SHARE of its template's pairs and is at most
twice as long. A phrase counts only where all its pairs lie on one diagonal, so its words stand consecutively.

Votes are kept per distinct text (two 64-bit hashes), so copies of a text vote once, and a third of all rows with one
text meet in partial aggregates. Rows are independent: each input row gives one output row, ids that are equal or null
included. A null or empty text has no words, no labels and score 0; a very long one is read whole. Labels are sorted by
code points, so there are no ties. An empty table gives no rows. Extra columns are ignored. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words more or fewer between two diagonals of one span; share of a template's pairs that a span must hold.
GAP, SHARE = 3, 0.6

# Phrases that count by themselves, with their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Opening passages of public license texts and usual notices, with their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-notice",
    "under the terms of the gnu lesser general public license": "lgpl",
    "under the terms of the gnu affero general public license": "agpl",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-text",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}


def templates(phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> list[tuple]:
    """(template, label, phrase, pairs, q, a, b) of every pair of every template; a template has 2 to 64 words."""
    out = []
    for number, (text, label) in enumerate([*phrases.items(), *notices.items()]):
        words = text.split()
        if not 2 <= len(words) <= 64:
            raise ValueError(f"a template has 2 to 64 words: {text}")
        out += [(number, label, number < len(phrases), len(words) - 1, q, a, b) for q, (a, b) in enumerate(zip(words, words[1:]))]
    return out


TEMPLATE = "template int, label string, phrase boolean, pairs int, q int, a string, b string"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def text_key(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def votes(docs: DataFrame, table: list[tuple]) -> DataFrame:
    """(t1, t2, template, label, phrase, pairs, d, met): the pairs of a template met on diagonal d of a text, as bits."""
    known = docs.sparkSession.createDataFrame(table, TEMPLATE).withColumn("h", F.xxhash64("a", "b"))
    words = docs.select(*text_key(F.col("text")), words_of(F.col("text")).alias("words"))
    both = F.arrays_zip(F.col("words").alias("w"), F.slice("words", F.lit(2), F.size("words")).alias("x"))
    pairs = words.where(F.size("words") > 1).select("t1", "t2", F.posexplode(both).alias("p", "pair"))
    pairs = pairs.select("t1", "t2", "p", "pair.w", "pair.x").withColumn("g", F.xxhash64("w", "x"))
    # The templates are a fixed table of a few hundred pairs.
    hits = pairs.join(F.broadcast(known), F.expr("g = h AND w = a AND x = b"))
    return hits.groupBy("t1", "t2", "template", "label", "phrase", "pairs", (F.col("p") - F.col("q")).alias("d")).agg(
        F.bit_or(F.expr("shiftleft(1L, q)")).alias("met")
    )


def spans(diagonals: DataFrame, gap: int = GAP) -> DataFrame:
    """Merged diagonals: share of the template's pairs, the span's first and last word, and places where all pairs of a diagonal are there."""
    order = Window.partitionBy("t1", "t2", "template").orderBy("d")
    new = F.coalesce((F.col("d") - F.lag("d").over(order) > gap).cast("int"), F.lit(1))
    runs = diagonals.withColumn("new", new).withColumn("run", F.sum("new").over(order))
    whole = F.bit_count("met") == F.col("pairs")
    return runs.groupBy("t1", "t2", "template", "label", "phrase", "pairs", "run").agg(
        (F.bit_count(F.bit_or("met")) / F.first("pairs")).alias("share"), F.min("d").alias("first"), (F.max("d") + F.first("pairs")).alias("last"),
        F.count_if(whole).alias("places"), F.min(F.when(whole, F.col("d"))).alias("first_place"), F.max(F.when(whole, F.col("d"))).alias("last_place"),
    )


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, share: float = SHARE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    found = spans(votes(docs, templates(phrases, notices)))
    near = F.col("last") - F.col("first") <= 2 * F.col("pairs")
    phrase, place = F.col("phrase"), F.col("places") > 0
    verified = F.when(phrase, place).otherwise(near & (F.col("share") >= share))

    def joined(labels: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(labels)), ",")

    texts = found.groupBy("t1", "t2").agg(
        F.sum(F.when(phrase, F.col("places")).otherwise(0)).alias("n_base"), F.min(F.when(phrase, F.col("first_place"))).alias("first_word"), F.max(F.when(phrase, F.col("last_place"))).alias("last_word"),
        joined(F.when(phrase & place, F.col("label"))).alias("base_labels"), joined(F.when(verified, F.col("label"))).alias("labels"), F.max(F.when(near, F.col("share"))).alias("score"),
    )
    rows = docs.select("doc_id", *text_key(F.col("text")), F.regexp_count(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(WORD)).cast("long").alias("n_words"))
    out = rows.join(texts, ["t1", "t2"], "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _values() -> str:
    return ", ".join(f"({t}, '{label}', {phrase}, {n}, {q}, '{a}', '{b}')" for t, label, phrase, n, q, a, b in templates())


#: DuckDB SQL for scan over documents.
SQL = rf"""
WITH t(template, label, phrase, pairs, q, a, b) AS (VALUES {_values()}),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, len(words))) AS p FROM w),
g AS (SELECT doc_id, p - 1 AS p, words[p] AS a, words[p + 1] AS b FROM p),
d AS (SELECT doc_id, template, label, phrase, pairs, p - q AS d, bit_or(1::BIGINT << q) AS met FROM g JOIN t ON g.a = t.a AND g.b = t.b GROUP BY doc_id, template, label, phrase, pairs, p - q),
n AS (SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY doc_id, template ORDER BY d) <= {GAP} THEN 0 ELSE 1 END AS new FROM d),
r AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY d) AS run FROM n),
s AS (SELECT doc_id, template, label, phrase, pairs, run, bit_count(bit_or(met)) / pairs AS share, max(d) - min(d) <= pairs AS near,
  count(*) FILTER (bit_count(met) = pairs) AS places, min(d) FILTER (bit_count(met) = pairs) AS first_place, max(d) FILTER (bit_count(met) = pairs) AS last_place FROM r GROUP BY doc_id, template, label, phrase, pairs, run),
o AS (SELECT doc_id, CAST(sum(places) FILTER (phrase) AS BIGINT) AS n_base, min(first_place) FILTER (phrase) AS first_word, max(last_place) FILTER (phrase) AS last_word,
  array_to_string(list_sort(list(DISTINCT label) FILTER (phrase AND places > 0)), ',') AS base_labels,
  array_to_string(list_sort(list(DISTINCT label) FILTER (CASE WHEN phrase THEN places > 0 ELSE near AND share >= {SHARE} END)), ',') AS labels, max(share) FILTER (near) AS score FROM s GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM w LEFT JOIN o ON w.doc_id = o.doc_id
"""
