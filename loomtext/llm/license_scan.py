"""License scans by diagonal voting over rolling word 2-grams.

Every rolling pair of words of every document is joined to the places where the
templates have that pair (the join compares the words themselves, the hash only
finds them). A match votes for the diagonal: its word position in the document
less its position in the template. Votes are gathered per diagonal as a bit set
of template positions; diagonals of one template that lie within ``GAP`` of each
other (words inserted or left out) are merged, and a span is verified by the
share of the template's pairs found on it.

Phrases are templates that must be found whole on one diagonal: their words then
stand consecutively, from the diagonal's number on. Notices are longer templates
and count from ``COVERAGE`` on; pairs of common words only don't vote for them.

DataFrame operations only; the template table is a literal of some hundred rows.

Defined cases: null text counts as empty (no words); a text of one word has no
pair and no place; repeated rows give a row each; a null doc_id is kept; an
empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prepare, text_key, whole_text

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what words are parted by
GAP = 4
COVERAGE = 0.6

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Openings of public license notices (public texts), by label.
NOTICES = {
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                  "associated documentation files to deal in the software without restriction",
    "isc-notice": "permission to use copy modify and or distribute this software for any purpose with or without fee "
                  "is hereby granted",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted "
                  "provided that the following conditions are met",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-terms": "you may not use this file except in compliance with the license you may obtain a copy of the "
                    "license at",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-terms": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license as published by the free software foundation",
    "lgpl-notice": "under the terms of the gnu lesser general public license as published by the free software "
                   "foundation",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license",
    "mit-release": "released under the mit license",
    "cc-by": "licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc0-notice": "to the extent possible under law the author has dedicated all copyright and related rights to the "
                  "public domain",
}
COMMON = frozenset("a an and are as at by for if in is it may of on or that the this to under use with you without".split())


def template_rows() -> list[tuple[int, str, str, int, int, bool]]:
    """(template, label, pair, position, pairs that vote, phrase): one row per voting pair."""
    rows = []
    for t, (words, label, phrase) in enumerate(
            [(w.split(), x, True) for w, x in PHRASES.items()] + [(w.split(), x, False) for x, w in NOTICES.items()]):
        pairs = [(i, a, b) for i, (a, b) in enumerate(zip(words, words[1:])) if phrase or not {a, b} <= COMMON]
        if len(words) > 60 or any(re.search(r"[^a-z0-9]", w) for w in words):
            raise ValueError(f"template {label}: at most 60 words of a-z, 0-9")
        rows += [(t, label, f"{a} {b}", i, len(pairs), phrase) for i, a, b in pairs]
    return rows


def _templates(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({t}, '{label}', '{pair}', {i}, {n}, {str(phrase).lower()})"
                     for t, label, pair, i, n, phrase in [(-1, "", "", 0, 1, False), *template_rows()])
    return spark.sql(f"SELECT template, label, pair, tpos, pairs, phrase, xxhash64(pair) AS th FROM VALUES {rows} "
                     "AS t(template, label, pair, tpos, pairs, phrase)")


def _words(text):
    # lower() is A-Z's lower case for what templates can hold, once the Kelvin sign is out of the way
    low = F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u212b")))
    return F.array_remove(F.split(low, BETWEEN, -1), "")


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    n_spans (verified notices)."""
    spark = prepare(docs.sparkSession)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
            .select("doc_id", text_key(F.col("text")).alias("k"), F.char_length("text").alias("len"),
                    _words(F.col("text")).alias("w")))
    pairs = F.transform("w", lambda x, i: F.concat(x, F.lit(" "), F.coalesce(F.get("w", i + 1), F.lit(""))))
    # an empty pair in front keeps documents without any match
    grams = (rows.select("doc_id", "k", "len", F.size("w").cast("long").alias("n_words"),
                         F.concat(F.array(F.lit("")), pairs).alias("g"))
             .select("doc_id", "k", "len", "n_words", F.posexplode_outer("g").alias("pos", "gram"))
             .withColumn("gh", F.xxhash64("gram")))
    t = _templates(spark)
    hits = grams.join(F.broadcast(t), (F.col("gh") == F.col("th")) & (F.col("gram") == F.col("pair")))
    doc = ["doc_id", "k", "len", "n_words"]
    found = (hits.withColumn("diagonal", F.when(F.col("template") < 0, F.lit(0))
                             .otherwise(F.col("pos") - 1 - F.col("tpos")))
             .groupBy(*doc, "template", "label", "pairs", "phrase", "diagonal")
             .agg(F.bit_or(F.expr("shiftleft(1L, tpos)")).alias("seen"), F.count(F.lit(1)).alias("votes")))
    # neighbouring diagonals of one notice are one span
    order = Window.partitionBy("doc_id", "k", "len", "n_words", "template").orderBy("diagonal")
    spans = (found.withColumn("opens", F.coalesce(
                (F.col("diagonal") - F.lag("diagonal").over(order) > GAP) | F.col("phrase"), F.lit(True)).cast("int"))
             .withColumn("span", F.sum("opens").over(order))
             .groupBy(*doc, "template", "label", "pairs", "phrase", "span")
             .agg(F.min("diagonal").alias("start"), F.bit_or("seen").alias("seen"), F.sum("votes").alias("votes"))
             .withColumn("coverage", F.bit_count("seen") / F.col("pairs").cast("double")))
    base = F.col("phrase") & (F.col("coverage") == 1)
    notice = ~F.col("phrase") & (F.col("template") >= 0) & (F.col("coverage") >= COVERAGE)
    start = F.when(base, F.col("start").cast("long"))
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("label")))), ",")
    share = F.when(F.col("template") >= 0, F.when(F.col("phrase") & ~base, 0.0).otherwise(F.col("coverage")))
    return (spans.groupBy(*doc)
            .agg(F.count(F.when(base, 1)).alias("n_base"), F.min(start).alias("first_word"),
                 F.max(start).alias("last_word"), listed(base).alias("base_labels"), listed(base | notice).alias("labels"),
                 F.coalesce(F.max(share), F.lit(0.0)).alias("score"), F.count(F.when(notice, 1)).alias("n_spans"),
                 F.max(F.when(F.col("template") < 0, F.col("votes"))).alias("copies"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_spans"))


def oracle() -> str:
    """The same scan as DuckDB SQL over ``documents``."""
    values = ", ".join(f"({t}, '{label}', '{pair}', {i}, {n}, {phrase})"
                       for t, label, pair, i, n, phrase in template_rows())
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH t(template, label, pair, tpos, pairs, phrase) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
      FROM documents),
g AS (SELECT r, unnest(range(1, len(w))) AS i, w FROM d),
p AS (SELECT r, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS gram FROM g),
h AS (SELECT r, template, label, pairs, phrase, pos - tpos AS diagonal, bit_or(1::BIGINT << tpos) AS seen
      FROM p JOIN t ON gram = pair GROUP BY ALL),
o AS (SELECT *, CASE WHEN phrase OR lag(diagonal) OVER win IS NULL OR diagonal - lag(diagonal) OVER win > {GAP}
                THEN 1 ELSE 0 END AS opens FROM h WINDOW win AS (PARTITION BY r, template ORDER BY diagonal)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM o),
c AS (SELECT r, template, label, phrase, span, min(diagonal) AS start,
             bit_count(bit_or(seen)) / pairs::DOUBLE AS coverage FROM s GROUP BY r, template, label, pairs, phrase, span),
f AS (SELECT *, phrase AND coverage = 1 AS base, NOT phrase AND coverage >= {COVERAGE} AS notice FROM c),
x AS (SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR notice) AS labels,
             max(CASE WHEN phrase AND NOT base THEN 0.0 ELSE coverage END) AS score,
             count(*) FILTER (notice) AS n_spans FROM f GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score, coalesce(n_spans, 0)::BIGINT AS n_spans
FROM d LEFT JOIN x USING (r)"""
