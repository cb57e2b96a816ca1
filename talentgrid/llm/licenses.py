"""License scans: an exact set-similarity join of text blocks with license templates.

A block is BLOCK consecutive words of a text, or twice the words of a longer template; blocks start
every half block, so any passage of up to half a block and a word lies wholly in one.  A block matches a template if it holds at least
the share THRESHOLD of the template's distinct words.  All matches are found, without looking at
most blocks:

* the words of the templates are ordered by their frequency in the whole corpus, rare first;
* prefix filter: of a template with n distinct words that needs m, a match holds one of the first
  n - m + 1, so only blocks around such words are looked at;
* length filter: the block has m distinct words at least;
* positional filter: from the shared word on, both the template and the block still have m
  template words that are no rarer, if the shared word is the rarest one they share;
* what is left is verified by counting common words.

Places where a fixed phrase stands word by word are found in the same pass.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentgrid.llm.frames import ascii_lower, pick

WORD_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK, THRESHOLD = 64, 0.9

#: Phrases that name a license, and texts of license notices, as lower-case words.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"
            " and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the"
                 " license at http www apache org licenses license 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the"
              " gnu general public license as published by the free software foundation either version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"
            " provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]


def words_of(text: Column) -> Column:
    """Runs of digits, letters a-z and characters beyond ASCII, after lower-casing A-Z."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_GAPS), lambda word: word != "")


def corpus_counts(texts: DataFrame, words: list[str]) -> dict[str, int]:
    """Occurrences of the given words in all texts (column words)."""
    found = texts.select(F.explode("words").alias("word")).filter(F.col("word").isin(words))
    return {row.word: row.n for row in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def prefix_index(
    templates: list[tuple[str, str]], counts: dict[str, int], threshold: float, block: int = BLOCK
) -> list[tuple]:
    """(word, label, needed, size, template, later, length): the prefix words of each template.

    ``template`` are its distinct words, ``later`` all templates' words that are no rarer than the
    prefix word, ``length`` is that of its blocks.  The index is as large as the given templates.
    """
    sets = [(label, set(text.split()), max(block, 2 * len(text.split()))) for label, text in templates]
    order = sorted(set().union(*[words for _, words, _ in sets]), key=lambda word: (counts.get(word, 0), word))
    rank = {word: place for place, word in enumerate(order)}
    rows = []
    for label, words, length in sets:
        own = sorted(words, key=rank.__getitem__)
        needed = ceil(round(threshold * len(own), 9))
        for place, word in enumerate(own[:len(own) - needed + 1]):
            if len(own) - place >= needed:
                rows.append((word, label, needed, len(own), own, order[rank[word]:], length))
    return rows


def scan(
    docs: DataFrame, templates: list[tuple[str, str]] | None = None, phrases: dict[str, str] | None = None,
    threshold: float = THRESHOLD, block: int = BLOCK,
) -> DataFrame:
    """One row a document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts the places where a phrase stands, ``first_word`` and ``last_word`` are the
    first and last of these (words from 0; null without any), ``base_labels`` the phrases'
    labels.  ``labels`` adds those of templates that some block matches, and ``score`` is the
    greatest share of a template's words in one block, 0 if none reaches the threshold; a phrase
    counts as a template that it fills.  A block has ``block`` words, or for a template of more than
    half as many words twice the template's, so that none is lost between blocks.  A null text counts as empty.  Repeated rows stay.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    spark = docs.sparkSession
    # rows of one id and text have one result, so these two make the key of the join below
    texts = pick(docs, "doc_id", "text").select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), words_of(F.col("text")).alias("words")
    )
    counts = corpus_counts(texts, sorted({word for _, text in templates for word in text.split()}))
    index = prefix_index(templates, counts, threshold, block)
    starts = {text.split()[0] for text in phrases}
    places = texts.select("doc_id", "text_key", "words", F.posexplode("words").alias("place", "word"))

    # phrases and index are as large as the given templates, whatever the documents
    phrase_rows = [(text.split()[0], label, text.split()) for text, label in phrases.items()]
    phrase_table = spark.createDataFrame(phrase_rows, "word string, label string, phrase array<string>")
    base = places.filter(F.col("word").isin(sorted(starts))).join(F.broadcast(phrase_table), "word").filter(
        F.slice("words", F.col("place") + 1, F.size("phrase")) == F.col("phrase")
    ).select("doc_id", "text_key", "place", F.lit(True).alias("base"), "label", F.lit(1.0).alias("share"))

    index_table = spark.createDataFrame(
        index, "word string, label string, needed int, size int, template array<string>, later array<string>, length int"
    )
    near = places.filter(F.col("word").isin(sorted({row[0] for row in index}))).join(F.broadcast(index_table), "word")
    step = F.floor(F.col("length") / 2)
    last = F.floor(F.col("place") / step)
    near = near.withColumn("block", F.explode(F.array_distinct(F.array(last, F.greatest(last - 1, F.lit(0))))))
    held = F.array_distinct(F.slice("words", (F.col("block") * step + 1).cast("int"), F.col("length")))
    near = near.select("doc_id", "text_key", "label", "needed", "size", "template", "later", held.alias("held"))
    near = near.filter(F.size("held") >= F.col("needed")).filter(
        F.size(F.array_intersect("held", "later")) >= F.col("needed")
    )
    common = F.size(F.array_intersect("held", "template"))
    matched = near.withColumn("common", common).filter("common >= needed").select(
        "doc_id", "text_key", F.lit(None).cast("int").alias("place"), F.lit(False).alias("base"), "label",
        (F.col("common") / F.col("size")).alias("share"),
    )
    comma = lambda labels: F.concat_ws(",", F.sort_array(labels))
    found = base.union(matched).distinct().groupBy(F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_text")).agg(
        F.count_if("base").alias("n_base"), F.min("place").alias("first_word"), F.max("place").alias("last_word"),
        comma(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        comma(F.collect_set("label")).alias("labels"), F.max("share").alias("score"),
    )
    every = texts.select("doc_id", "text_key", F.size("words").cast("bigint").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_text"))
    return every.join(found, same, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"), F.col("last_word").cast("bigint").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def oracle_sql() -> str:
    """DuckDB SQL for the rows of ``scan`` over documents, by looking at every block."""
    quoted = lambda words: "[" + ", ".join(f"'{word}'" for word in words) + "]"
    phrases = ", ".join(f"({quoted(text.split())}, '{label}')" for text, label in PHRASES.items())
    templates = ", ".join(
        f"({quoted(sorted(set(text.split())))}, '{label}', {ceil(round(THRESHOLD * len(set(text.split())), 9))})"
        for label, text in TEMPLATES
    )
    step = BLOCK // 2
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
phrases(phrase, label) AS (VALUES {phrases}),
templates(words, label, needed) AS (VALUES {templates}),
places AS (SELECT row_id, unnest(range(len(w))) AS place, w FROM texts),
base AS (SELECT row_id, place, label FROM places JOIN phrases ON w[place + 1] = phrase[1]
  AND w[place + 1:place + len(phrase)] = phrase),
blocks AS (SELECT row_id, list_distinct(w[b * {step} + 1:b * {step} + {BLOCK}]) AS held
  FROM (SELECT row_id, w, unnest(range(len(w) // {step} + 1)) AS b FROM texts)),
matched AS (SELECT row_id, label, len(list_intersect(held, words)) / len(words) AS share
  FROM blocks JOIN templates ON len(list_intersect(held, words)) >= needed),
found AS (SELECT row_id, count(place) AS n_base, min(place) AS first_word, max(place) AS last_word,
    coalesce(string_agg(DISTINCT base_label, ',' ORDER BY base_label), '') AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT row_id, place, label AS base_label, label, 1.0::DOUBLE AS share FROM base
    UNION ALL SELECT row_id, NULL, NULL, label, share FROM matched) GROUP BY row_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM texts LEFT JOIN found USING (row_id)
"""
