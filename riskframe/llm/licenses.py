"""License notices in texts: phrases word by word, and templates by set similarity.

A block is a window of consecutive lines.  A block answers a template when it holds at least a
given share of the template's words.  Words are put in one order, rarest in the corpus first;
a block that holds k of a template's n words holds one of the template's first n - k + 1, so only
these are looked up.  Sizes and the places of the first common word rule out most of what is
found, and the rest is counted exactly.  Only built-in functions are used.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import ascii_lower, materialize, table

CUTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LINES = 3

# Phrases whose words stand one after the other, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public notices by which a license is named, and their labels.
TEMPLATES = (
    ("agpl", "This program is licensed under the GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT license"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def _plain_words(text: str) -> list[str]:
    """The words of a template, as those of a text; templates are plain ASCII."""
    kept = "".join(c if c.isalnum() else " " for c in text.lower())
    return kept.split()


def template_sets(templates: Sequence[tuple[str, str]], share: float) -> list[tuple[str, list[str], int]]:
    """(label, distinct words, words that a block must hold)."""
    sets = [(label, sorted(set(_plain_words(text)))) for label, text in templates]
    return [(label, words, max(1, ceil(share * len(words) - 1e-9))) for label, words in sets if words]


PLACES = "array<struct<start: int, label: string>>"
HEADS = "array<struct<rank: int, j: int, label: string, template: array<int>, need: int>>"
NOTICES = "array<struct<line: int, label: string, share: double>>"


def _stands(words: Column, phrase: str) -> Column:
    """The places from which the words of a phrase stand one after the other."""
    parts = phrase.split()

    def from_here(i: Column) -> Column:
        found = F.lit(True)
        for k, part in enumerate(parts):
            found = found & (F.element_at(words, i + F.lit(k + 1)) == part)
        return found

    last = F.size(words) - len(parts)
    return F.filter(F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")), from_here)


def _places(words: Column, phrases: Mapping[str, str]) -> Column:
    """(start, label) of every phrase, by start.  Texts that lack a word of every phrase are done at once."""
    labelled = lambda label: lambda i: F.struct(i.alias("start"), F.lit(label).alias("label"))
    may, found = F.lit(False), [F.array().cast(PLACES)]
    for phrase, label in phrases.items():
        held = F.lit(True)
        for part in phrase.split():
            held = held & F.array_contains(words, part)
        may = may | held
        found.append(F.transform(_stands(words, phrase), labelled(label)))
    return F.when(may, F.array_sort(F.concat(*found))).otherwise(found[0])


def scan_licenses(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    share: float = 0.8,
    lines: int = LINES,
) -> DataFrame:
    """Phrases and notices of every text.

    Returns key, n_words, places (array of (start, label): where phrases stand, in words from 0,
    by start) and notices (array of (line, label, share), by line: the blocks that hold at least
    ``share`` of the distinct words of a template; of several templates with one label the
    largest share).  A block is ``lines`` consecutive lines, so that wrapped notices are met, and
    every line begins one.  Blocks are sets: order and repeats inside do not count, and a very
    long line is one block.

    One row per input row, repeated ones too.  Null and empty texts have no words, places or
    notices; null keys and other columns are harmless; an empty table gives an empty result.
    Templates and phrases are parameters and as such small; without templates there are no notices.
    """
    sets = template_sets(templates, share)
    spark = docs.sparkSession
    vocabulary = sorted({w for _, words, _ in sets for w in words}) or [""]
    by_line = F.transform(
        F.split(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), "\n"),
        lambda s: F.filter(F.split(s, CUTS), lambda w: w != ""),
    )
    read = (
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
        .select("row", "key", by_line.alias("by_line"))
        .select(
            "row",
            "key",
            F.flatten("by_line").alias("words"),
            # words of no template cannot be common to a block and a template
            F.transform("by_line", lambda ws: F.filter(ws, lambda w: w.isin(vocabulary))).alias("held"),
        )
    )
    light = materialize(
        read.select("row", "key", F.size("words").cast("long").alias("n_words"), _places(F.col("words"), phrases).alias("places"), "held"),
        "license-words",
    )
    # one order of words, rarest first by the number of rows that hold them, of all rows
    counted = light.select(F.explode(F.array_distinct(F.flatten("held"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    rows_with = {r["word"]: r["n"] for r in counted.collect()}  # at most the words of the templates
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (rows_with.get(w, 0), w)))}

    heads = []  # (rank, place in the template, label, all ranks, words needed)
    for label, words, need in sets:
        ranks = sorted(rank[w] for w in words)
        heads += [{"rank": r, "j": j, "label": label, "template": ranks, "need": need} for j, r in enumerate(ranks[: len(ranks) - need + 1])]
    first_words = sorted(w for w in vocabulary if rank[w] in {h["rank"] for h in heads}) or [""]
    # made by the plan itself, so its size is known to be that of the templates
    heads = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(heads)), HEADS)))

    bait = F.array(*[F.lit(w) for w in first_words])
    order = F.array(*[F.lit(w) for w in sorted(rank, key=rank.get)])
    some = light.select("row", "held").where(F.arrays_overlap(F.flatten("held"), bait))
    blocks = some.select(
        "row",
        F.explode(
            F.filter(
                F.transform(
                    F.sequence(F.lit(1), F.size("held")),
                    lambda i: F.struct(i.alias("line"), F.array_distinct(F.flatten(F.slice(F.col("held"), i, lines))).alias("words")),
                ),
                lambda b: F.arrays_overlap(b["words"], bait),
            )
        ).alias("b"),
    ).select("row", (F.col("b.line") - 1).alias("line"), F.array_sort(F.transform("b.words", lambda w: (F.array_position(order, w) - 1).cast("int"))).alias("block"))
    met = blocks.select("row", "line", "block", F.posexplode("block").alias("i", "rank")).join(heads, "rank")
    # the first common word leaves at least ``need`` words from there on, in the block and in the template
    met = met.where((F.size("block") - F.col("i") >= F.col("need")) & (F.size("template") - F.col("j") >= F.col("need")))
    met = met.withColumn("common", F.size(F.array_intersect("block", "template"))).where("common >= need")
    best = met.groupBy("row", "line", "label").agg(F.max(F.col("common") / F.size("template")).alias("share"))
    notices = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("line", "label", "share"))).alias("notices"))
    return (
        light.drop("held")
        .join(notices, "row", "left")
        .select(F.col("key").alias(key), "n_words", "places", F.coalesce(F.col("notices").cast(NOTICES), F.array().cast(NOTICES)).alias("notices"))
    )


def op12(spark, sf_dir: str) -> DataFrame:
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    places, notices = F.col("places"), F.col("notices")
    starts = F.transform(places, lambda p: p["start"].cast("long"))
    base = F.transform(places, lambda p: p["label"])
    # a phrase is a template that is held whole
    shares = F.concat(F.when(F.size(places) > 0, F.array(F.lit(1.0))).otherwise(F.array(F.lit(0.0))), F.transform(notices, lambda x: x["share"]))
    return scan_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        listed(base).alias("base_labels"),
        listed(F.concat(base, F.transform(notices, lambda x: x["label"]))).alias("labels"),
        F.array_max(shares).alias("score"),
    )


def _sql() -> str:
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    cuts = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    templates = ", ".join(f"('{label}', {quoted(words)}, {need})" for label, words, need in template_sets(TEMPLATES, 0.8))
    stands = {p: " AND ".join(f"w[i + {k + 1}] = '{part}'" for k, part in enumerate(p.split())) for p in PHRASES}
    places = " UNION ALL ".join(
        f"SELECT r, unnest(list_filter(range(len(w)), lambda i: {stands[phrase]})) AS start, '{label}' AS label FROM read" for phrase, label in PHRASES.items()
    )
    return f"""
WITH lowered AS (
  SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
read AS (SELECT r, doc_id, regexp_extract_all(t, '{cuts}') AS w, string_split(t, chr(10)) AS lines FROM lowered),
places AS ({places}),
templates AS (SELECT * FROM (VALUES {templates}) AS x(label, words, need)),
starts AS (SELECT r, lines, unnest(range(1, len(lines) + 1)) AS i FROM read),
blocks AS (SELECT DISTINCT r, list_distinct(regexp_extract_all(array_to_string(lines[i:i + {LINES - 1}], ' '), '{cuts}')) AS words FROM starts),
met AS (
  SELECT r, label, len(list_intersect(b.words, t.words)) / len(t.words) AS share FROM blocks b, templates t
  WHERE len(list_intersect(b.words, t.words)) >= need),
base AS (SELECT r, count(*) AS n, min(start) AS a, max(start) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY r),
every AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT r, label, 1.0::DOUBLE AS share FROM places UNION ALL SELECT r, label, share FROM met) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, b::BIGINT AS last_word,
       coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM read LEFT JOIN base USING (r) LEFT JOIN every USING (r)
"""


QUERIES = {"op12_license_scan": (op12, _sql())}
