"""License templates in text, in DataFrame functions only.

Base labels stand where a phrase's words stand consecutively.  Beside them an exact set-similarity join finds every
text block that contains at least a share of a template's distinct words.  A block is a run of consecutive words, wherever lines
end, no longer than the template's words divided by that share.  Words of each template are put in order of how
often they occur in the corpus, rarest first.  A block that holds enough of a template must hold one of the template's first
words (prefix filter), its text must have at least as many distinct words of templates as must be shared (length filter), and from the first
shared word on the template must have enough words left (positional filter); what is left is verified block by block.

Texts are cut into words once: what is kept of them are the places of words that stand in any template or phrase.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, texts

#: A word is a run of lower-case ASCII letters, digits and whatever isn't ASCII, after A-Z are lower-cased.
WORD, WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Phrases of the base and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: The usual notices of public licenses, and the whole texts of short ones.
TEMPLATES = {
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-2-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "rights-reserved": "All rights reserved.",
}
#: Share of a template's distinct words that a block must contain.
THRESHOLD = 0.8


def plain_words(text: str) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def needed(template: str, threshold: float) -> int:
    """How many of its distinct words a block must share."""
    return max(1, math.ceil(threshold * len(set(plain_words(template))) - 1e-9))


def longest(template: str, threshold: float) -> int:
    """Most words of a block."""
    return math.ceil(len(plain_words(template)) / threshold - 1e-9)


def vocabulary(templates: dict[str, str], phrases: dict[str, str] = PHRASES) -> list[str]:
    """Every word of a template or phrase."""
    return sorted({w for t in [*templates.values(), *phrases] for w in plain_words(t)})


def _in(words: list[str]) -> str:
    """A list for IN: words are letters and digits, so none needs a quote."""
    return ", ".join(f"'{w}'" for w in words)


def word_places(docs: DataFrame, templates: dict[str, str]) -> DataFrame:
    """row, doc_id, n_words, hits: the places (p from 0, w) of the vocabulary's words in each whole text, stored."""
    known = _in(vocabulary(templates))
    ws = F.regexp_extract_all("text", F.lit(WORD_ANY_CASE), F.lit(0))
    # lower() knows more capitals than A-Z; only words that it finds are looked at again
    hits = f"""transform(array(ws), v -> struct(CAST(size(v) AS BIGINT) AS n_words, filter(transform(filter(transform(v, (x, i) -> IF(lower(x) IN ({known}), struct(i AS p, x AS w), NULL)), x -> x IS NOT NULL),
        x -> struct(x.p AS p, translate(x.w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w)), x -> x.w IN ({known})) AS hits))[0]"""
    rows = texts(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", ws.alias("ws"))
    return stored(rows.select("row", "doc_id", F.expr(hits).alias("x")).select("row", "doc_id", "x.*"), "licenses")


def frequencies(places: DataFrame, templates: dict[str, str]) -> dict[str, int]:
    """How often each of the templates' words occurs in all texts; absent ones 0.  As many numbers as templates have words."""
    counts = places.select(F.explode("hits.w").alias("w")).groupBy("w").count()
    return dict.fromkeys(sorted({w for t in templates.values() for w in plain_words(t)}), 0) | {r["w"]: r["count"] for r in counts.collect()}


def prefixes(templates: dict[str, str], counts: dict[str, int], threshold: float) -> list[tuple]:
    """Rows (word, template, at, before, size, need, span, whole): each word of a template's prefix, those before it, and how many
    distinct words the template has, a block must share, and a block is long."""
    rows = []
    for name, text in templates.items():
        ordered = sorted(set(plain_words(text)), key=lambda w: (counts[w], w))
        need = needed(text, threshold)
        rows += [(w, name, at, ordered[:at], len(ordered), need, longest(text, threshold), ordered) for at, w in enumerate(ordered[: len(ordered) - need + 1])]
    return rows


INDEX = "word string, template string, at int, before array<string>, size int, need int, span int, whole array<string>"


def similar_blocks(places: DataFrame, index: list[tuple]) -> DataFrame:
    """row, template, shared, size: each template that a block of the row's text contains enough of, and the most that any one shares.

    The index is of templates, a parameter, so it is small whatever the corpus; only rows with a prefix word go further than the first step.
    """
    spark = places.sparkSession
    prefix = F.broadcast(spark.createDataFrame(index, INDEX))
    have = F.array_distinct("hits.w").alias("have")
    first = places.where(F.expr(f"exists(hits, x -> x.w IN ({_in(sorted({r[0] for r in index}))}))")).select("row", "hits", have).select("*", F.explode("have").alias("word"))
    near = first.join(prefix, "word").where((F.size("have") >= F.col("need")) & (F.col("size") - F.col("at") >= F.col("need")))
    # a template that shares several prefix words with a text is verified once: at the first of them
    near = near.where(~F.arrays_overlap("have", "before") & (F.size(F.array_intersect("have", "whole")) >= F.col("need")))
    # a block can be moved on to its first word of the template without losing one
    shared = F.expr("array_max(transform(array(filter(hits, x -> array_contains(whole, x.w))), t -> array_max(transform(t, (x, i) -> size(array_distinct(transform(filter(slice(t, i + 1, span), y -> y.p < x.p + span), y -> y.w)))))))")
    return near.withColumn("shared", shared).where("shared >= need").select("row", "template", "shared", "size")


def _phrase_places(ws: list[str]) -> Column:
    """Places where the words ws stand one after the other; hits holds all of their places."""
    rest = " ".join(f"AND get(hits, i + {i}).w = '{x}' AND get(hits, i + {i}).p = x.p + {i}" for i, x in enumerate(ws) if i)
    return F.expr(f"filter(transform(hits, (x, i) -> IF(x.w = '{ws[0]}' {rest}, x.p, -1)), p -> p >= 0)")


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row for each row.

    Whole texts, null as empty.  ``labels`` adds the names of the templates that a block of words contains to the base labels, on however many
    lines; ``score`` is 1 with a base label, else the highest containment of a template that reaches the threshold, else 0.  One scan of
    the texts; the rest works on the places that leaves.  Repeated rows each keep their own; other
    columns aren't read; an empty table gives no rows.
    """
    templates = TEMPLATES if templates is None else templates
    places = word_places(docs, templates)
    near = similar_blocks(places, prefixes(templates, frequencies(places, templates), threshold))
    labels = near.groupBy("row").agg(F.collect_set("template").alias("names"), F.max(F.col("shared") / F.col("size")).alias("share"))
    phrases = [(plain_words(p), label) for p, label in PHRASES.items()]
    base = places.select("row", "doc_id", "n_words", *[_phrase_places(ws).alias(f"p{i}") for i, (ws, _) in enumerate(phrases)])
    every = F.concat(*[F.col(f"p{i}") for i in range(len(phrases))])
    here = F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)]))
    out = base.select("row", "doc_id", "n_words", every.alias("every"), here.alias("base")).join(labels, "row", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.size("every").cast("long").alias("n_base"),
        F.array_min("every").cast("long").alias("first_word"),
        F.array_max("every").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("names", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).cast("double").alias("score"),
    )


def oracle(templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> str:
    """SQL that gives scan()'s rows of ``documents`` by comparing every block of every text with every template."""
    templates = TEMPLATES if templates is None else templates
    sizes = ", ".join(f"('{n}', {len(set(plain_words(t)))}, {needed(t, threshold)}, {longest(t, threshold)})" for n, t in templates.items())
    words = ", ".join(f"('{n}', '{w}')" for n, t in templates.items() for w in sorted(set(plain_words(t))))
    phrases = ", ".join(f"('{label}', '{plain_words(p)[0]}', ' {' '.join(plain_words(p))} ', {len(plain_words(p))})" for p, label in PHRASES.items())
    return f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents
        ), sizes(template, size, need, span) AS (VALUES {sizes}
        ), known(template, w) AS (VALUES {words}
        ), phrases(label, w, words, n) AS (VALUES {phrases}
        ), places AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM d
        ), base AS (
            SELECT places.r, label, p FROM places JOIN phrases USING (w) JOIN d ON d.r = places.r WHERE ' ' || array_to_string(ws[p + 1 : p + n], ' ') || ' ' = words
        ), b AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, list(DISTINCT label) AS labels FROM base GROUP BY r
        ), hits AS (SELECT r, template, p, w FROM places JOIN known USING (w)
        ), enough AS (SELECT r, template FROM hits JOIN sizes USING (template) GROUP BY r, template, need HAVING count(DISTINCT w) >= need
        ), kept AS (SELECT hits.* FROM hits SEMI JOIN enough USING (r, template)
        ), blocks AS (
            SELECT a.r, a.template, a.p, count(DISTINCT z.w) AS shared FROM kept a JOIN sizes USING (template) JOIN kept z ON a.r = z.r AND a.template = z.template AND z.p BETWEEN a.p AND a.p + span - 1 GROUP BY ALL
        ), found AS (
            SELECT r, list(DISTINCT template) AS names, max(CAST(shared AS DOUBLE) / size) AS share FROM blocks JOIN sizes USING (template) WHERE shared >= need GROUP BY r
        )
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
            coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
            coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(names, [])))), ','), '') AS labels,
            CASE WHEN n_base > 0 THEN CAST(1 AS DOUBLE) ELSE coalesce(share, CAST(0 AS DOUBLE)) END AS score
        FROM d LEFT JOIN b USING (r) LEFT JOIN found USING (r)
    """
