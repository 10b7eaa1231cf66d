"""Licence scans: phrases, and an exact set-similarity join of text blocks with templates.

Main path: DataFrame functions only. A block is a paragraph, or of a longer one each ``BLOCK`` words from
every half of that on, so that words far apart never count together. A template is contained in a block to
the share of its distinct words that the block has; templates of fewer than ``SHORT`` words have to be there
whole. Words are ordered by how many blocks of all
documents hold them, rarest first; of a template with m words of which at least ``need`` =
ceil(threshold * m) must be met (m for a short one), any qualifying block holds one of the first m - need + 1 words in
that order. The join meets blocks and templates on those prefix words only, drops blocks with fewer
than ``need`` template words (length filter) and pairs whose first meeting leaves too few words
after it in either order (position filter), and counts the rest exactly.

Words that no template has can't add to an overlap, so blocks are reduced to template words
before anything is shuffled. The templates are a parameter, at most ``MOST_WORDS`` words in all;
all that is broadcast is made from them.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import LOWER, UPPER, WORD, ascii_lower, kept, text_of

#: A phrase's words stand consecutively and give its label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Paragraphs and sentences of public licences and their notices, and the labels they give.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
        "See the License for the specific language governing permissions and limitations under the License",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission",
    ],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "gpl": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation",
        "This work is licensed under the GNU General Public License, version 3",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details",
        "You should have received a copy of the GNU General Public License along with this program",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
        "Released under the MIT License",
    ],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "unlicense": [
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    ],
    "zlib": [
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
        "and to alter it and redistribute it freely, subject to the following restrictions",
    ],
}
THRESHOLD = 0.8
#: Templates of fewer distinct words have to be contained whole.
SHORT = 10
#: Words of a block at most; twice the longest template or more.
BLOCK = 256
MOST_WORDS = 20_000


def needed(words: list[str], threshold: float) -> int:
    """How many of a template's distinct words a block must have."""
    return len(words) if len(words) < SHORT else math.ceil(threshold * len(words) - 1e-9)


def template_words(text: str) -> list[str]:
    """The distinct words of a template, in alphabetical order."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return sorted(set(re.findall(WORD, lowered)))


def scanned(docs: DataFrame, phrases: dict[str, str], words: list[str]) -> DataFrame:
    """One pass over the texts: row (a number), doc_id, n_words, the places and labels of phrases, and
    the template words of each block."""
    paragraphs = F.split(ascii_lower(text_of()), r"\n[\t\r ]*\n")
    split = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        F.transform(paragraphs, lambda p: F.regexp_extract_all(p, F.lit(f"({WORD})"), 0)).alias("paragraphs"),
    )
    reached = F.exists("paragraphs", lambda p: F.arrays_overlap(p, _array([x.split()[0] for x in phrases])))
    flat = split.withColumn("words", F.when(reached, F.flatten("paragraphs")))

    def starts(phrase: str) -> Column:
        def at(word: Column, i: Column) -> Column:
            first, *rest = phrase.split()
            whole = word == first
            for k, other in enumerate(rest, 1):
                whole = whole & F.coalesce(F.get("words", i + k) == other, F.lit(False))
            return F.when(whole, i.cast("long"))

        return F.coalesce(F.array_compact(F.transform("words", at)), F.expr("cast(array() as array<bigint>)"))

    def parts(paragraph: Column) -> Column:
        step = BLOCK // 2
        begins = F.sequence(F.lit(1), F.greatest(F.size(paragraph) - step, F.lit(1)), F.lit(step))
        return F.when(F.size(paragraph) <= BLOCK, F.array(paragraph)).otherwise(
            F.transform(begins, lambda k: F.slice(paragraph, k, BLOCK))
        )

    placed = flat.select(
        "row",
        "doc_id",
        F.aggregate("paragraphs", F.lit(0).cast("long"), lambda n, p: n + F.size(p)).alias("n_words"),
        *[starts(p).alias(f"at_{k}") for k, p in enumerate(phrases)],
        F.flatten(F.transform("paragraphs", lambda p: F.transform(parts(p), lambda b: F.array_intersect(_array(words), b)))).alias("blocks"),
    )
    every = F.concat(*[f"at_{k}" for k in range(len(phrases))])
    labels = [F.when(F.size(f"at_{k}") > 0, F.lit(x)) for k, x in enumerate(phrases.values())]
    return placed.select(
        "row",
        "doc_id",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).alias("first_word"),
        F.array_max(every).alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base_labels"),
        F.filter("blocks", lambda b: F.size(b) > 0).alias("blocks"),
    )


def _array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def contained(blocks: DataFrame, templates: dict[str, list[str]], threshold: float) -> DataFrame:
    """row, label and containment of every template that a row's block holds to the threshold.

    blocks: row and words, the template words of one block.
    """
    sets = [(label, template_words(t)) for label, texts in templates.items() for t in texts]
    held = blocks.select(F.explode("words").alias("word")).groupBy("word").count().collect()
    counts = {r["word"]: r["count"] for r in held}  # at most the template words
    order = sorted({w for _, ws in sets for w in ws}, key=lambda w: (counts.get(w, 0), w))
    rank = {w: k for k, w in enumerate(order)}
    prefixes = []
    for label, words in sets:
        ranked = sorted(words, key=rank.__getitem__)
        need = needed(ranked, threshold)
        prefixes += [
            F.struct(
                F.lit(w).alias("word"), F.lit(i).alias("i"), F.lit(need).alias("need"),
                F.lit(label).alias("label"), _array(ranked).alias("template"),
            )
            for i, w in enumerate(ranked[: len(ranked) - need + 1])
        ]
    index = blocks.sparkSession.range(1).select(F.inline(F.array(*prefixes)))
    ordered = blocks.select("row", F.array_intersect(_array(order), "words").alias("block"))
    shortest = min(needed(ws, threshold) for _, ws in sets)
    tokens = ordered.where(F.size("block") >= shortest).select("row", "block", F.posexplode("block").alias("j", "word"))
    met = tokens.join(F.broadcast(index), "word").where(
        F.least(F.size("template") - F.col("i"), F.size("block") - F.col("j")) >= F.col("need")
    )
    share = F.size(F.array_intersect("template", "block")) / F.size("template")
    return met.where(F.size(F.array_intersect("template", "block")) >= F.col("need")).select(
        "row", "label", share.alias("containment")
    )


def license_scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, list[str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row.

    score: 1 with a phrase, else the largest containment that meets the threshold, else 0. Nulls: a
    null text has no words and no labels, a null doc_id stays. Repeated rows get a row each. Other
    columns are not looked at; an empty table gives no rows.
    """
    words = sorted({w for texts in templates.values() for t in texts for w in template_words(t)})
    longest = max(len(re.findall(WORD, t.lower())) for texts in templates.values() for t in texts)
    if 2 * longest > BLOCK:
        raise ValueError(f"a template has {longest} words, more than half of a block")
    if len(words) > MOST_WORDS:
        raise ValueError(f"the templates have {len(words)} words, more than {MOST_WORDS}")
    rows = kept(scanned(docs, phrases, words))
    blocks = rows.select("row", F.explode("blocks").alias("words"))
    found = contained(blocks, templates, threshold).groupBy("row").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("best")
    )
    none = F.expr("cast(array() as array<string>)")
    both = F.array_sort(F.array_union("base_labels", F.coalesce("found", none)))
    return rows.join(found, "row", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def oracle_sql(templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same over ``documents`` in plain SQL: every block against every template."""
    sets = [(label, template_words(t)) for label, texts in templates.items() for t in texts]
    rows = ", ".join(f"('{label}', {ws!r}, {needed(ws, threshold)})" for label, ws in sets)
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    phrase = {
        label: " and ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p.split())) for p, label in PHRASES.items()
    }
    kinds = " ".join(f"when {test} then '{label}'" for label, test in phrase.items())
    return f"""
        with low as (
            select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as t from documents),
        split as (select doc_id, t, regexp_extract_all(t, '{word}') as w from low),
        places as (
            select doc_id, i, case {kinds} end as label
            from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from split)),
        base as (
            select doc_id, count(*) as n_base, min(i) - 1 as first_word, max(i) - 1 as last_word,
                list_sort(list(distinct label)) as labels
            from places where label is not null group by doc_id),
        templates(label, words, need) as (values {rows}),
        paragraphs as (
            select doc_id, regexp_extract_all(p, '{word}') as ws
            from (select doc_id, unnest(regexp_split_to_array(t, '\n[\t\r ]*\n')) as p from low)),
        blocks as (
            select doc_id, list_distinct(ws[k:k + {BLOCK - 1}]) as words
            from (select doc_id, ws, unnest(range(1, greatest(len(ws) - {BLOCK // 2}, 1) + 1, {BLOCK // 2})) as k
                  from paragraphs)),
        pairs as (
            select b.doc_id, m.label, len(list_intersect(b.words, m.words)) as n, len(m.words) as of, m.need
            from blocks b, templates m),
        found as (
            select doc_id, list(distinct label) as labels, max(n / of) as best
            from pairs where n >= need group by doc_id)
        select s.doc_id, len(s.w)::bigint as n_words, coalesce(b.n_base, 0)::bigint as n_base,
            b.first_word::bigint as first_word, b.last_word::bigint as last_word,
            coalesce(array_to_string(b.labels, ','), '') as base_labels,
            coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') as labels,
            case when b.n_base > 0 then 1.0 else coalesce(f.best, 0.0) end::double as score
        from split s left join base b using (doc_id) left join found f using (doc_id)
    """
