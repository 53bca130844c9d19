r"""License scan: texts against licence templates by the Dice coefficient of word bigrams.

Segments of a text (its lines, its paragraphs and the whole of it) are normalised to
lower-case words.  A segment matches a template when the distinct bigrams of both
have a Dice coefficient of 0.8 or more.  Two exact bounds prune first:

* sizes: Dice >= t needs |S| between |T| t / (2 - t) and |T| (2 - t) / t;
* words: it also needs two thirds of the bigrams of T in S, so S holds at least one
  word of any set of words that touches more than a third of the bigrams of T.  Such
  a set, of the longest words, is derived for every template.

Texts without any of those words, which is nearly all of them, yield no segments.

A notice may also go over several paragraphs or stand inside longer ones.  So runs of
consecutive words are compared as well, wherever they start and end.  The best run starts
with a bigram of the template; a start is followed up when two thirds of the template
may lie within the longest run that could match.

DataFrame functions throughout.  Templates are fixed in the code, so the side that is
broadcast has a known size.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstrata.llm.common import text_of
from tripstrata.sources.scratch import scratch_dir

LEAST_DICE = 0.8
COMMON = {"by", "nd", "under"}  # in many texts, so they prune little
NOT_WORD = r"[^\p{L}\p{N}]+"
PARAGRAPH = r"\n[ \t\r]*\n"

# Wording of well-known licence notices.
TEMPLATES: dict[str, str] = {
    "agpl-name": "GNU Affero General Public License",
    "agpl-3.0-short": "Licensed under AGPL-3.0.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "bsd-3-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "bsd-3-clause-name": "BSD 3-Clause License",
    "bsd-disclaimer": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-4.0-short": "CC BY 4.0",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-4.0-name": "Creative Commons Attribution-NonCommercial 4.0",
    "cc-by-nc-nd-4.0-name": "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0",
    "cc-by-nc-nd-4.0-short": "CC BY-NC-ND 4.0",
    "cc-by-nc-sa-4.0-name": "Creative Commons Attribution-NonCommercial-ShareAlike 4.0",
    "cc-by-nc-sa-4.0-short": "CC BY-NC-SA 4.0",
    "cc-by-nd-4.0-name": "Creative Commons Attribution-NoDerivatives 4.0",
    "cc-by-nd-4.0-short": "CC BY-ND 4.0",
    "cc-by-sa-4.0-name": "Creative Commons Attribution-ShareAlike 4.0",
    "cc-by-sa-4.0-short": "CC BY-SA 4.0",
    "cc0-1.0-name": "CC0 1.0 Universal",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "isc-name": "ISC License",
    "lgpl-name": "GNU Lesser General Public License",
    "lgpl-2.1-short": "Licensed under LGPL-2.1.",
    "lgpl-3.0-short": "Licensed under LGPL-3.0.",
    "mit-line": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."
    ),
}


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def needed_words(bigrams: list[str], dice: float) -> list[str]:
    """Words of which any match of the template holds at least one.

    A match shares at least ``dice / (2 - dice)`` of the bigrams, so it cannot miss
    more than the rest of them.
    """
    spare = len(bigrams) * (1 - dice / (2 - dice))
    chosen, touched = [], set()
    for word in sorted({w for b in bigrams for w in b.split()}, key=lambda w: (w in COMMON, -len(w), w)):
        if len(touched) > spare + 1e-9:
            break
        more = {b for b in bigrams if word in b.split()}
        if more - touched:
            chosen.append(word)
            touched |= more
    return chosen


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NOT_WORD), "")


def _bigrams(words: Column) -> Column:
    at = F.sequence(F.lit(1), F.size(words) - 1)
    pairs = F.transform(at, lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def _matching_runs(words: DataFrame, table: DataFrame, dice: float) -> DataFrame:
    """``_row, template, score`` of the best run of words for each template that one matches.

    ``words`` is a staged table of ``_row, _words``, the words of whole texts; ``table``
    has the bigrams of the templates.
    """
    path = scratch_dir(words.sparkSession, "license-runs")
    at = F.sequence(F.lit(1), F.size("_words") - 1)
    pairs = F.transform(at, lambda i: F.concat_ws(" ", F.get("_words", i - 1), F.get("_words", i)))
    places = words.filter(F.size("_words") > 1).select("_row", F.posexplode(pairs).alias("_at", "bigram"))
    least = F.ceil(F.col("template_size") * (dice / (2 - dice)) - 1e-9)
    (
        places.join(F.broadcast(table), "bigram")
        .groupBy("_row", "template", "template_size", "longest")
        .agg(F.array_sort(F.collect_list("_at")).alias("_ats"), F.collect_set("bigram").alias("_shared"))
        .filter(F.size("_shared") >= least)
        .withColumn("_least", least.cast("int"))
        .select(
            "_row",
            "template",
            "template_size",
            "longest",
            F.explode(F.expr("filter(_ats, (p, i) -> get(_ats, i + _least - 1) - p < longest)")).alias("_start"),
        )
        .write.parquet(f"{path}/starts")
    )
    starts = words.sparkSession.read.parquet(f"{path}/starts")
    # A run's words are cut from its text; repeats in a run count once, where they come first.
    run = F.slice("_words", F.col("_start") + 1, F.col("longest") + 1)
    steps = F.posexplode(_bigrams(run)).alias("_at", "bigram")
    own = F.broadcast(table.select("template", "bigram", F.lit(1).alias("_own")))
    cells = (
        words.join(starts.hint("shuffle_hash"), "_row")
        .select("_row", "template", "template_size", "_start", steps)
        .join(own, ["template", "bigram"], "left")
    )
    so_far = Window.partitionBy("_row", "template", "_start").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    score = 2.0 * F.count("_own").over(so_far) / (F.count(F.lit(1)).over(so_far) + F.col("template_size"))
    scored = cells.select("_row", "template", score.alias("score")).groupBy("_row", "template").agg(F.max("score").alias("score"))
    return scored.filter(F.col("score") >= dice)


def scan_licenses(
    docs: DataFrame,
    key: str = "doc_id",
    templates: Mapping[str, str] = TEMPLATES,
    dice: float = LEAST_DICE,
) -> DataFrame:
    """``key, n_licenses, licenses, best_dice`` for each row.

    ``licenses`` lists the matched templates by name; ``best_dice`` is null without
    a match.  A null or empty text matches nothing.  Rows that repeat are scanned
    and returned each.  The longest text costs what its words cost.
    """
    spark: SparkSession = docs.sparkSession
    grams = {name: template_bigrams(text) for name, text in templates.items()}
    grams = {name: found for name, found in grams.items() if found}
    needed = sorted({w for found in grams.values() for w in needed_words(found, dice)})
    if not needed:
        nothing = F.lit(0).cast("long").alias("n_licenses")
        return docs.select(key, nothing, F.lit("").alias("licenses"), F.lit(None).cast("double").alias("best_dice"))
    sizes = [len(found) for found in grams.values()]
    least, most = min(sizes) * dice / (2 - dice) - 1e-9, max(sizes) * (2 - dice) / dice + 1e-9
    # Places of bigrams in the longest run that can match, where its repeats are those of the template.
    longest = {name: int((len(template_words(templates[name])) - 1) * (2 - dice) / dice + 1e-9) for name in grams}
    table = spark.createDataFrame(
        [(name, len(found), longest[name], gram) for name, found in grams.items() for gram in found],
        "template string, template_size int, longest int, bigram string",
    )

    path = scratch_dir(spark, "license-segments")
    wanted = F.array(*map(F.lit, needed))
    pieces = F.concat(F.split("_text", "\n"), F.split("_text", PARAGRAPH), F.array("_text"))
    hit = F.arrays_overlap(_words(F.col("_text")), wanted)
    segments = F.when(hit, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))
    (
        docs.select(F.col(key).alias("_key"), text_of().alias("_text"))
        .select(
            "_key",
            F.monotonically_increasing_id().alias("_row"),
            segments.alias("_segments"),
        )
        .write.parquet(path)
    )
    staged = spark.read.parquet(path)
    # Words are staged too: a filter on what is made of them would move below them and
    # split the segment anew for every word.
    (
        staged.select("_row", F.size("_segments").alias("_n"), F.posexplode("_segments").alias("_at", "_segment"))
        # The whole text is the last segment.
        .select("_row", "_at", (F.col("_at") == F.col("_n") - 1).alias("_whole"), _words(F.col("_segment")).alias("_words"))
        .filter((F.size("_words") - 1 >= least) & F.arrays_overlap("_words", wanted))
        .write.parquet(f"{path}-words")
    )
    split = (
        spark.read.parquet(f"{path}-words")
        .select("_row", "_at", _bigrams(F.col("_words")).alias("_bigrams"))
        .filter(F.size("_bigrams").between(least, most))
        .select("_row", "_at", F.size("_bigrams").alias("_size"), F.explode("_bigrams").alias("bigram"))
    )
    score = 2.0 * F.count(F.lit(1)) / (F.first("_size") + F.first("template_size"))
    segment_matches = (
        split.join(F.broadcast(table), "bigram")
        .filter(F.col("_size").between(F.col("template_size") * dice / (2 - dice) - 1e-9, F.col("template_size") * (2 - dice) / dice + 1e-9))
        .groupBy("_row", "_at", "template")
        .agg(score.alias("score"))
        .filter(F.col("score") >= dice)
        .select("_row", "template", "score")
    )
    runs = _matching_runs(spark.read.parquet(f"{path}-words").filter("_whole").select("_row", "_words"), table, dice)
    matches = (
        segment_matches.unionByName(runs)
        .groupBy("_row")
        .agg(F.array_sort(F.collect_set("template")).alias("found"), F.max("score").alias("best_dice"))
    )
    return staged.join(matches, "_row", "left").select(
        F.col("_key").alias(key),
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_licenses"),
        F.coalesce(F.array_join("found", ","), F.lit("")).alias("licenses"),
        "best_dice",
    )


def oracle_sql(templates: Mapping[str, str] = TEMPLATES, dice: float = LEAST_DICE) -> str:
    """The whole scan over ``documents`` in DuckDB SQL, without the pruning."""
    rows = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in templates.items()
    )
    words = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
    grams = "list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))"
    return rf"""
WITH templates(template, body) AS (VALUES {rows}),
t AS (SELECT template, {grams} AS grams FROM (SELECT template, {words.format("body")} AS words FROM templates)),
segments AS (
  SELECT doc_id, unnest(list_distinct(list_concat(string_split(text, chr(10)),
         regexp_split_to_array(text, '\n[ \t\r]*\n'), [text]))) AS segment
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
),
s AS (SELECT doc_id, {grams} AS grams
      FROM (SELECT doc_id, {words.format("segment")} AS words FROM segments) WHERE len(words) > 1),
scored AS (
  SELECT doc_id, template, 2.0::DOUBLE * len(list_intersect(s.grams, t.grams)) / (len(s.grams) + len(t.grams)) AS score
  FROM s JOIN t ON len(s.grams) BETWEEN 1 AND 10 * len(t.grams)
),
found AS (
  SELECT doc_id, count(DISTINCT template) AS n, string_agg(DISTINCT template, ',' ORDER BY template) AS names,
         max(score) AS best
  FROM scored WHERE score >= {dice} GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_licenses, coalesce(names, '') AS licenses, best AS best_dice
FROM documents d LEFT JOIN found USING (doc_id)"""
