"""License scan: exact set-similarity join of text blocks with license templates.

A template is found in a text where ``span`` words in a row, over any number of lines, hold at
least ``threshold`` of the template's words; ``span`` is a quarter more than the template's length.
Templates of few words are required whole, in a stretch of just their length: they tell licenses
apart by a word, and a part of one is ordinary language.
A text is cut into blocks of words that overlap by the longest span, so each such stretch lies
whole in a block; blocks and templates are joined as sets of words. The join is exact:

* words are ordered by their count over the whole corpus, rarest first;
* prefix filter: a block that reaches the threshold shares one of the first
  ``size - need + 1`` words of the template, so only those are joined;
* length filter: the block has at least ``need`` words;
* positional filter: past the first shared word enough template words must remain;
* what is left is confirmed on the full sets, then on every stretch of ``span`` words.

Fixed phrases are counted besides, over the whole text and across lines.
All of it is DataFrame code. Only the templates are broadcast, and their words counted to the
driver: both are bounded by the template list, not by the corpus.

Edge cases: a null text is empty (no words, no labels, score 0); repeated rows get equal results
each; a null id is an id like any other.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.tables import Scratch, literal_strings, whole_text

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Standard headers, and paragraphs of standard license texts that name no holder.
#: A GPL label stands for the family: the headers of its versions differ by a word or two.
TEMPLATES = {
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
    "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
    "License for more details.",
    "gpl-text": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it "
    "is not allowed.",
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
    "in compliance with the License.",
    "apache-2.0-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the "
    'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
    "implied. See the License for the specific language governing permissions and limitations under the License.",
    "apache-2.0-text": "Subject to the terms and conditions of this License, each Contributor hereby grants to You a "
    "perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare "
    "Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative "
    "Works in Source or Object form.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files",
    "mit-text": 'to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
    "the Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
    "permission notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "bsd-warranty": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-2.0-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at "
    "http://mozilla.org/MPL/2.0/.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "public-domain": "This is free and unencumbered software released into the public domain.",
    "public-domain-text": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
    "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    # Short notices: required whole, see SHORT.
    "gpl-3-line": "GNU General Public License, version 3",
    "gpl-2-line": "GNU General Public License, version 2",
    "lgpl-line": "GNU Lesser General Public License",
    "agpl-line": "GNU Affero General Public License",
    "apache-2.0-line": "Apache License, Version 2.0",
    "mit-line": "under the MIT License",
    "bsd-line": "under the BSD License",
    "mpl-2.0-line": "Mozilla Public License, v. 2.0",
    "cc-by-line": "Licensed under CC BY 4.0",
    "cc-by-sa-line": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0",
}

#: A template of fewer distinct words is required whole: all its words, in as many words in a row.
SHORT = 18

#: Words of a block at least, without what it shares with the next one.
BLOCK_WORDS = 256

#: Separators in texts whose letters A-Z may still be upper case.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    need: int
    span: int

    @staticmethod
    def of(label: str, text: str, threshold: float) -> Template:
        lowered = re.sub(r"[A-Z]", lambda m: m[0].lower(), text)
        every = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        words = tuple(dict.fromkeys(every))
        if len(words) < SHORT:
            return Template(label, words, len(words), len(every))
        return Template(label, words, math.ceil(threshold * len(words) - 1e-9), math.ceil(1.25 * len(every)))


def _spaced(column: str) -> str:
    """The words with one space before, between and after them."""
    return f"concat(' ', trim(regexp_replace({column}, r'{SEPARATOR}', ' ')), ' ')"


def _lower(column: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"translate({column}, '{upper}', '{upper.lower()}')"


def count_phrases(texts: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """Adds word and phrase counts to rows of (id, key, txt). No phrase may overlap another one."""
    any_phrase = "(?i)(?<= )(?:" + "|".join(phrases) + ")(?= )"
    spaced = texts.withColumn("spaced", F.expr(_spaced("txt")))
    found = spaced.withColumn("n_base", F.expr(f"regexp_count(spaced, '{any_phrase}')").cast("long"))
    # The words before a place are the spaces before it, less the one in front.
    before = "length({0}) - length(replace({0}, ' ', '')) - 1"
    first = f"regexp_extract(spaced, '(?s)^(.*?){any_phrase}', 1)"
    last = f"regexp_extract(spaced, '(?s)^(.*){any_phrase}', 1)"
    hits = ", ".join(f"case when spaced rlike '(?i) {p} ' then '{label}' end" for p, label in phrases.items())
    return found.select(
        "id",
        "key",
        F.expr(f"case when spaced = '  ' then 0L else cast({before.format('spaced')} as long) end").alias("n_words"),
        "n_base",
        F.expr(f"case when n_base > 0 then cast({before.format(first)} as long) end").alias("first_word"),
        F.expr(f"case when n_base > 0 then cast({before.format(last)} as long) end").alias("last_word"),
        F.expr(
            f"case when n_base > 0 then array_distinct(array_compact(array({hits}))) "
            "else cast(array() as array<string>) end"
        ).alias("base"),
    )


def word_counts(texts: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Count of each template word over all texts."""
    spark = texts.sparkSession
    known = spark.sql(f"select explode({literal_strings(vocabulary)}) as word")
    words = texts.select(F.explode(F.expr(f"split(trim({_spaced(_lower('txt'))}), ' ')")).alias("word"))
    counted = words.join(F.broadcast(known), "word", "left_semi").groupBy("word").count()
    return {r["word"]: r["count"] for r in counted.collect()}  # a row per template word


def block_hits(texts: DataFrame, vocabulary: list[str], span: int) -> DataFrame:
    """Blocks of words that hold template words: their number of distinct words and those template
    words, in the order of the vocabulary. Each stretch of ``span`` words of a text lies whole in one of its blocks."""
    step = max(4 * span, BLOCK_WORDS)
    # A line feed after each ``step`` words; texts have none left. The rest matches too, so no place is tried twice.
    cut = f"regexp_replace(ltrim({_spaced(_lower('txt'))}), '((?:[^ ]++ ){{1,{step}}}+)', '$1\n')"
    pieces = texts.select("id", "key", F.expr(f"split({cut}, '\n')").alias("pieces"))
    after = f"substring_index(coalesce(get(pieces, i + 1), ''), ' ', {span})"
    blocks = pieces.select("id", "key", F.expr(f"posexplode(transform(pieces, (p, i) -> concat(p, {after})))").alias("block", "body"))
    # Exploded arrays of one element keep the optimizer from repeating what they hold.
    words = blocks.select("id", "key", "block", "body", F.expr("explode(array(array_distinct(split(trim(body), ' '))))").alias("words"))
    return words.select(
        "id",
        "key",
        "block",
        "body",
        F.size("words").alias("size"),
        F.expr(f"explode(array(array_intersect({literal_strings(vocabulary)}, words)))").alias("hits"),
    )


def similar_blocks(hits: DataFrame, templates: list[Template], count: dict[str, int]) -> DataFrame:
    """(id, key, block, label, containment) of every block that reaches a template's threshold."""
    spark = hits.sparkSession
    order = lambda w: (count.get(w, 0), w)
    rows, first = [], set()
    for t in templates:
        ranked = sorted(t.words, key=order)
        prefix = ranked[: len(ranked) - t.need + 1]
        first.update(prefix)
        for place, word in enumerate(prefix):
            rows.append(
                f"('{t.label}', '{word}', {place}, {len(ranked)}, {t.need}, {t.span}, "
                f"{literal_strings(prefix)}, {literal_strings(ranked)})"
            )
    index = spark.sql("select * from values " + ", ".join(rows) + " as t(label, word, place, total, need, span, prefix, ranked)")
    postings = hits.select("id", "key", "block", "body", "size", "hits", F.explode(F.expr(f"array_intersect(hits, {literal_strings(sorted(first))})")).alias("word"))
    joined = postings.join(F.broadcast(index), "word").where(
        "size >= need and size(hits) >= need "
        # What template and block can still share from this word on, both in the global order.
        "and least(total - place, size(hits) - array_position(hits, word) + 1) >= need "
        # Once per block and template: at the first prefix word they share.
        "and element_at(array_intersect(prefix, hits), 1) = word "
        "and size(array_intersect(ranked, hits)) >= need"
    )
    # A best stretch begins with a template word.
    placed = joined.select("id", "key", "block", "label", "total", "need", "span", "ranked", F.expr("explode(array(split(trim(body), ' ')))").alias("words"))
    starts = "filter(sequence(1, size(words)), i -> array_contains(ranked, words[i - 1]))"
    best = f"array_max(transform({starts}, i -> size(array_intersect(ranked, slice(words, i, span)))))"
    shared = placed.select("id", "key", "block", "label", "total", F.expr(f"explode(filter(array({best}), s -> s >= need))").alias("shared"))
    return shared.select("id", "key", "block", "label", (F.col("shared") / F.col("total")).alias("containment"))


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    threshold: float = 0.8,
) -> DataFrame:
    """One row per document row: phrase places, labels and score.

    The score is the highest containment of a found template, and 1 where a phrase stands.
    """
    known = [Template.of(label, text, threshold) for label, text in templates.items()]
    vocabulary = sorted({w for t in known for w in t.words})
    texts = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("txt"))
    texts = texts.withColumn("key", F.xxhash64("txt"))
    count = word_counts(texts, vocabulary)
    hits = block_hits(texts, sorted(vocabulary, key=lambda w: (count.get(w, 0), w)), max(t.span for t in known))
    found = Scratch(docs.sparkSession, "licenses").keep(similar_blocks(hits, known, count))
    by_doc = found.groupBy(F.col("id").alias("of_id"), F.col("key").alias("of_key")).agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best")
    )
    counted = count_phrases(texts, phrases)
    both = counted.join(by_doc, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key")), "left")
    return both.select(
        F.col("id").alias(id_column),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.expr("array_join(sort_array(base), ',')").alias("base_labels"),
        F.expr("array_join(sort_array(array_union(base, coalesce(more, cast(array() as array<string>)))), ',')").alias("labels"),
        F.expr("case when n_base > 0 then 1.0d else coalesce(best, 0.0d) end").alias("score"),
    )
