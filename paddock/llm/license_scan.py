"""License scan: phrases by position, templates by an exact set-similarity join, in DataFrame functions only.

Phrases (base labels) are places where their words stand consecutively.  Beyond that, every line of a
text is a block (of a line longer than any template, what stands as near to a template's mark as a template reaches),
and so is every run of words across line breaks as long as a template (and the words that
``CONTAINMENT`` leaves free) that holds enough of it, so wrapped notices count as the same notice on one line
does.  Every block that holds at least ``CONTAINMENT`` of a license template's distinct words, all of the words that set the
template apart (affero, lesser, mit, ...) and none of its rivals', gets the
template's label.  The blocks are found by a set-similarity join:

* only words of some template can overlap, so a block is the set of those, in global order of frequency
  over all blocks of all documents, rare words first (the order is a literal array of at most the
  templates' words);
* length filter: a block shorter than the overlap a template needs is no candidate for it;
* prefix filter: block and template must share a word among the first ``size - needed + 1`` of each;
* positional filter: what may still follow the shared word must suffice for the overlap;
* candidates are verified on the whole sets, marks and rivals.

The index of template prefixes is a fixed list, so it is broadcast; everything of the size of the corpus stays
in the tasks that read it, but for matched blocks, which are combined per document before they are shuffled.

Defined results
* very long texts and lines are scanned whole;
* null text is empty: no words, no places, empty label strings, score 0;
* repeated rows each have their result; ids may be null; other columns are not read;
* an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import materialise

CONTAINMENT = 80  # percent of a template's distinct words

# Phrase -> label of the base scan.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label and text of license templates, words that set it apart (all must be there) and words of its rivals (none
# may be).
TEMPLATES = [
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.", "general public 3", "affero lesser"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation.", "general public", "affero lesser"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation.", "lesser", "affero"),
    ("agpl", "This program is licensed under the GNU Affero General Public License, version 3.", "affero", "lesser"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2", ""),
    ("apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0", "apache", ""),
    ("mit", "Released under the MIT License.", "mit license", ""),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction.", "granted software", ""),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0.", "cc nc", ""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "creative attribution", "noncommercial nc"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "creative noncommercial", ""),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met.", "redistribution", ""),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla", ""),
]

GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # what separates words, capitals aside


def spaced(text: Column) -> Column:
    """Words with one space before, between and after them; a text without words is one space."""
    return F.concat(F.lit(" "), F.regexp_replace(F.concat(text, F.lit(" ")), GAPS, " "))


def canonical(text: Column) -> Column:
    return F.regexp_replace(spaced(text), "^ +", " ")


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def template_sets() -> list[tuple[str, list[str]]]:
    import re

    return [(label, sorted(set(re.findall("[0-9a-z]+", text.lower())))) for label, text, *_ in TEMPLATES]


def anchors() -> list[str]:
    """The first mark of every template: without one of them a text has no block that any template accepts."""
    return sorted({marks.split()[0] for *_, marks, _ in TEMPLATES})


def longest() -> int:
    """Words of the longest run that may stand for a template."""
    return max(n for _, n in reaches())


def needed(size: int) -> int:
    return -(-size * CONTAINMENT // 100)


def reaches() -> list[tuple[list[str], int]]:
    """Distinct words of every template, and how many words a run of it may have."""
    import re

    return [(sorted(set(some)), len(some) * 100 // CONTAINMENT)
            for some in (re.findall("[0-9a-z]+", text.lower()) for _, text, *_ in TEMPLATES)]


def wrapped(content: Column) -> Column:
    """Template words of the runs of words across line breaks that hold enough of some template."""
    words, far = strings(sorted({w for some, _ in reaches() for w in some})), longest()
    # Nothing is left of A-Z: an "N" marks the first word of a line.
    text = F.regexp_replace(F.lower(content), r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ")
    text = F.regexp_replace(F.regexp_replace(text, r"\n[ \n]*", " N"), " +", " ")

    def runs(near: Column, some: list[str], n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(near) - n + 1, F.lit(1)))
        enough = F.filter(F.transform(starts, lambda at: F.array_intersect(F.slice(near, at, F.lit(n)), words)),
                          lambda b: F.size(F.array_intersect(b, strings(some))) >= needed(len(some)))
        return F.when(F.size(F.array_intersect(near, strings(some))) >= needed(len(some)), enough).otherwise(
            none)

    least, none = min(needed(len(some)) for some, _ in reaches()), F.array().cast("array<array<string>>")

    def found(tokens: Column, plain: Column) -> Column:
        """Of the words on both sides of every line break, as far as the longest run goes."""
        def at_break(w: Column, i: Column) -> Column:
            near = F.slice(plain, F.greatest(i - far + 2, F.lit(1)), F.least(i, F.lit(far - 1)) + far - 1)
            sought = F.transform(F.array(near), lambda x: F.when(
                F.size(F.array_intersect(x, words)) >= least,
                F.flatten(F.array(*[runs(x, some, n) for some, n in reaches()]))).otherwise(none))[0]
            return F.when(w.startswith("N") & (i > 0), sought).otherwise(none)

        return F.array_distinct(F.flatten(F.transform(tokens, at_break)))

    # An array of one value binds it, so that it is worked out once.
    out = F.transform(F.array(F.split(text, " ")), lambda tokens: F.transform(
        F.array(F.transform(tokens, lambda w: F.ltrim(w, F.lit("N")))), lambda plain: found(tokens, plain))[0])[0]
    return F.when(F.instr(content, "\n") > 0, out).otherwise(none)


def strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def base_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base`` (labels), and ``blocks``: the
    template words of every line that holds enough of them for the shortest template, and of wrapped runs."""
    content = F.coalesce(F.col(text), F.lit(""))
    any_phrase = "(?i) (?:" + "|".join(PHRASES) + ")(?= )"
    words = sorted({w for _, s in template_sets() for w in s})
    least = min(needed(len(s)) for _, s in template_sets())
    far, marks = longest(), strings(anchors())

    def blocks_of(line: Column) -> Column:
        """A line's template words; of a line longer than any template, those as near to an anchor as a template reaches."""
        def around(w: Column) -> Column:
            at = F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: F.array_contains(marks, F.element_at(w, i)))
            near = F.transform(at, lambda i: F.array_intersect(
                F.slice(w, F.greatest(i - far + 1, F.lit(1)), F.least(i, F.lit(far)) + far - 1), strings(words)))
            return F.when(F.size(w) <= far, F.array(F.array_intersect(w, strings(words)))).otherwise(near)

        # Only ASCII words can be in a template, so lower-casing more than A-Z here changes nothing but them.
        return F.transform(F.array(F.split(F.trim(F.lower(F.regexp_replace(line, GAPS, " "))), " ")), around)[0]

    # Without an anchor no block counts: most texts are done with one look.
    none = F.array().cast("array<array<string>>")
    held = content.rlike(r"(?i)(?<![0-9a-z\x80-\x{10FFFF}])(?:" + "|".join(anchors()) + r")(?![0-9a-z\x80-\x{10FFFF}])")
    lines = F.when(held, F.flatten(F.transform(F.split(content, "\n"), blocks_of))).otherwise(none)
    rows = docs.select(F.col(id_col).alias("doc_id"), canonical(content).alias("s"), lines.alias("lines"),
                       F.when(held, wrapped(content)).otherwise(none).alias("wrapped"))
    rows = rows.select("doc_id", "s", "lines", "wrapped", F.regexp_count("s", F.lit(any_phrase)).cast("long").alias("n_base"))
    hit = F.col("n_base") > 0
    first = spaces(F.regexp_extract("s", "(?s)^(.*?)" + any_phrase, 1))
    last = spaces(F.regexp_extract("s", "(?s)^(.*)" + any_phrase, 1))
    labels = F.array_compact(F.array(*[F.when(F.col("s").rlike(f"(?i) {p}(?= )"), F.lit(label)) for p, label in PHRASES.items()]))
    return rows.select(
        "doc_id", F.greatest(spaces(F.col("s")) - 1, F.lit(0)).cast("long").alias("n_words"), "n_base",
        F.when(hit, first).cast("long").alias("first_word"), F.when(hit, last).cast("long").alias("last_word"),
        F.when(hit, labels).otherwise(F.array().cast("array<string>")).alias("base"),
        F.concat(F.filter("lines", lambda b: F.size(b) >= least), "wrapped").alias("blocks"))


def prefix_index(order: list[str]) -> list[tuple]:
    """(word, label, position, size, needed, words, marks, rivals) of every template's prefix; ``order``: rare words first."""
    place, rows = {w: i for i, w in enumerate(order)}, []
    for (label, some), (*_, marks, rivals) in zip(template_sets(), TEMPLATES, strict=True):
        some = sorted(some, key=place.__getitem__)
        need = needed(len(some))
        rows += [(w, label, j, len(some), need, some, marks.split(), rivals.split()) for j, w in enumerate(some[:len(some) - need + 1])]
    return rows


def matches(blocks: DataFrame, order: list[str]) -> DataFrame:
    """(``row``, ``label``, ``share``) of every block (``row``, ``block``) and template that meet the threshold."""
    spark = blocks.sparkSession
    index = spark.createDataFrame(prefix_index(order), "word string, label string, j int, size int, need int, template array<string>, "
                                  "marks array<string>, rivals array<string>")
    ordered = blocks.select("row", F.array_intersect(strings(order), F.col("block")).alias("block"))
    some = ordered.select("row", "block", F.size("block").alias("held"), F.posexplode("block").alias("i", "word"))
    candidates = (some.join(F.broadcast(index), "word")
                  .where("held >= need")                                                         # length
                  .where("i <= held - need")                                                     # prefix
                  .where("least(i, j) + least(held - i, size - j) >= need"))                     # position
    share = F.size(F.array_intersect("template", "block"))
    apart = (F.size(F.array_intersect("marks", "block")) == F.size("marks")) & ~F.arrays_overlap("rivals", "block")
    return candidates.where((share >= F.col("need")) & apart).select("row", "label", (share / F.col("size")).alias("share"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels``, ``score`` (1 where a phrase stands, else the largest containment that met the threshold, else 0)."""
    spark = docs.sparkSession
    scanned = base_scan(docs, id_col, text).withColumn("row", F.monotonically_increasing_id())
    scanned = materialise(spark, scanned, "license-blocks")
    blocks = scanned.where(F.size("blocks") > 0).select("row", F.explode("blocks").alias("block"))
    # Frequency of each template word over all blocks: at most as many rows as the templates have words.
    counts = {r["word"]: r["n"] for r in blocks.select(F.explode("block").alias("word")).groupBy("word")
              .agg(F.count("*").alias("n")).collect()}
    words = sorted({w for _, s in template_sets() for w in s}, key=lambda w: (counts.get(w, 0), w))
    found = matches(blocks, words).groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    out = scanned.drop("blocks").join(found, "row", "left")
    more = F.coalesce("more", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", more)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
