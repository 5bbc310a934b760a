"""License scan against brute force in Python."""

import re

from paddock.llm import license_scan as ls
from paddock.llm.queries import op7_license_scan

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(doc, text):
    text = (text or "").translate(AZ)
    w = WORD.findall(text)
    places = [(i, label) for p, label in ls.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    base = {label for _, label in places}
    found = []
    far = max(len(re.findall("[0-9a-z]+", t.lower())) * 100 // ls.CONTAINMENT for _, t, *_ in ls.TEMPLATES)
    first_marks = {marks.split()[0] for *_, marks, _ in ls.TEMPLATES}
    for line in text.split("\n"):
        have = WORD.findall(line)
        blocks = [set(have)] if len(have) <= far else [set(have[max(0, i - far + 1):i + far]) for i, x in enumerate(have) if x in first_marks]
        for block in blocks:
            for (label, some), (*_, marks, rivals) in zip(ls.template_sets(), ls.TEMPLATES, strict=True):
                n = len(block & set(some))
                if 100 * n >= ls.CONTAINMENT * len(some) and set(marks.split()) <= block and not set(rivals.split()) & block:
                    found.append((n / len(some), label))
    score = 1.0 if base else max(found, default=(0.0,))[0]
    starts = [i for i, _ in places]
    return (doc, len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {label for _, label in found})), score)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = sorted((brute(r.doc_id, r.text) for r in rows), key=repr)
    assert got(op7_license_scan(spark, SF_SMALL)) == want
    assert any(r[2] for r in want)


def test_places_thresholds_and_edge_cases(spark):
    texts = [None, "", "!!", "cc by", "CC-BY cc by cc\nby", "xcc by cc byx", "mit license MIT\nLicense", "İ mit license ſ 文字",
             "under released the license", "released under the mit", "released under the",
             "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation",
             "word " * 4000 + "gnu general public license " * 3, "the Kelvin K license", "gnu\x85general public license",
             "licensed under the apache license version 2 0", "apache licenses", *["redistribution and use in source and binary forms with or "
             "without modification are permitted provided that the"] * 3]
    rows = [*enumerate(texts), (None, "apache license"), (3, "cc by")]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, row int, blocks string").repartition(3)
    assert got(ls.license_scan(docs)) == sorted((brute(d, t) for d, t in rows), key=repr)
    assert got(ls.license_scan(docs.limit(0))) == []


def test_filters_lose_no_block(spark):
    import random

    rng, words = random.Random(5), sorted({w for _, s in ls.template_sets() for w in s})
    rows = []
    for i in range(400):
        _, some = rng.choice(ls.template_sets())
        keep = [w for w in some if rng.random() < 0.85] + rng.sample(words, rng.randint(0, 4))
        rng.shuffle(keep)
        rows.append((i, " ".join(keep)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(ls.license_scan(docs)) == sorted((brute(d, t) for d, t in rows), key=repr)


def test_first_word_after_characters_beyond_the_bmp(spark):
    rows = [(0, "a " + "\U0001F600" * 6 + " mit license b"), (1, "\U0001F600 \U00020000 cc by x cc by"), (2, "\U0001F600")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(ls.license_scan(docs)) == sorted((brute(d, t) for d, t in rows), key=repr)


def test_wrapped_notices_count_like_one_line(spark):
    import textwrap

    rows = []
    for i, (_, text, *_) in enumerate(ls.TEMPLATES):
        rows.append((100 * i, text))
        for j, width in enumerate((12, 30, 72)):
            lines = textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False)
            rows.append((100 * i + 2 * j + 1, "some file\n\n" + "\n".join(" * " + x for x in lines) + "\n */\nint x;\n" + "y = 1\n" * 50))
            rows.append((100 * i + 2 * j + 2, "\n".join(lines)))
    found = {r.doc_id: set(r.labels.split(",")) for r in ls.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(ls.TEMPLATES[d // 100][0] in x for d, x in found.items())
    assert all(found[d] == found[d // 100 * 100] for d in found)


def test_marks_tell_templates_apart(spark):
    texts = {
        "This program is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation.": "gpl",
        "Released under the license of the museum": "",
        "The long grass hid it; then a hunter released a bird under the trees, and the license to hunt was void.": "",
        "This program is licensed under the GNU Affero General Public License, version 3.": "agpl",
        "mit " + "the words go on " * 30 + "released under the license": "",
        "word " * 100 + "released under the MIT License " + "word " * 100: "mit",
    }
    rows = list(enumerate(texts))
    got_labels = {r.doc_id: r.labels for r in ls.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got_labels[i] for i, _ in rows] == list(texts.values())
