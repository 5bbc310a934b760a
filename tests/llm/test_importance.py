"""Importance resampling against a direct computation, and its defined results."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from paddock.llm import importance

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, n_min, n_max):
    words = WORD.findall((text or "").translate(AZ))
    return len(words), [" ".join(words[i:i + n]) for n in range(n_min, n_max + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, n_min=1, n_max=1, buckets=10_000, min_words=20, percent=10):
    code = lambda g: zlib.crc32(g.encode()) % buckets
    s = Counter(code(g) for _, t in docs for g in grams(t, n_min, n_max)[1])
    t = Counter(code(g) for x in target for g in grams(x, n_min, n_max)[1])
    size_s, size_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (size_s + buckets) / ((s[b] + 1) * (size_t + buckets)))) for b in range(buckets)]
    rows = []
    for d, text in docs:
        n, found = grams(text, n_min, n_max)
        weight = sum(gain[code(g)] for g in found)
        score = None
        if d is not None:
            h = int(hashlib.sha256(f"2024:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([d, len(found), weight, score, None, n])
    fit = sorted((r for r in rows if r[5] >= min_words and r[3] is not None), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(fit[:percent * len(fit) // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


DOCS = [(i, f"Alpha{i % 7} beta, GAMMA-{i % 5} delta " * (1 + i % 9) + "naïve Ünder 東京 x" * (i % 3)) for i in range(120)]
TARGET = ["alpha1 beta gamma delta", "naïve Ünder", None, ""]


@pytest.mark.parametrize(("n_min", "n_max", "buckets"), [(1, 1, 10_000), (1, 3, 10_000), (2, 2, 100_000)])
def test_against_brute_force(spark, n_min, n_max, buckets):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert got(importance.resample(docs, target, n_min=n_min, n_max=n_max, buckets=buckets)) == brute(DOCS, TARGET, n_min, n_max, buckets)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    long = " ".join(f"w{i % 500}" for i in range(200_000))
    rows = [(1, None), (2, ""), (3, " ., \x00\x1f"), (4, "a b"), (None, "a b " * 20), (5, long), (6, "same word " * 30),
            (6, "same word " * 30), (7, "Éa éA " * 15), (8, "0 9 z~{ `a" * 9)]
    docs = spark.createDataFrame([(d, t, 1, "q", 2) for d, t in rows], "doc_id long, text string, rank int, weight string, at int").repartition(3)
    target = spark.createDataFrame([("same word", 3)], "text string, doc_id int")
    assert got(importance.resample(docs, target, percent=60)) == brute(rows, ["same word"], percent=60)
    assert got(importance.resample(docs.limit(0), target)) == []
    assert got(importance.resample(docs, target.limit(0), percent=100)) == brute(rows, [], percent=100)


def test_ranks_of_a_score_that_most_rows_share(spark):
    rows = [(0, "x y " * 20)] * 300 + [(i, "x y " * 20) for i in range(1, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = importance.resample(docs, spark.createDataFrame([("x",)], "text string"), percent=100).collect()
    assert sorted(r["rank"] for r in found) == list(range(1, len(rows) + 1))
    assert len({r["rank"] for r in found if r["doc_id"] == 0}) == 300


def test_spans_overlap():
    words = importance.collapse("  The, quick\tbrown--FOX ")
    assert words == b"the quick brown fox"
    found = [m.span() for m in importance.gram_pattern(2).finditer(words, overlapped=True)]
    assert [words[a:b] for a, b in found] == [b"the quick", b"quick brown", b"brown fox"]
