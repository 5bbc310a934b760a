"""Packing: the plan against its bounds, ids against the tokenizers library, placement against brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paddock.llm import packing, tokens
from paddock.llm.queries import PATTERN, RANKS, op1_best_fit_packing, pack_digests

from ..conftest import SF_SMALL


@given(st.lists(st.integers(1, 64), max_size=200))
@settings(max_examples=80, deadline=None)
def test_plan_covers_the_histogram_and_never_overfills(lengths):
    patterns = packing.plan(Counter(lengths), 64)
    used = Counter()
    for many, n in patterns:
        assert n > 0 and sum(many) <= 64
        for x in many:
            used[x] += n
    assert used == Counter(lengths)


def best_fit_decreasing(lengths, capacity):
    """One by one, into the fullest sequence that still takes it."""
    gaps = []
    for x in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - x)
    return len(gaps)


@given(st.lists(st.integers(1, 40), max_size=120))
@settings(max_examples=80, deadline=None)
def test_plan_is_never_above_best_fit_nor_below_its_bound(lengths):
    histogram = Counter(lengths)
    want = best_fit_decreasing(lengths, 40)
    assert sum(n for _, n in packing.best_fit(histogram, 40)) == want
    assert packing.least_sequences(histogram, 40) <= sum(n for _, n in packing.plan(histogram, 40)) <= want


def test_plan_fills_exact_combinations():
    assert sum(n for _, n in packing.plan({64: 3, 40: 2, 24: 2, 30: 1, 20: 1, 14: 1}, 64)) == 6
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 1025, 20_000)
    n = sum(k for _, k in packing.plan(Counter(lengths.tolist())))
    least = max(-(-int(lengths.sum()) // 1024), int((lengths > 512).sum()))
    assert n <= 1.02 * least


@pytest.fixture(scope="module")
def slow():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_tokenizers_library_over_every_code_point(slow):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + "".join(f"{chr(c)}b{chr(c)}{chr(c)} " for c in points[k:k + 400]) for k in range(0, len(points), 400)]
    encode = tokens.encoder(RANKS, PATTERN).encode_ordinary
    assert [encode(t) for t in texts] == [e.ids for e in slow.encode_batch_fast(texts, add_special_tokens=False)]


def brute(rows, slow):
    want = {}
    for doc, text in rows:
        ids = slow.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        ends = range(first, len(ids) + 1, 1024)
        for k, end in enumerate(ends):
            begin = max(0, end - 1024)
            want[doc, k] = (begin, end - begin, zlib.crc32(np.array(ids[begin:end], "<u4").tobytes()))
    return want


def check(got, rows, slow):
    want = brute(rows, slow)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by)


def test_query_against_brute_force(spark, slow):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    n = check(op1_best_fit_packing(spark, SF_SMALL).collect(), rows, slow)
    total = sum(x[1] for x in brute(rows, slow).values())
    assert n <= 1.1 * -(-total // 1024)


def test_nulls_empties_long_texts_ties_and_clashing_columns(spark, slow):
    rows = [(1, None), (2, ""), (3, "word " * 5000), (4, "tie"), (5, "tie"), (6, "ß 文字 <|endoftext|>")]
    docs = spark.createDataFrame([(i, t, 7, "x", 1.0) for i, t in rows],
                                 "doc_id long, text string, part int, ids string, sequence_id double").repartition(3)
    assert check(pack_digests(docs).collect(), rows, slow) == -(-(sum(x[1] for x in brute(rows, slow).values())) // 1024)
    twice = pack_digests(docs.where("doc_id is null or doc_id = 4").unionAll(docs.selectExpr("null", "text", "part", "ids", "sequence_id"))).collect()
    assert len({(r.sequence_id, r.offset) for r in twice}) == len(twice)
    assert pack_digests(docs.limit(0)).collect() == []


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, "some words here " * (i * 37)) for i in range(20)], "doc_id long, text string")
    packed = packing.pack(docs, RANKS, PATTERN)
    rows = {(r.doc_id, r.piece): r for r in packed.collect()}
    for s in packing.sequences(packed).collect():
        ids = b"".join(bytes(rows[d, p].ids) for d, p, _ in s.pieces)
        assert ids == bytes(s.ids) and len(ids) <= 4096
