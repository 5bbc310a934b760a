"""Byte-level BPE against the tiktoken library; decoding as an exact round trip."""

import hashlib

import numpy as np
import pytest
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paddock.llm import bpe, tokens
from paddock.llm.queries import PATTERN, RANKS, op5_byte_bpe

from ..conftest import SF_SMALL


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=tokens.ranks(RANKS), special_tokens={})


def check(rows, texts, library):
    want = sorted(((d, len(ids := library.encode_ordinary(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256((t or "").encode()).hexdigest()) for d, t in texts), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows), key=repr) == want


def test_query_against_the_library(spark, library):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(op5_byte_bpe(spark, SF_SMALL).collect(), texts, library)


def ids_of(df):
    return {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in df.collect()}


def test_every_code_point(spark, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + "".join(f"{chr(c)}b{chr(c)}{chr(c)} " for c in points[k:k + 2000]) for k in range(0, len(points), 2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    split = docs.select("doc_id", bpe.split_words(F.col("text"), PATTERN).alias("w"))
    got = ids_of(bpe.encode(docs, RANKS, PATTERN))
    assert {d: got[d] for d in got} == {d: library.encode_ordinary(t) for d, t in enumerate(texts)}
    assert all("".join(r.w) == texts[r.doc_id] for r in split.collect())


def test_nulls_empties_long_words_ties_and_clashing_columns(spark, library):
    texts = [(0, None), (1, ""), (2, "tie tie tie"), (3, "tie tie tie"), (None, "x"), (4, "a" * 3000), (5, " " * 700 + "b"),
             (6, "<|endoftext|> it's we'll ÀÉ 文字\x00\t\n\n    é \U0001F600 123456"), (7, "one " * 4000)]
    docs = spark.createDataFrame([(d, t, 1, "w") for d, t in texts], "doc_id long, text string, ids int, words string").repartition(3)
    from paddock.llm.queries import bpe_digests

    check(bpe_digests(docs).collect(), texts, library)
    assert bpe_digests(docs.limit(0)).collect() == []
    for style in ("task", "native"):  # a chunk for every document or two
        few = bpe.decode(bpe.encode(docs, RANKS, PATTERN, limit=5, style=style), RANKS).collect()
        assert sorted((bytes(r.decoded) for r in few)) == sorted((t or "").encode() for _, t in texts)
        assert sorted(np.frombuffer(bytes(r.ids), "<u4").tolist() for r in few) == sorted(library.encode_ordinary(t or "") for _, t in texts)


@given(st.binary(min_size=1, max_size=200) | st.text("ab the in", min_size=1, max_size=300).map(str.encode))
@settings(max_examples=300, deadline=None)
def test_folds_against_the_library(library, word):
    rank = tokens.ranks(RANKS)
    assert bpe.fold_word(word, rank) == library._core_bpe.encode_single_piece(word)
    assert rank.get(word) is not None or bpe._fold_long(word, rank) == library._core_bpe.encode_single_piece(word)


@given(words=st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), min_size=1, max_size=24) | st.text("abcdeinorst ", min_size=1, max_size=24),
                      min_size=1, max_size=40))
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_higher_order_fold_against_the_library(spark, library, words):
    ranks = bpe.rank_literal(spark, RANKS)
    df = spark.createDataFrame([([w.encode().decode("latin-1") for w in words],)], "words array<string>")
    got = df.select(bpe.encode_words(F.col("words"), ranks).alias("ids")).first().ids
    assert got == [library._core_bpe.encode_single_piece(w.encode()) for w in words]
