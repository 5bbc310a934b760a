"""Byte-level BPE: ranked merges folded over the bytes of distinct words; decoding by concatenating pieces.

Texts are split by the tokenizer's pattern in Spark.  A task takes documents in chunks of bounded size: the
distinct words of a chunk and, for each document, which of them follow each other — so a word that stands a
thousand times in a chunk is encoded once, and nothing is shuffled.  A fold over a word's bytes then applies
ranked merges: each step merges the pair of the lowest rank (the leftmost among equals).

The fold comes in two forms with the same results.  ``encode_words`` is a Spark higher-order function over the
words, with the rank map as a literal (tokens in hashed buckets, so a lookup compares with one or two
entries; bytes are characters of the same number, ISO-8859-1, because the keys are strings).  Measured, it takes
2,200 CPU seconds a GB, so ``encode`` folds in Python inside the tasks; ``style="native"`` asks for the former.

Defined results
* null text is empty: no ids, no bytes; special tokens' strings are ordinary text;
* repeated rows and null ids have results of their own; columns other than id and text are not read;
* an empty table gives an empty result; a word of n bytes takes at most n steps.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm import tokens

BUCKETS = 1 << 16
NONE = (1 << 31) - 1      # rank of a pair that is no token
CHUNK_WORDS = 1_000_000   # words of a chunk; a document is never cut


def rank_literal(spark: SparkSession, ranks_path: str) -> Column:
    """The rank file as one literal: buckets of {token: rank}, a token's bucket being its hash."""
    ranks = tokens.ranks(ranks_path)
    keys = spark.createDataFrame([(t.decode("latin-1"),) for t in ranks], "token string")
    of = {r["token"]: r["bucket"] for r in keys.select("token", bucket(F.col("token")).alias("bucket")).collect()}
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        key = token.decode("latin-1")
        buckets[of[key] - 1][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def bucket(token: Column) -> Column:
    return (F.xxhash64(token).bitwiseAND(F.lit(BUCKETS - 1)) + 1).cast("int")


def split_words(text: Column, pattern: str) -> Column:
    """The pattern's matches.  White space is as in Unicode; in the rare text with code points that the JVM's tables
    don't know, letters and numbers are listed (as the tokenizer's own tables have them), which is far slower."""
    space = r"\x09-\x0D\x{85}\p{Z}"
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{space}\p{{L}}\p{{N}}]").replace(r"\s", f"[{space}]").replace(r"\S", f"[^{space}]")
    listed = (plain.replace(rf"[^{space}\p{{L}}\p{{N}}]", f"[^{space}{ranges('L')}{ranges('N')}]")
              .replace(r"\p{L}+", f"[{ranges('L')}]+").replace(r"\p{N}+", f"[{ranges('N')}]+"))
    return F.when(text.rlike(r"\p{Cn}"), F.regexp_extract_all(text, F.lit(listed), F.lit(0))).otherwise(
        F.regexp_extract_all(text, F.lit(plain), F.lit(0)))


@lru_cache(maxsize=4)
def ranges(name: str) -> str:
    """Code points that the tokenizer's own regular expressions count to a general category, as the inside of a
    character class."""
    import tiktoken

    match = tiktoken.Encoding("class", pat_str=rf"\p{{{name}}}+", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    found = np.array([ord(c) for c in match.decode(match.encode_ordinary(points))])
    runs = np.split(found, np.flatnonzero(np.diff(found) > 1) + 1)
    return "".join(f"\\x{{{r[0]:X}}}-\\x{{{r[-1]:X}}}" for r in runs)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def encode_word(word: Column, ranks: Column) -> Column:
    """Ids of a word whose bytes are the characters of a string."""
    def rank(token: Column) -> Column:
        return F.element_at(F.element_at(ranks, bucket(token)), token)

    def pair(token: Column) -> Column:
        return F.coalesce(rank(token), F.lit(NONE))

    def merge(state: Column, at: Column) -> Column:
        """Pieces ``at`` and ``at + 1`` become one; ranks ``at - 1`` and ``at + 1`` are those of its new neighbours."""
        p, r = state["p"], state["r"]
        n = F.size(p)

        def put(one: Column) -> Column:
            before = F.when(at > 1, F.array(pair(F.concat(F.element_at(p, at - 1), one)))).otherwise(F.array().cast("array<int>"))
            after = F.when(at + 2 <= n, F.array(pair(F.concat(one, F.element_at(p, at + 2))))).otherwise(F.array().cast("array<int>"))
            return F.struct(
                F.concat(F.slice(p, F.lit(1), at - 1), F.array(one), F.slice(p, at + 2, n)).alias("p"),
                F.concat(F.slice(r, F.lit(1), F.greatest(at - 2, F.lit(0))), before, after, F.slice(r, at + 2, n)).alias("r"))

        return let(F.concat(F.element_at(p, at), F.element_at(p, at + 1)), put)

    def step(state: Column, _: Column) -> Column:
        low = F.array_min(state["r"])
        return F.when(F.coalesce(low, F.lit(NONE)) == NONE, state).otherwise(
            let(F.array_position(state["r"], low).cast("int"), lambda at: merge(state, at)))

    n = F.length(word)
    first = F.struct(F.split(word, "").alias("p"),
                     F.transform(F.sequence(F.lit(1), n - 1), lambda i: pair(F.substring(word, i, F.lit(2)))).alias("r"))
    folded = F.aggregate(F.sequence(F.lit(1), n - 1), first, step, lambda state: F.transform(state["p"], rank))
    return F.when(rank(word).isNotNull(), F.array(rank(word))).otherwise(folded)


def encode_words(words: Column, ranks: Column) -> Column:
    """Ids of every word; the literal stands in the plan once."""
    return let(ranks, lambda literal: F.transform(words, lambda word: encode_word(word, literal)))


def fold_word(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of a word: its bytes, and merges of the lowest-ranked pair until there is none."""
    known = rank.get(word)
    if known is not None:
        return [known]
    if len(word) > 64:
        return _fold_long(word, rank)
    pieces = [word[i:i + 1] for i in range(len(word))]
    pairs = [rank.get(word[i:i + 2], NONE) for i in range(len(word) - 1)]
    while pairs and (low := min(pairs)) != NONE:
        at = pairs.index(low)
        one = pieces[at] + pieces[at + 1]
        pieces[at:at + 2] = [one]
        del pairs[at]
        if at:
            pairs[at - 1] = rank.get(pieces[at - 1] + one, NONE)
        if at < len(pairs):
            pairs[at] = rank.get(one + pieces[at + 1], NONE)
    return [rank[p] for p in pieces]


def _fold_long(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """The same merges for a long word, from a heap of pairs: n log n steps."""
    n = len(word)
    end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(word[i:i + 2], NONE)) != NONE]
    heapq.heapify(heap)
    while heap:
        _, at, to = heapq.heappop(heap)
        after = right[at]
        if end[at] < 0 or after >= n or end[after] != to:
            continue  # one of the two has been merged meanwhile
        end[at], right[at], end[after] = to, right[after], -1
        if right[at] < n:
            left[right[at]] = at
            if (r := rank.get(word[at:end[right[at]]], NONE)) != NONE:
                heapq.heappush(heap, (r, at, end[right[at]]))
        if left[at] >= 0 and (r := rank.get(word[left[at]:to], NONE)) != NONE:
            heapq.heappush(heap, (r, left[at], to))
    return [rank[word[i:end[i]]] for i in range(n) if end[i] > 0]


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, list[str]]]:
    """Of runs of whole documents with about ``limit`` words: ids, word counts, word numbers one after the other, and
    the distinct words."""
    def chunk(some: list[pa.RecordBatch]) -> tuple[pa.Array, np.ndarray, np.ndarray, list[str]]:
        words = pa.concat_arrays([b.column(1).flatten().cast(pa.string()) for b in some]).dictionary_encode()
        return (pa.concat_arrays([b.column(0) for b in some]),
                np.concatenate([b.column(1).value_lengths().to_numpy() for b in some]).astype(np.int32),
                words.indices.to_numpy(), words.dictionary.to_pylist())

    held, words = [], 0
    for batch in batches:
        many, at = np.cumsum(batch.column(1).value_lengths().to_numpy()), 0
        while at < batch.num_rows:  # as many documents as fit, one at least
            before = many[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(many, before + limit - words, "right")))
            held.append(batch.slice(at, end - at))
            words += int(many[end - 1] - before)
            at = end
            if words >= limit or at < batch.num_rows:
                yield chunk(held)
                held, words = [], 0
    if held:
        yield chunk(held)


def _documents(ids: pa.Array, counts: np.ndarray, codes: np.ndarray, size: np.ndarray, flat: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Ids of every document of a chunk, from those of its distinct words (``size`` each, in ``flat``)."""
    start = np.cumsum(size) - size
    ends = np.concatenate([[0], np.cumsum(counts)])
    for a in range(0, len(ids), 256):  # some documents at a time
        b = min(a + 256, len(ids))
        some = codes[ends[a]:ends[b]]
        many = size[some]
        upto = np.concatenate([[0], np.cumsum(many)])
        got = flat[np.repeat(start[some] - upto[:-1], many) + np.arange(upto[-1])]
        cut = upto[ends[a:b + 1] - ends[a]]
        yield pa.RecordBatch.from_arrays(
            [ids.slice(a, b - a), pa.array([got[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary())],
            names=["doc_id", "ids"])


def encode(docs: DataFrame, ranks_path: str, pattern: str, limit: int = CHUNK_WORDS, id_col: str = "doc_id",
           text: str = "text", style: str = "task") -> DataFrame:
    """One row per document: ``doc_id`` and ``ids``, little-endian unsigned 32-bit integers."""
    rows = docs.select(F.col(id_col).alias("doc_id"), split_words(F.coalesce(F.col(text), F.lit("")), pattern).alias("words"))
    id_type = rows.schema["doc_id"].dataType
    out = T.StructType([T.StructField("doc_id", id_type), T.StructField("ids", T.BinaryType())])
    if style == "native":
        return _encode_native(rows, rank_literal(docs.sparkSession, ranks_path), limit, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = tokens.ranks(ranks_path)
        for ids, counts, codes, words in _chunks(batches, limit):
            pieces = [fold_word(w.encode(), rank) for w in words]
            size = np.fromiter(map(len, pieces), np.int64, len(pieces))
            flat = np.fromiter((i for p in pieces for i in p), np.dtype("<u4"), int(size.sum()))
            yield from _documents(ids, counts, codes, size, flat)

    return rows.mapInArrow(run, out)


def _encode_native(rows: DataFrame, ranks: Column, limit: int, out: T.StructType) -> DataFrame:
    """The fold as a higher-order function: tasks make chunks, Spark encodes their words, tasks put documents together."""
    schema = T.StructType([T.StructField("ids", T.ArrayType(out["doc_id"].dataType)), T.StructField("counts", T.BinaryType()),
                           T.StructField("codes", T.BinaryType()), T.StructField("words", T.ArrayType(T.StringType()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, counts, codes, words in _chunks(batches, limit):
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([counts.tobytes()], pa.binary()),
                 pa.array([codes.astype(np.int32).tobytes()], pa.binary()),
                 pa.array([[w.encode().decode("latin-1") for w in words]], pa.list_(pa.string()))], names=schema.names)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                one = batch.slice(r, 1)
                pieces = one.column(3).flatten()
                yield from _documents(one.column(0).flatten(), np.frombuffer(one.column(1)[0].as_py(), np.int32),
                                      np.frombuffer(one.column(2)[0].as_py(), np.int32),
                                      pieces.value_lengths().to_numpy().astype(np.int64), pieces.flatten().to_numpy().astype("<u4"))

    coded = rows.mapInArrow(cut, schema).select("ids", "counts", "codes", encode_words(F.col("words"), ranks).alias("pieces"))
    return coded.mapInArrow(put, out)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (``doc_id``, ``ids``) with ``decoded``, the bytes of the ids' tokens one after the other."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = tokens.ranks(ranks_path)
        piece = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            piece[rank] = token
        for batch in batches:
            texts = [b"".join(map(piece.__getitem__, np.frombuffer(ids, "<u4").tolist())) for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=schema.names)

    return encoded.mapInArrow(run, schema)
