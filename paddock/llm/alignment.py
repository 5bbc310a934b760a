"""Alignment of two tokenizers' tokens over the same bytes, for all documents of a block at once.

Lockstep vectorised merging.  A block of documents is encoded by both tokenizers; token ends are byte offsets.  One NumPy
state vector holds, for every document still under way, a pointer into its A tokens and one into its B tokens.  Each
step emits the link (A token, B token) at the pointers, advances the one that ends first, or both where they end
together, which is a cut, and leaves finished documents out of the vector.  A long document takes part as several
lanes of at most ``LANE`` A tokens (a lane's B pointer is found by binary search for the byte it starts at), so no step
works for a lone document.  Links are therefore all pairs whose byte ranges overlap: ``n_a + n_b - n_groups`` of them.

Corpus counts.  A block of about ``BLOCK_CHARS`` characters keeps its distinct id pairs with their counts, and its links as
places in that list.  Pairs are added up by an aggregation; a pair's count, and whether it is its B id's highest, comes
back to the blocks by a join of distinct pairs, so a pair that stands in every document travels once a block, and nothing
that grows with the corpus is broadcast.

Defined results
* a null or empty text has no tokens; nor has one whose bytes a tokenizer doesn't give back (say, with U+2581, which B's
  pieces use for the space): counts 0, empty lists, and '' as digest;
* strings of special tokens are plain text; null ids and repeated rows have results of their own;
* very long texts are encoded whole by A; by B word by word, which no piece of its vocabulary spans (checked
  when it is loaded; otherwise whole);
* columns other than id and text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm import tokens
from paddock.llm.common import materialise

LANE = 256                # A tokens of a lane at most
BLOCK_CHARS = 1 << 20     # characters of a block; a document is never split over blocks
SPACE = "▁"          # fixed value: B's sign for the space


@lru_cache(maxsize=2)
def piece_model(path: str) -> tuple[object, list[bytes], bool]:
    """The encoder, the bytes of every piece, and whether no piece goes on beyond a word's end."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    raw = [bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace(SPACE, " ").encode() for i, name in enumerate(names)]
    return model, raw, all(SPACE not in name.lstrip(SPACE) for name in names)


@lru_cache(maxsize=2)
def rank_bytes(path: str) -> list[bytes]:
    ranks = tokens.ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


_WORD_END = re.compile("(?<=[^ ]) (?=[^ ])")


def words_of(text: str, separable: bool) -> list[str]:
    """What B encodes at a time: a text is cut before single spaces, which the encoder adds again to what follows."""
    if not separable:
        return [text]
    return text.split(" ") if "  " not in text and text[0] != " " and text[-1] != " " else _WORD_END.split(text)


def encode_pieces(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """B's ids of some texts one after the other, and how many each has; none where the pieces don't give the text back.
    Every distinct word of the texts is encoded once."""
    model, raw, separable = piece_model(path)
    words = [words_of(t, separable) for t in texts]
    of_text = np.repeat(np.arange(len(texts)), [len(w) for w in words])
    code, distinct = pd.factorize(np.array([w for some in words for w in some], object))
    coded = model.encode(list(distinct), num_threads=1) if len(distinct) else []
    size = np.fromiter(map(len, coded), np.int64, len(coded))
    flat = np.fromiter(chain.from_iterable(coded), np.int32, int(size.sum()))
    good = np.fromiter((b"".join(map(raw.__getitem__, ids)) == b" " + w.encode() for ids, w in zip(coded, distinct, strict=True)), bool, len(coded))
    sound = np.ones(len(texts), bool)
    sound[of_text[~good[code]]] = False
    code, of_text = code[sound[of_text]], of_text[sound[of_text]]
    many = size[code]
    upto = np.cumsum(many) - many
    ids = flat[np.repeat((np.cumsum(size) - size)[code] - upto, many) + np.arange(int(many.sum()))]
    return ids, np.bincount(of_text, weights=many, minlength=len(texts)).astype(np.int64)


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (``i``, ``j``) of A and B tokens, in order, and whether both end there (``cut``).

    ``a_end`` and ``b_end`` ascend over all documents, which hold the same bytes in A and B; a document's A tokens start at
    ``a_from``."""
    if not len(a_from):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    upto = np.append(a_from[1:], len(a_end))
    first = np.concatenate([np.arange(x, y, lane) for x, y in zip(a_from.tolist(), upto.tolist(), strict=True)])
    i = first.astype(np.int64)
    stop = np.append(i[1:], len(a_end))
    j = np.searchsorted(b_end, np.concatenate([[0], a_end])[i], "right")
    of, found = np.arange(len(i)), []
    while len(i):
        x, y = a_end[i], b_end[j]
        found.append((of, i, j, x == y))
        i, j = i + (x <= y), j + (y <= x)
        going = i < stop
        if not going.all():
            i, j, of, stop = i[going], j[going], of[going], stop[going]
    # Lane after lane: a link's place is its lane's first one plus its step.
    lanes = np.concatenate([f[0] for f in found])
    steps = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
    many = np.bincount(lanes)
    at = (np.cumsum(many) - many)[lanes] + steps
    out = []
    for k in (1, 2, 3):
        flat = np.concatenate([f[k] for f in found])
        out.append(np.empty_like(flat))
        out[-1][at] = flat
    return tuple(out)


@dataclass
class Block:
    """Documents side by side: ids of all A and B tokens, links and group ends (numbers in the block), and where each
    document's begin and end (``*_at``, one more than documents)."""
    ids: pa.Array
    a: np.ndarray
    b: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray
    i: np.ndarray
    j: np.ndarray
    link_at: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    group_at: np.ndarray


def align_block(ids: pa.Array, texts: list[str | None], ranks_path: str, pattern: str, pieces_path: str, lane: int = LANE) -> Block:
    encode = tokens.encoder(ranks_path, pattern).encode_ordinary
    a_size, b_size = (np.fromiter(map(len, raw), np.int64, len(raw)) for raw in (rank_bytes(ranks_path), piece_model(pieces_path)[1]))
    full = [k for k, text in enumerate(texts) if text]
    b, n_b = np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    if full:
        b, n_b[full] = encode_pieces([texts[k] for k in full], pieces_path)
    a = []
    for k, text in enumerate(texts):
        # A's tokens are pieces of the bytes themselves, so their lengths tell whether all are there.
        x = np.array(encode(" " + text) if n_b[k] else [], np.int32)
        if n_b[k] and a_size[x].sum() != len(text.encode()) + 1:
            raise ValueError("the rank file's pattern leaves out some of a text")
        a.append(x)
    a_at, b_at = (np.concatenate([[0], np.cumsum(n)]).astype(np.int64) for n in ([len(x) for x in a], n_b))
    a = np.concatenate([*a, np.empty(0, np.int32)])
    held = a_at[:-1][a_at[1:] > a_at[:-1]]
    i, j, cut = lockstep(np.cumsum(a_size[a]), np.cumsum(b_size[b]), held, lane)
    group_a, group_b = i[cut] + 1, j[cut] + 1
    return Block(ids, a, b, a_at, b_at, i, j, np.searchsorted(i, a_at), group_a, group_b, np.searchsorted(group_a, a_at, "right"))


def blocks(batches: Iterator[pa.RecordBatch], limit: int, *paths: str, lane: int = LANE) -> Iterator[Block]:
    """Blocks of whole documents (``doc_id``, ``text``) with about ``limit`` characters."""
    ids, texts, size = [], [], 0
    for batch in batches:
        begin = 0
        for k, text in enumerate(batch.column(1).to_pylist()):
            texts.append(text)
            size += len(text or "")
            if size >= limit or k + 1 == batch.num_rows:
                ids.append(batch.column(0).slice(begin, k + 1 - begin))
                begin = k + 1
            if size >= limit:
                yield align_block(pa.concat_arrays(ids), texts, *paths, lane=lane)
                ids, texts, size = [], [], 0
    if texts:
        yield align_block(pa.concat_arrays(ids), texts, *paths, lane=lane)


def align(docs: DataFrame, ranks_path: str, pattern: str, pieces_path: str, limit: int = BLOCK_CHARS, lane: int = LANE,
          id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``a_ids``, ``b_ids``; ``groups_a`` and ``groups_b``, how many tokens up to each cut; and
    the links as token numbers from 0, ``links_a`` and ``links_b``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    ints = T.ArrayType(T.IntegerType())
    out = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType),
                        *[T.StructField(n, ints) for n in ("a_ids", "b_ids", "groups_a", "groups_b", "links_a", "links_b")]])

    def lists(flat: np.ndarray, at: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k in blocks(batches, limit, ranks_path, pattern, pieces_path, lane=lane):
            groups, links = np.diff(k.group_at), np.diff(k.link_at)
            own_a, own_b = k.a_at[:-1], k.b_at[:-1]
            yield pa.RecordBatch.from_arrays(
                [k.ids, lists(k.a, k.a_at), lists(k.b, k.b_at),
                 lists(k.group_a - np.repeat(own_a, groups), k.group_at), lists(k.group_b - np.repeat(own_b, groups), k.group_at),
                 lists(k.i - np.repeat(own_a, links), k.link_at), lists(k.j - np.repeat(own_b, links), k.link_at)], names=out.names)

    return rows.mapInArrow(run, out)


@lru_cache(maxsize=2)
def _written(size: int) -> np.ndarray:
    """Ids below ``size`` in decimal with what follows them in a digest, padded with zero bytes."""
    return np.array([f"{i}{after}" for after in ",|;" for i in range(size)], np.bytes_)


def _digests(k: Block, size: int) -> list[str]:
    """SHA-256 of every document's groups, written ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
    written, number = _written(size), np.arange(len(k.group_a))
    len_a, len_b = (np.diff(g, prepend=0) for g in (k.group_a, k.group_b))
    of_a, of_b = np.repeat(number, len_a), np.repeat(number, len_b)
    after_a, after_b = np.zeros(len(k.a), np.int64), np.zeros(len(k.b), np.int64)
    after_a[k.group_a - 1], after_b[k.group_b - 1] = size, 2 * size
    row = np.empty(len(k.a) + len(k.b), np.int64)
    row[np.arange(len(k.a)) + (k.group_b - len_b)[of_a]] = k.a + after_a
    row[np.arange(len(k.b)) + k.group_a[of_b]] = k.b + after_b
    at = (k.a_at + k.b_at).tolist()
    return [hashlib.sha256(written[row[x:y]].tobytes().translate(None, b"\0")[:-1]).hexdigest() if y > x else ""
            for x, y in zip(at[:-1], at[1:], strict=True)]


def link_blocks(docs: DataFrame, ranks_path: str, pattern: str, pieces_path: str, limit: int = BLOCK_CHARS) -> DataFrame:
    """One row per block: its number ``block``, its documents' counts and digests, its distinct id pairs ``a``, ``b``, ``n``, and the
    place of every link's pair in that list (``links``, little-endian, of 16 bits if the list is short enough, else 32)."""
    rows = docs.select("doc_id", "text")
    longs, ints = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    counted = ["n_a", "n_b", "n_groups", "n_links"]
    out = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(rows.schema["doc_id"].dataType)),
                        *[T.StructField(n, longs) for n in counted], T.StructField("groups_sha256", T.ArrayType(T.StringType())),
                        T.StructField("a", ints), T.StructField("b", ints), T.StructField("n", longs), T.StructField("links", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(len(rank_bytes(ranks_path)), len(piece_model(pieces_path)[1]))
        block = TaskContext.get().partitionId() << 33
        for k in blocks(batches, limit, ranks_path, pattern, pieces_path):
            place, pairs = pd.factorize(k.a[k.i].astype(np.int64) << 32 | k.b[k.j])
            many = np.bincount(place, minlength=len(pairs))
            one = lambda values, kind: pa.array([values], pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(k.ids)], pa.int32()), k.ids),
                 *[one(np.diff(at), pa.int64()) for at in (k.a_at, k.b_at, k.group_at, k.link_at)],
                 one(_digests(k, size), pa.string()),
                 one(pairs >> 32, pa.int32()), one(pairs & 0xFFFFFFFF, pa.int32()), one(many, pa.int64()),
                 pa.array([place.astype("<u2" if len(pairs) <= 1 << 16 else "<u4").tobytes()], pa.binary())], names=out.names)
            block += 1

    return rows.mapInArrow(run, out)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(``a``, ``b``, ``count``, ``best``) of every id pair: its links in the whole corpus, and whether no A id has more with this B id."""
    counts = materialise(pairs.sparkSession, pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def link_scores(docs: DataFrame, ranks_path: str, pattern: str, pieces_path: str, limit: int = BLOCK_CHARS,
                id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose pair is its B id's most
    frequent in the corpus), ``count_sum`` (of the pairs' counts over links), ``groups_sha256``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    found = materialise(spark, link_blocks(rows, ranks_path, pattern, pieces_path, limit), "link-blocks")
    pairs = found.select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("at", "p")).select("block", "at", "p.a", "p.b", "p.n")
    known = pairs.select("block", "at", "a", "b").join(pair_counts(pairs), ["a", "b"]).select(F.col("block").alias("in_block"), "at", "count", "best")
    id_type = rows.schema["doc_id"].dataType
    out = T.StructType([T.StructField("doc_id", id_type), *[T.StructField(n, T.LongType()) for n in
                        ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], T.StructField("groups_sha256", T.StringType())])

    def score(block: pa.Table, known: pa.Table) -> pa.Table:
        """One block, a row of its own, and its pairs, in any order: as many as it has links at most."""
        of = {name: block.column(name).combine_chunks() for name in block.schema.names}
        flat = {name: of[name].flatten() for name in ("ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        counts, bests = np.zeros(known.num_rows, np.int64), np.zeros(known.num_rows, np.int64)
        at = known.column("at").to_numpy()
        counts[at], bests[at] = known.column("count").to_numpy(), known.column("best").to_numpy()
        upto = np.concatenate([[0], np.cumsum(flat["n_links"].to_numpy())])
        links = of["links"][0].as_py()
        place = np.frombuffer(links, "<u2" if len(links) == 2 * upto[-1] else "<u4")
        n_best, count_sum = (np.diff(np.concatenate([[0], np.cumsum(v[place])])[upto]) for v in (bests, counts))
        return pa.table([flat["ids"], flat["n_a"], flat["n_b"], flat["n_groups"], flat["n_links"], pa.array(n_best, pa.int64()),
                         pa.array(count_sum, pa.int64()), flat["groups_sha256"]], names=out.names)

    held = found.select("block", "ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    return held.groupBy("block").cogroup(known.groupBy("in_block")).applyInArrow(score, out)
