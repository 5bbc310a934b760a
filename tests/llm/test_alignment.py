"""Alignment of two tokenizers against a brute-force comparison of byte ranges."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from paddock.llm import alignment
from paddock.llm.queries import PATTERN, PIECES, RANKS, op13_token_alignment

from ..conftest import SF_SMALL

TEXTS = ["", None, " ", "a", "Hello, world!  Two  spaces", "<|endoftext|> <s> </s> <unk> <0x41> \x00", "no▁give", "naïve 東京 😀 ́x", "\n\n\tcode(x) {\n  y;\n}",
         "a" * 300, "the cat " * 40, " lead and trail ", "x\r\ny\x85z", "1234567 3.14159"]


def byte_decoder():
    """Byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in plain):
        out[chr(256 + n)] = b
    return out


def token_bytes(texts):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    of = byte_decoder()
    for text in texts:
        x, y = [], []
        if text:
            x = [(i, bytes(of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
            y = [(i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode())
                 for i in b.encode(text) for p in [b.id_to_piece(i)]]
            whole = (" " + text).encode()
            if b"".join(t for _, t in x) != whole or b"".join(t for _, t in y) != whole:
                x, y = [], []
        yield x, y


def spans(parts):
    at, out = 0, []
    for i, raw in parts:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(rows):
    found = []
    for (d, _), (x, y) in zip(rows, token_bytes(t for _, t in rows), strict=True):
        x, y = spans(x), spans(y)
        links = [(i, j) for i, s, e in x for j, u, v in y if s < v and u < e]
        cuts = sorted({e for _, _, e in x} & {v for _, _, v in y})
        groups = [(",".join(str(i) for i, s, e in x if a <= s < c), ",".join(str(j) for j, s, e in y if a <= s < c))
                  for a, c in zip([0, *cuts], cuts, strict=False)]
        text = ";".join(f"{p}|{q}" for p, q in groups)
        found.append((d, len(x), len(y), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    count = Counter(link for f in found for link in f[4])
    most = {}
    for (_, j), n in count.items():
        most[j] = max(n, most.get(j, 0))
    return sorted(((d, a, b, g, len(links), sum(count[k] == most[k[1]] for k in links), sum(count[k] for k in links), sha)
                   for d, a, b, g, links, sha in found), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limit", [alignment.BLOCK_CHARS, 50])
def test_counts_and_digests_against_brute_force(spark, limit):
    rows = [*enumerate(TEXTS), (None, "the cat"), (3, "a"), (3, "a")]
    docs = spark.createDataFrame([(d, t, 1, "q") for d, t in rows], "doc_id long, text string, block int, links string").repartition(3)
    assert got(alignment.link_scores(docs, RANKS, PATTERN, PIECES, limit)) == brute(rows)
    assert got(alignment.link_scores(docs.limit(0), RANKS, PATTERN, PIECES)) == []


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    few = [tuple(r) for r in docs if len(r.text or "") < 1500]
    want = {r[0]: r for r in brute([tuple(r) for r in docs if len(r.text or "") < 1500])}
    rows = {r[0]: r for r in got(op13_token_alignment(spark, SF_SMALL))}
    assert len(rows) == len(docs) and len(few) > 80
    same = (1, 2, 3, 4, 7)  # corpus counts hold over all documents, not only these
    assert all([rows[d][k] for k in same] == [want[d][k] for k in same] for d in want)


def test_lists_of_the_operator(spark):
    docs = spark.createDataFrame([(1, "Hello, world! 東京"), (2, None)], "doc_id long, text string")
    one, two = sorted(alignment.align(docs, RANKS, PATTERN, PIECES, lane=3).collect(), key=lambda r: r.doc_id)
    (x, y), = token_bytes(["Hello, world! 東京"])
    assert one.a_ids == [i for i, _ in x] and one.b_ids == [i for i, _ in y]
    p, q = spans(x), spans(y)
    assert list(zip(one.links_a, one.links_b, strict=True)) == [(m, n) for m, (_, s, e) in enumerate(p) for n, (_, u, v) in enumerate(q) if s < v and u < e]
    assert one.groups_a[-1] == len(x) and one.groups_b[-1] == len(y)
    assert (two.a_ids, two.b_ids, two.groups_a, two.links_a) == ([], [], [], [])


def test_lanes_give_the_same_links():
    rng = random.Random(1)
    a_end, b_end, a_from, at = [], [], [], 0
    for _ in range(40):
        n = rng.randint(1, 200)
        a_from.append(len(a_end))
        for ends, p in ((a_end, .3), (b_end, .4)):
            ends += [at + k for k in range(1, n) if rng.random() < p] + [at + n]
        at += n
    whole = alignment.lockstep(np.array(a_end), np.array(b_end), np.array(a_from), lane=10**6)
    starts_a, starts_b = [0, *a_end[:-1]], [0, *b_end[:-1]]
    want = [(i, j) for i in range(len(a_end)) for j in range(len(b_end)) if starts_a[i] < b_end[j] and starts_b[j] < a_end[i]]
    assert list(zip(whole[0].tolist(), whole[1].tolist(), strict=True)) == want
    for lane in (1, 2, 7):
        assert all((p == q).all() for p, q in zip(whole, alignment.lockstep(np.array(a_end), np.array(b_end), np.array(a_from), lane), strict=True))


def test_texts_word_by_word():
    rng = random.Random(2)
    texts = ["".join(rng.choice(["the", "Ünder", " ", "  ", "\n", "xyz,", " 東京", " a "]) for _ in range(n)) or "x" for n in (3000, 1, 2, 3, 500)]
    model, _, separable = alignment.piece_model(PIECES)
    ids, many = alignment.encode_pieces(texts, PIECES)
    assert separable and ids.tolist() == [i for t in texts for i in model.encode(t)] and many.tolist() == [len(model.encode(t)) for t in texts]
    assert alignment.encode_pieces(["a b", "no▁give c", "d"], PIECES)[1].tolist() == [2, 0, 1]
