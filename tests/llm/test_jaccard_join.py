"""Jaccard join against brute force: planted near copies, chains, shared passages, recursion, edge cases."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from paddock.llm import jaccard_join as jj
from paddock.llm.queries import op3_jaccard_join
from paddock.llm.shingles import shingle_set

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(AZ))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """[(doc_id, n_shingles, component_id)], any pair compared that shares a shingle."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j < i}:
            if 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                up[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return sorted(((d, len(s), min(least[find(i)], default=None)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_shingle_hashes_against_tuples():
    texts = ["", " \t\n", "A b", "a  B\x0bc", "one two three four five SIX one two three four five six", "\x1c x\x85y z", "ß É é " * 9]
    assert [len(shingle_set(t)) for t in texts] == [len(shingles(t)) for t in texts]
    assert (shingle_set("A b") == shingle_set("a\tB ")).all() and len(np.intersect1d(shingle_set("a b"), shingle_set("b a"))) == 0


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert got(op3_jaccard_join(spark, SF_SMALL)) == brute(rows)


def corpus(seed, families=6, size=40):
    """Chains of near copies, copies, and one long passage that most documents share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(families):
        text = [word() for _ in range(rng.randint(30, 120))]
        for _ in range(size):
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text + (passage if rng.random() < 0.6 else [])))
    rows += [" ".join(passage + [word() for _ in range(rng.randint(0, 40))]) for _ in range(size * 2)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("seed", "leaf"), [(1, 32), (2, 3)])
def test_chains_and_shared_passages(spark, seed, leaf):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(jj.jaccard_join(docs, bits=12, leaf=leaf)) == brute(rows)


def test_a_useless_order_loses_nothing(spark):
    rows = corpus(3, families=3, size=25)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(jj.jaccard_join(docs, bits=1, leaf=4)) == brute(rows)


def test_nulls_empties_ties_and_clashing_columns(spark):
    long = "w%d " * 3000 % tuple(range(3000))
    texts = [None, "", " \n", "a b", "A  b", "b a", long, long + "tail", long + "tail", "x y z 1 2 3", "x y z 1 2 3"]
    rows = [*enumerate(texts), (None, "a b"), (None, "lone"), (10, "x y z 1 2 3")]
    docs = spark.createDataFrame([(d, t, 1, "q") for d, t in rows], "doc_id long, text string, n int, fp string").repartition(3)
    assert got(jj.jaccard_join(docs, bits=10)) == brute(rows)
    assert got(jj.jaccard_join(docs.limit(0), bits=10)) == []
