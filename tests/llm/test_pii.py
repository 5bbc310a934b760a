"""Personal data: base spans against plain patterns, reliabilities against known ones, added spans, defined results."""

import hashlib
import random
import re

import numpy as np

from paddock.llm import pii
from paddock.llm.queries import op12_pii

from ..conftest import SF_SMALL

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


def test_base_spans_against_plain_patterns():
    rng = random.Random(4)
    parts = ["a@b.c", "@", ".", "x_y%", "1.2.3.4", "256.1.1.1", "0001.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (974) 555-3436",
             "+", "(", "-", " ", "é", "😀", "12", "a@b", "a.b@c-d.e.f_g@h.i", "+49", "5", "007", "\n", "٣"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        assert sorted(pii.base_spans(text)[0]) == sorted(brute(text)), text


def test_long_runs_cost_one_pass():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1" + "-" * 300_000, "1 " * 150_000, "a." * 150_000 + "@"):
        assert len(pii.base_spans(text)[0]) <= 40_000
        pii.find(text[:100_000])


def test_query_against_plain_patterns(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op12_pii(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        want = brute(docs[r.doc_id])
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w[0] == k for w in want) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_reliabilities_from_votes_alone():
    rng = np.random.default_rng(7)
    n, prior = 20_000, 0.3
    truth = rng.random(n) < prior
    right = np.array([0.95, 0.9, 0.8, 0.75, 0.7, 0.65])
    says = np.where(rng.random((n, 6)) < right, truth[:, None], ~truth[:, None]).astype(int) * 2 - 1
    codes, many = np.unique([pii.vote_code(tuple(r)) for r in says], return_counts=True)
    post = pii.estimate([("email", int(c), int(m)) for c, m in zip(codes, many, strict=True)])
    guess = np.array([post["email", pii.vote_code(tuple(r))] for r in says])
    majority = says.sum(1) > 0
    assert ((guess > 0.5) == truth).mean() > 0.97 > (majority == truth).mean()
    # Bayes with the true rates is the best there is.
    odds = np.log(prior / (1 - prior)) + (says * np.log(right / (1 - right))).sum(1)
    assert ((guess > 0.5) == (odds > 0)).mean() > 0.99


def corpus():
    rng = random.Random(5)

    def card(first, ok):
        d = first + "".join(rng.choice("0123456789") for _ in range(14))
        good = next(c for c in "0123456789" if luhn(d + c))
        return d + (good if ok else str((int(good) + 1) % 10))

    rows, held = [], {}
    for k in range(160):
        bits = [f"word{k}", "and", rng.choice([f"mail u{k}@site.com", f"host 10.0.{k}.7", f"+1 (202) 555-0{100 + k}", "card " + card("4", True)])]
        if k % 4 == 1:
            bits += ["id", card("9", False), "x"]
        rows.append([k, " ".join(bits)])
    two = card("4", True), card("5", True)
    rows.append([1000, f"cards {two[0]} {two[1]} end"])
    held[1000] = {f"card:6:{6 + 16}", f"card:{6 + 17}:{6 + 33}"}
    rows.append([1001, "nothing on 2024-01-15 in version 1.2 of 12345 pages"])
    held[1001] = set()
    return rows, held


def test_added_spans(spark):
    rows, held = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.spans for r in pii.spans(docs).collect()}
    for d, want in held.items():
        assert {f"{s.kind}:{s.start}:{s.end}" for s in found[d]} == want
    for d, spans in found.items():
        assert all(s.base or s.score >= pii.THRESHOLD for s in spans)
        if d < 1000:
            assert {(s.kind, s.start, s.end) for s in spans if s.base} == set(brute(rows[d][1]))
            assert all(s.base for s in spans)


def test_nulls_empty_tables_and_clashing_columns(spark):
    text = "write to a@b.com or 1.2.3.4"
    rows = [(1, None), (2, ""), (None, text), (3, text), (3, text), (4, "no data " * 50_000 + text)]
    docs = spark.createDataFrame([(d, t, "k", 1) for d, t in rows], "doc_id long, text string, found string, spans int").repartition(3)
    got = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in pii.spans(docs).collect()), key=repr)
    assert got == sorted(((d, brute(t or "")) for d, t in rows), key=repr)
    assert pii.spans(docs.limit(0)).collect() == []
    assert [r.spans for r in pii.spans(docs.where("doc_id < 3")).collect()] == [[], []]
