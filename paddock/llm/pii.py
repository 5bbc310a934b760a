"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

1. Candidates.  In one scan of the texts, the *base* forms (email, ip, card, phone: fixed patterns with fixed checks) and
   wider ones: addresses with a spelled-out at-sign, eight-part ip addresses, national phone numbers, cards standing next to other
   digits, and base matches that fail their check.  Offsets are code points, the end is exclusive.
2. Votes.  Labelers say yes, no or nothing (1, -1, 0) to every candidate: *regex* (its form), *checksum* (Luhn, ranges, lengths),
   *gazetteer* (top-level domains, calling codes, issuer prefixes, reserved networks), *context* (words before it, for and
   against), *border* (the characters beside it) and *shape* (grouping, repeated digits).
3. Reliabilities.  Votes of all candidates of all documents are counted by pattern (kind and votes: at most
   ``4 * 3**6`` rows, whatever the input); expectation-maximisation on these counts estimates each kind's prior and each
   labeler's rates, with no labels at all.
4. Classifier.  The posteriors of a bounded sample of candidates (``SAMPLE`` a kind, by hash of place and id) are the soft
   labels of a logistic regression over votes, shape and hashed neighbours; it scores every candidate.
5. Spans.  Base spans always stay.  Others are added from ``THRESHOLD`` on if they overlap no base span and no better one.

Defined results
* null and empty texts have no spans; rows are told apart by their place in the table, so null ids and repeated rows have
  results of their own; equal candidates of a document can't be; columns other than id and text are not read;
* very long texts are scanned whole; every pattern is anchored or possessive, so a long run of digits or letters costs
  one pass;
* an empty table gives an empty result; without candidates the priors alone make the model, which decides nothing.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm.common import materialise

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("regex", "checksum", "gazetteer", "context", "border", "shape")
SAMPLE = 2048          # candidates of a kind that the classifier learns from, at most
WIDTH = 1 << 12        # hashed features
THRESHOLD = 0.5
WINDOW = 48            # characters of context before and after a candidate
ROUNDS = 50

# --- fixed values: gazetteers and context words (lower case) ---
TOP_LEVEL = set("com org net edu gov mil int info biz io co uk de fr es it nl be ch at pt pl se no dk fi ie eu us ca mx br ar cl au nz jp cn kr in ru za".split())
CALLING_CODES = set("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 "
                    "93 94 95 98 212 213 216 234 254 351 352 353 354 356 357 358 359 370 371 372 380 385 386 420 421 852 886 971 972".split())
ISSUERS = {"3": (14, 15, 16), "4": (13, 16, 19), "5": (16,), "6": (16, 17, 18, 19), "2": (16,)}
FOR = {
    "email": set("mail email e-mail contact contacto kontakt courriel correo write schreiben from to reply".split()),
    "ip": set("ip host server address adresse dirección client login addr gateway".split()),
    "card": set("card visa mastercard amex credit debit karte carte tarjeta pan payment zahlung".split()),
    "phone": set("phone tel telephone call mobile fax telefon téléphone teléfono whatsapp sms ruf appelez llame".split()),
}
AGAINST = set("version ver release build section chapter figure isbn issn order invoice sku token hash key sha md5 commit page seite kapitel "
              "article doi pin serial id".split())

LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"\x20?[(\[{]\x20?(?:at|AT)\x20?[)\]}]\x20?")
_SPELLED = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[(\[{]\x20?(?:dot|DOT)\x20?[)\]}]\x20?)[A-Za-z0-9-]{1,63}){1,8}")
_EIGHT = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_NATIONAL = re.compile(r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])(?:[0-9]{2,4}[\x20.-]){1,3}[0-9]{2,4}(?![0-9A-Za-z-])")
_WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)?")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def only_digits(text: str) -> str:
    return "".join(filter("0123456789".__contains__, text))


def _parts_in_range(span: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (q.lstrip("0") for q in span.split(".")))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from their at-signs."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(spans of the base forms, matches that fail their check), each (kind, start, end)."""
    good = [("email", s, e) for s, e in emails(text)]
    bad = []
    for kind, pattern, fits in (("ip", _IP, _parts_in_range),
                                ("card", _CARD, lambda m: 16 <= len(d := only_digits(m)) <= 19 and luhn(d)),
                                ("phone", _PHONE, lambda m: 8 <= len(only_digits(m)) <= 15)):
        for m in pattern.finditer(text):
            if fits(m.group()):
                good.append((kind, *m.span()))
            elif kind != "card" or len(only_digits(m.group())) >= 13:  # shorter numbers are everywhere and no card's
                bad.append((kind, *m.span()))
    return good, bad


def _wider(text: str, bad: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """Candidates of the wider forms."""
    for m in _AT.finditer(text):
        begin = m.start()
        while begin > max(0, m.start() - 64) and text[begin - 1] in LOCAL:
            begin -= 1
        domain = _SPELLED.match(text, m.end()) if begin < m.start() else None
        if domain:
            yield "email", begin, domain.end()
    if ":" in text:
        yield from (("ip", *m.span()) for m in _EIGHT.finditer(text))
    yield from (("phone", *m.span()) for m in _NATIONAL.finditer(text) if 8 <= len(only_digits(m.group())) <= 15)
    for kind, s, e in bad:
        groups = [m.span() for m in re.finditer("[0-9]+", text[s:e])] if kind == "card" else []
        for k, (a, _) in enumerate(groups):  # up to five groups of three digits or more that hold as many as a card
            size = 0
            for b, c in groups[k:k + 5]:
                size += c - b
                if size > 19 or c - b < 3:
                    break
                if size >= 13:
                    yield "card", s + a, s + c


_DATE = re.compile(r"(?:(?:19|20)[0-9]{2}(?:[.\x20-][0-9]{2}){2,}|(?:[0-9]{2}[.\x20-]){2}(?:19|20)[0-9]{2})")


def _digit_shape(span: str) -> int:
    d = only_digits(span)
    if _DATE.match(span):
        return -1
    if len(set(d)) <= 2 or d in "01234567890123456789" or d in "98765432109876543210":
        return -1
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    return 1 if groups in ([4, 4, 4, 4], [16], [4, 6, 5], [3, 3, 4], [1, 3, 3, 4], [2, 3, 3, 4]) else 0


def votes(text: str, kind: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """What each labeler says to a candidate."""
    span = text[start:end]
    digits = only_digits(span)
    if kind == "email":
        last = re.split(r"[^A-Za-z0-9]+", span)[-1].lower()
        checksum = 1 if 2 <= len(last) <= 24 and last.isalpha() and ".." not in span else -1
        gazetteer, shape = (1 if last in TOP_LEVEL else 0), (-1 if span[0] in ".-%+" else 0)
    elif kind == "ip":
        checksum = 1 if ":" in span or _parts_in_range(span) else -1
        reserved = span.split(".")[0] in ("0", "255") or span.startswith(("0:0:0:0", "::"))
        gazetteer, shape = (-1 if reserved else 0 if ":" in span else 1), (-1 if any(len(p) > 1 and p[0] == "0" for p in span.split(".")) else 0)
    elif kind == "card":
        checksum = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
        gazetteer, shape = (1 if len(digits) in ISSUERS.get(digits[0], ()) else -1), _digit_shape(span)
    else:
        checksum = 1 if 8 <= len(digits) <= 15 else -1
        international = span[0] == "+"
        known = any(digits[:n] in CALLING_CODES for n in (1, 2, 3))
        gazetteer, shape = (1 if international and known else -1 if international else 0), _digit_shape(span)
    words = [w.lower() for w in _WORD.findall(text[max(0, start - WINDOW):start])][-4:]
    context = -1 if AGAINST.intersection(words) else 1 if FOR[kind].intersection(words) else 0
    beside = (text[start - 1:start], text[end:end + 1])
    border = -1 if any(c.isalnum() or c and c in "_=#/\"'" for c in beside) else 1
    return 1 if base else 0, checksum, gazetteer, context, border, shape


def vote_code(row: tuple[int, ...]) -> int:
    code = 0
    for v in row:
        code = 3 * code + v + 1
    return code


def vote_row(code: int) -> list[int]:
    return [code // 3**k % 3 - 1 for k in reversed(range(len(LABELERS)))]


def hashed(text: str, kind: str, start: int, end: int, row: tuple[int, ...]) -> list[int]:
    """Features of a candidate: votes, the shape of its characters, its length, the words and characters beside it."""
    span = text[start:end]
    shape = re.sub("9+", "9", re.sub("a+", "a", re.sub("[A-Za-z]", "a", re.sub("[0-9]", "9", span[:80]))))
    before = _WORD.findall(text[max(0, start - WINDOW):start])[-1:]
    after = _WORD.findall(text[end:end + WINDOW])[:1]
    named = [f"{name}={v}" for name, v in zip(LABELERS, row, strict=True)]
    named += [f"shape={shape}", f"digits={len(only_digits(span[:80]))}", f"before={''.join(before).lower()}", f"after={''.join(after).lower()}",
              f"left={text[start - 1:start]}", f"right={text[end:end + 1]}", "bias"]
    return [zlib.crc32(f"{kind}:{n}".encode()) % WIDTH for n in named]


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                     T.StructField("base", T.BooleanType()), T.StructField("votes", T.IntegerType()),
                     T.StructField("features", T.ArrayType(T.IntegerType()))])


def find(text: str | None) -> list[dict]:
    """All candidates of a text."""
    if not text:
        return []
    good, bad = base_spans(text)
    held = _Places([{"start": s, "end": e} for _, s, e in good])
    seen, out = set(), []
    for base, some in ((True, good), (False, [*bad, *_wider(text, bad)])):
        for one in some:
            if one not in seen and (base or held.free(*one[1:])):
                seen.add(one)
                row = votes(text, *one, base)
                out.append({"kind": one[0], "start": one[1], "end": one[2], "base": base, "votes": vote_code(row),
                            "features": hashed(text, *one, row)})
    return out


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) as ``doc_id`` and ``found``, the candidates of its text."""
    rows = docs.select("doc_id", "text")
    out = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("found", T.ArrayType(SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(out)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(find, batch.column(1).to_pylist()), kinds.field(1).type)], schema=kinds)

    return rows.mapInArrow(run, out)


def estimate(counts: list[tuple[str, int, int]], rounds: int = ROUNDS) -> dict[tuple[str, int], float]:
    """Posterior of every (kind, votes) from the counts of all, by expectation-maximisation.

    A labeler has, for true and for false spans of a kind, a rate of each answer.  It starts out, and is held with the weight
    of a few candidates, at answers that are mostly right, so that yes keeps its meaning and a rare kind a sane model."""
    out = {}
    for kind in KINDS:
        some = [(code, n) for k, code, n in counts if k == kind]
        if not some:
            continue
        n = np.array([n for _, n in some], np.float64)
        rows = np.array([vote_row(code) for code, _ in some])
        answer = np.stack([rows == v for v in (-1, 0, 1)], axis=2).astype(np.float64)  # pattern, labeler, answer
        held = np.array([[2.0, 3.0, 1.0], [0.5, 3.0, 4.0]])  # pseudo-counts of no, nothing, yes: false spans, true ones
        rate, prior = held / held.sum(1, keepdims=True), 0.5
        rate = np.repeat(rate[:, None, :], len(LABELERS), axis=1)
        for _ in range(rounds):
            log = [np.log(p) + np.einsum("plv,lv->p", answer, np.log(rate[y])) for y, p in ((0, 1 - prior), (1, prior))]
            post = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
            for y, share in ((0, 1 - post), (1, post)):
                seen = np.einsum("p,plv->lv", n * share, answer) + held[y]
                rate[y] = seen / seen.sum(1, keepdims=True)
            prior = float(np.clip((n @ post + 1) / (n.sum() + 2), 1e-3, 1 - 1e-3))
        out |= {(kind, code): float(p) for (code, _), p in zip(some, post, strict=True)}
    return out


def fit(rows: list[tuple[list[int], float]], steps: int = 300, rate: float = 0.5, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression on soft labels; every candidate has the same number of features."""
    w = np.zeros(WIDTH)
    if not rows:
        return w
    x, y = np.array([features for features, _ in rows]), np.array([p for _, p in rows])
    used = np.bincount(x.ravel(), minlength=WIDTH) > 0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(w[x].sum(1), -50, 50)))
        w -= rate * (np.bincount(x.ravel(), np.repeat((p - y) / len(y), x.shape[1]), WIDTH) + ridge * w * used)
    return w


@dataclass
class SpanModel:
    weights: np.ndarray
    posterior: dict[tuple[str, int], float]

    def score(self, features: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[features].sum(), -50, 50))))


def train(found: DataFrame, size: int = SAMPLE) -> SpanModel:
    """The model of stored candidates (``doc_id``, ``found``): votes of all of them, a bounded sample for the classifier."""
    spans = found.select("doc_id", F.explode("found").alias("c")).select("doc_id", "c.*")
    counts = spans.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 4 * 3**6 rows
    posterior = estimate(sorted((r["kind"], r["votes"], r["n"]) for r in counts))
    rows = []
    for kind in KINDS:
        place = F.xxhash64("doc_id", "start", "end", "features")
        chosen = spans.where(F.col("kind") == kind).select("votes", "features", place.alias("place"))
        chosen = chosen.orderBy("place", "features").limit(size).collect()
        rows += [(r["features"], posterior[kind, r["votes"]]) for r in chosen]
    return SpanModel(fit(rows), posterior)


def choose(found: list[dict], model: SpanModel, threshold: float = THRESHOLD) -> list[dict]:
    """The base spans and, best first, others that overlap none taken so far; by kind, then place."""
    taken = [f | {"score": 1.0} for f in found if f["base"]]
    # Places held so far, as sorted disjoint runs would be; candidates of a text are few.
    rest = sorted(((model.score(f["features"]), f) for f in found if not f["base"]), key=lambda t: (-t[0], t[1]["start"], -t[1]["end"]))
    held = _Places(taken)
    for p, f in rest:
        if p >= threshold and held.free(f["start"], f["end"]):
            held.add(f["start"], f["end"])
            taken.append(f | {"score": p})
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(taken, key=lambda f: (order[f["kind"]], f["start"]))


class _Places:
    """Taken spans, for overlap tests by binary search: merged, so that starts and ends both ascend."""

    def __init__(self, spans: list[dict]):
        self.starts, self.ends = [], []
        for s, e in sorted((f["start"], f["end"]) for f in spans):
            if self.ends and s <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def _at(self, start: int) -> int:
        return bisect_right(self.ends, start)  # the first that ends after it

    def free(self, start: int, end: int) -> bool:
        k = self._at(start)
        return k == len(self.starts) or end <= self.starts[k]

    def add(self, start: int, end: int) -> None:
        k = self._at(start)
        self.starts.insert(k, start)
        self.ends.insert(k, end)


def spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans`` (``kind``, ``start``, ``end``, ``base``, ``score``), by kind as listed, then place."""
    spark = docs.sparkSession
    found = candidates(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    found = materialise(spark, found, "pii-candidates")
    model = spark.sparkContext.broadcast(train(found))  # WIDTH weights
    one = T.StructType([*SPAN.fields[:4], T.StructField("score", T.DoubleType())])
    out = T.StructType([found.schema["doc_id"], T.StructField("spans", T.ArrayType(one))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(out)
        for batch in batches:
            chosen = [[{k: f[k] for k in one.names} for f in choose(some, model.value, threshold)] for some in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chosen, kinds.field(1).type)], schema=kinds)

    return found.mapInArrow(run, out)


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
