"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, report, other).  Transducers rewrite a clause's
symbols.  The insult and the threat transducer wait for a target within some words *after* the word
("I will kill you"): they are composed into one that reads the clause from its end.  Three more mark
insults and threats a target stands before, those within reach of a negation, and those inside reported
speech; they are composed into a single machine that reads what the first one wrote.  Both tables are
worked out once.  What they leave of a clause is scored: matched clauses, not isolated words.

Insult words come from a short fixed list and from labels: on a bounded sample of labelled documents,
Spark counts in how many toxic and clean ones each word and word stem stands (near copies count once);
every one that is next to never in clean documents and significantly tied to the label on all its own
hits joins the lexicon, rarer ones with less weight (one match of a rare one never decides alone).  The
same sample sets how much plain, targeted, negated and reported matches count.  Threats come from a fixed
list and, by the same counts, from words that are tied to the label only where a target follows them.
Scoring is a narrow map over whole texts with one Aho-Corasick scan; clauses without a trigger never
reach the machine.

Defined results
* null and empty texts match nothing and get the score of a text without matches;
* without labels the fixed lists and prior weights apply;
* labels, language, source and id are never inputs of a score; rows keep their multiplicity; other
  columns pass untouched through ``select_clean``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm import labelled
from paddock.llm.common import materialise

FIT_ROWS = 8192          # bound of the labelled sample
CANDIDATES = 5000        # bound of the candidate words and stems gathered, the most significant first
STEMS = (4, 5, 6, 7, 8)  # lengths of stems
PRECISION = 95           # percent of a word's documents that must be toxic
SHRINK = 4               # hits at which a learned word has half of its weight
RARE, LONE = 20, 0.25    # a word learned from fewer hits gives a text at most this score alone: it takes a second match

# Fixed word lists of the grammar.
INSULTS = ("idiot", "idiots", "moron", "morons", "imbecile", "scum", "loser", "losers", "worthless", "pathetic",
           "disgusting", "stupid", "trash", "vermin", "filth")
THREATS = ("kill", "murder", "strangle", "exterminate")
TARGETS = ("you", "your", "he", "she", "they", "them", "this", "these", "those", "du", "dich", "ihr", "tu", "toi",
           "vous", "usted", "ellos")
NEGATIONS = ("not", "no", "never", "nobody", "nicht", "kein", "keine", "nie", "pas", "jamais", "nunca")
INSULT_WAITS, THREAT_WAITS = 2, 4  # words after an insult or threat within which its target may stand
REPORTS = ("said", "says", "called", "calls", "wrote", "quoted", "reported", "sagte", "dijo", "dit")

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "ITGNRO"
WORD = re.compile(r"[^\W\d_]+")
CLAUSE_END = re.compile(r"[.!?;:\n|]")


# --- transducers --------------------------------------------------------------------------------

@dataclass(frozen=True)
class Transducer:
    """Deterministic: (state, symbol) -> (next state, output symbol); start state 0."""

    arcs: dict[tuple[int, str], tuple[int, str]]

    def __call__(self, symbols: list[str]) -> list[str]:
        state, out = 0, []
        for s in symbols:
            state, o = self.arcs[state, s]
            out.append(o)
        return out

    def alphabet(self) -> set[str]:
        return {s for _, s in self.arcs}

    def then(self, other: Transducer) -> Transducer:
        """Composition: what this one writes is what ``other`` reads."""
        number, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
        while todo:
            pair = todo.pop()
            for s in sorted(self.alphabet()):
                a, mid = self.arcs[pair[0], s]
                b, out = other.arcs[pair[1], mid]
                if (a, b) not in number:
                    number[a, b] = len(number)
                    todo.append((a, b))
                arcs[number[pair], s] = (number[a, b], out)
        return Transducer(arcs)


def window(opener: str, mark: str, reach: int, symbols: list[str], marked: str = INSULT + THREAT) -> Transducer:
    """After ``opener`` the next ``reach`` words are in its window (for ever, if 0): ``marked`` symbols there
    (insults and threats) get ``mark`` appended."""
    arcs = {}
    for state in range((reach or 1) + 1):
        for s in symbols:
            following = (reach or 1) if s[0] == opener else state if not reach else max(0, state - 1)
            arcs[state, s] = (following, s + mark if state and s[0] in marked else s)
    return Transducer(arcs)


PLAIN = [INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER]


def waiting() -> Transducer:
    """Reads a clause from its end: insults and threats whose target stands within some words after them."""
    return window(TARGET, "w", INSULT_WAITS, PLAIN, INSULT).then(
        window(TARGET, "w", THREAT_WAITS, [*PLAIN, INSULT + "w"], THREAT))


def grammar() -> Transducer:
    """Reads what ``waiting`` wrote, from the start."""
    found = [*PLAIN, INSULT + "w", THREAT + "w"]
    aimed = [*found, *[s + "g" for s in found if s[0] in (INSULT, THREAT)]]
    negated = [*aimed, *[s + "n" for s in aimed if s[0] in (INSULT, THREAT)]]
    return (window(TARGET, "g", 4, found).then(window(NEGATION, "n", 3, aimed))
            .then(window(REPORT, "r", 0, negated)))


#: What a matched word counts as, and the weight it has before labels are seen.
KINDS = ("plain", "aimed", "negated", "reported", "threat")
PRIOR = np.array([1.2, 1.5, 0.4, 0.5, 2.0])
PRIOR_BIAS = -2.5


def kind(symbol: str) -> int:
    if "r" in symbol:
        return 3
    if "n" in symbol:
        return 2
    if symbol[0] == THREAT:
        return 4 if "w" in symbol else 2  # without a target after it (before it stands who acts) as little as a negated one
    return 1 if "g" in symbol or "w" in symbol else 0


# --- the model ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class ToxicityModel:
    """Lexicon (a word, or a stem ending in ``*``, with its weight), words that are threats where a target is
    near, and the weights of match kinds."""

    lexicon: dict[str, float]
    coefficients: np.ndarray = field(default_factory=lambda: PRIOR)
    bias: float = PRIOR_BIAS
    threats: dict[str, float] = field(default_factory=lambda: dict.fromkeys(THREATS, 2.0))


class Matcher:
    """Built once per task from the model."""

    def __init__(self, model: ToxicityModel):
        import ahocorasick

        self.model, self.waiting, self.machine = model, waiting(), grammar()
        self.scan = ahocorasick.Automaton()
        for word in {**model.threats, **model.lexicon}:
            self.scan.add_word(word.rstrip("*"), word)
        self.scan.make_automaton()
        self.symbols = ({w: TARGET for w in TARGETS} | {w: NEGATION for w in NEGATIONS} | {w: REPORT for w in REPORTS})

    def triggers(self, low: str) -> dict[int, tuple[int, float, str]]:
        """Start of each triggering word -> (end, weight, symbol)."""
        found: dict[int, tuple[int, float, str]] = {}
        for last, word in self.scan.iter(low):
            stem = word.rstrip("*")
            start, end = last - len(stem) + 1, last + 1
            if start and low[start - 1].isalpha():
                continue
            if end < len(low) and low[end].isalpha():
                if stem == word:
                    continue
                end = WORD.match(low, start).end()
            symbol, weight = (INSULT, self.model.lexicon[word]) if word in self.model.lexicon else (THREAT, self.model.threats[word])
            if start not in found or weight > found[start][1]:
                found[start] = (end, weight, symbol)
        return found

    def clauses(self, text: str) -> list[tuple[int, int, int, float]]:
        """(start, end, strongest kind, weight) of every matched clause; adds to ``sums``."""
        low = text.lower() if text.isascii() else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        found, out = self.triggers(low), []
        self.sums = np.zeros(len(KINDS))
        done = -1
        for at in sorted(found):
            if at < done:
                continue
            begin = max((m for m in (low.rfind(e, 0, at) for e in ".!?;:\n|")), default=-1) + 1
            stop = CLAUSE_END.search(low, found[at][0])
            end = done = stop.start() if stop else len(low)
            words = [(m.start(), m.group()) for m in WORD.finditer(low, begin, end)]
            symbols = [found[s][2] if s in found else self.symbols.get(w, OTHER) for s, w in words]
            marked = self.machine(self.waiting(symbols[::-1])[::-1])
            mass = np.zeros(len(KINDS))
            for (s, _), symbol in zip(words, marked, strict=True):
                if s in found:
                    mass[kind(symbol)] += found[s][1]
            self.sums += mass
            out.append((begin, end, int(np.argmax(mass)), float(mass.sum())))
        return out

    def features(self, text: str) -> np.ndarray:
        self.clauses(text)
        return np.log1p(self.sums)

    def score(self, text: str) -> tuple[float, list[tuple[int, int, int, float]]]:
        spans = self.clauses(text)
        z = self.model.bias + float(np.log1p(self.sums) @ self.model.coefficients)
        return 1 / (1 + math.exp(-min(max(z, -40), 40))), spans


def fit_kinds(x: np.ndarray, y: np.ndarray, l2: float = 2.0, steps: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, pulled towards the prior weights; no weight below 0, an aimed insult
    counts no less than a plain one, an aimed threat no less than an aimed insult."""
    prior = np.append(PRIOR, PRIOR_BIAS)
    x1 = np.hstack([x, np.ones((len(x), 1))])
    pull = np.append(np.full(len(PRIOR), l2), 0.1)
    w = prior.copy()
    for _ in range(steps if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -40, 40)))
        gradient = x1.T @ (p - y) + pull * (w - prior)
        hessian = (x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(pull)
        w = w - np.linalg.solve(hessian, gradient)
        w[:-1] = np.maximum(w[:-1], 0)
        w[1] = max(w[0], w[1])
        w[4] = max(w[1], w[4])
    if not len(x) or not x[:, 4].any():  # no threat seen: one counts against the fitted bias as it did against the prior one
        w[4] = max(w[4], PRIOR[4] + (PRIOR_BIAS - w[-1]) / math.log1p(2.0))
    return w[:-1], float(w[-1])


def significance(hits: float, n: float, rate: float) -> float:
    """Chernoff bound: minus the log of the chance that ``n`` documents hold ``hits`` toxic ones."""
    share = hits / n
    if share <= rate:
        return 0.0
    rest = (1 - share) * math.log((1 - share) / (1 - rate)) if share < 1 else 0.0
    return n * (share * math.log(share / rate) + rest)


def choose(candidates: dict[str, tuple[int, int]], toxic: int, total: int, least: float) -> dict[str, float]:
    """Every word or stem that is significant on its own hits, whatever the others explain; of a stem and its
    longer forms that stand in the same documents, the longest."""
    chosen = {}
    for w, (hits, n) in candidates.items():
        if significance(hits, n, toxic / total) >= least:
            odds = math.log((hits + 0.5) / (toxic + 1)) - math.log((n - hits + 0.5) / (total - toxic + 1))
            chosen[w] = odds / 3 * hits / (hits + SHRINK)
    same = {w[:k] + "*" for w in chosen for k in STEMS
            if len(w.rstrip("*")) > k and candidates.get(w[:k] + "*") == candidates[w]}
    return {w: v for w, v in chosen.items() if w not in same and v > 0}


def followed(text: str) -> list[str]:
    """Distinct words with a target within ``THREAT_WAITS`` words after them in their clause."""
    out: set[str] = set()
    for clause in CLAUSE_END.split(text.lower()):
        near = 0
        for w in reversed(WORD.findall(clause)):
            if near:
                out.add(w)
            near = THREAT_WAITS if w in TARGETS else max(0, near - 1)
    return sorted(out.difference(TARGETS, NEGATIONS, REPORTS))


def tally(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Word or stem -> (toxic documents, documents) that hold it, of (``doc``, ``toxic``, ``word``); the precise ones."""
    stems = F.explode(F.array(F.col("word"), *[
        F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in STEMS]))
    held = (words.where(F.length("word") > 2)
            .select("doc", "toxic", stems.alias("stem")).where(F.col("stem").isNotNull()).distinct())
    counts = (held.groupBy("stem").agg(F.sum("toxic").alias("hits"), F.count("*").alias("n"))
              .where((F.col("hits") >= 3) & (100 * F.col("hits") >= PRECISION * F.col("n"))))
    # Order by the significance bound of a word that no clean text holds, then its clean count.
    top = (counts.orderBy((F.col("hits") - 4 * (F.col("n") - F.col("hits"))).desc(), "stem").limit(CANDIDATES))
    return {r["stem"]: (r["hits"], r["n"]) for r in top.collect()}


def train(docs: DataFrame, labels: DataFrame, toxic: Column, rows: int = FIT_ROWS, id_col: str = "doc_id",
          text: str = "text") -> ToxicityModel:
    """Lexicon and weights from a bounded sample of labelled documents."""
    spark = docs.sparkSession
    sample = labelled.sample(docs, labels, toxic.cast("int"), rows, id_col, text)
    # Copies and near copies say nothing new about a word: of documents with the same smallest hash of five
    # words in a row one counts.  (So repeated rows don't outgrow the bound either.)
    words = F.split(F.lower(labelled.TEXT), r"\s+")
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - 4, F.lit(1))),
                       lambda i: F.xxhash64(F.array_join(F.slice("words", i, F.lit(5)), " ")))
    sample = materialise(spark, sample.withColumn("words", words).groupBy(F.array_min(runs).alias("doc")).agg(
        F.max(labelled.TARGET).alias("toxic"), F.first(labelled.TEXT).alias("text"))
        .orderBy("doc").limit(rows).repartition(spark.sparkContext.defaultParallelism), "toxicity-sample")
    total, toxic_n = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic_n or toxic_n == total:
        return ToxicityModel({w: 2.0 for w in INSULTS})
    words = F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word")
    candidates = tally(sample.select("doc", "toxic", words))

    def near_target(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [followed(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))],
                                             names=["doc", "toxic", "words"])

    aimed = sample.select("doc", "toxic", "text").mapInArrow(near_target, "doc long, toxic int, words array<string>")
    directed = tally(aimed.select("doc", "toxic", F.explode("words").alias("word")))
    # The bar leaves less than one of the candidates to chance.
    learned = choose(candidates, toxic_n, total, math.log(CANDIDATES))
    lexicon = learned | {w: max(2.0, learned.get(w, 0.0)) for w in INSULTS}
    # A threat is tied to the label where it is aimed, but not wherever it stands.  Any word may stand before a
    # target by chance, so the bar is higher.
    meant = {w: v for w, v in choose(directed, toxic_n, total, math.log(CANDIDATES * 1000.0)).items() if w not in candidates}
    threats = meant | dict.fromkeys(THREATS, 2.0)
    draft = ToxicityModel(lexicon, threats=threats)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(draft)
        for batch in batches:
            x = np.array([matcher.features(t or "") for t in batch.column(1).to_pylist()]).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["y", "x"])

    seen = sample.select("toxic", "text").mapInArrow(describe, "y int, x array<double>").collect()
    x, y = np.array([r["x"] for r in seen]), np.array([r["y"] for r in seen], float)
    coefficients, bias = fit_kinds(x, y)

    def capped(weights: dict[str, float], seen: dict[str, tuple[int, int]], strongest: float) -> dict[str, float]:
        alone = math.expm1(max(0.0, math.log(LONE / (1 - LONE)) - bias) / max(strongest, 1e-9))
        return {w: min(v, alone) if seen[w][0] < RARE else v for w, v in weights.items()}

    lexicon |= capped({w: v for w, v in learned.items() if w not in INSULTS}, candidates, max(coefficients[:4]))
    threats |= capped({w: v for w, v in meant.items() if w not in THREATS}, directed, max(coefficients))
    return ToxicityModel(lexicon, coefficients, bias, threats)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``score`` and ``clauses`` (start, end, kind, weight of every matched clause) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("weight", pa.float64())])

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in batches:
            got = [matcher.score(t or "") for t in batch.column(1).to_pylist()]
            spans = [[{"start": s, "end": e, "kind": KINDS[k], "weight": w} for s, e, k, w in g[1]] for g in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.float64()), pa.array(spans, pa.list_(span))],
                names=["doc_id", "score", "clauses"])

    return rows.mapInArrow(out, T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("score", T.DoubleType()),
        T.StructField("clauses", T.ArrayType(T.StructType([
            T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
            T.StructField("kind", T.StringType()), T.StructField("weight", T.DoubleType())])))]))


def select_clean(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, that score below ``threshold``."""
    at = docs.columns.index(text)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in batches:
            keep = [matcher.score(t or "")[0] < threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(out, docs.schema)
