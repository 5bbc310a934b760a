"""Quality by ordinal cumulative-link regression on graded ratings.

A text is one score under weights shared by all grades; ordered thresholds cut the score into grades,
``P(grade > k) = sigmoid(score - threshold_k)``.  Expected grade and tail probability follow, so a
selection can ask for "at least this good with that probability".  Features are hashed from the whole
text: counts of byte pairs folded into a fixed number of cells, how often lines and words repeat, and
the length — vectorised per text, no vocabulary, no pass over the corpus.

Only the fit uses a sample: at most ``FIT_ROWS`` labelled documents, chosen by a hash of the id.  Its
features (a fixed number of bytes a row) are gathered and fitted on the driver; scoring is a narrow map.

Defined results
* null text counts as empty; an empty text has zero counts and is scored like any other;
* without ratings (or with a single grade) every text gets the grades' prior;
* rows repeat in the result as often as in the input; columns other than id and text pass untouched
  through ``select_quality`` and are not read by ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm import labelled

FIT_ROWS = 6144      # bound of the labelled sample
CELLS = 512          # hashed byte pairs
STEPS = 300
GRADE, TAIL = "expected_grade", "tail_probability"


def features(text: str, cells: int = CELLS) -> np.ndarray:
    """Hashed features of one whole text."""
    raw = text.encode()
    x = np.zeros(cells + 4, np.float32)
    x[cells + 3] = 1.0
    if not raw:
        return x
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(b) > 1:
        pairs = ((b[:-1] << np.uint32(8)) | b[1:]) * np.uint32(2654435769) >> np.uint32(32 - (cells - 1).bit_length())
        x[:cells] = np.sqrt(np.bincount(pairs, minlength=cells) / len(pairs))
    lines = [line for line in text.split("\n") if line]
    words = text.split()
    x[cells] = 1 - len(set(lines)) / len(lines) if lines else 0
    x[cells + 1] = 1 - len(set(words)) / len(words) if words else 0
    x[cells + 2] = np.log1p(len(raw)) / 10
    return x


@dataclass(frozen=True)
class OrdinalModel:
    """Shared weights and ascending thresholds; grades are 0 .. len(thresholds)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, x: np.ndarray) -> np.ndarray:
        """P(grade > k) per row and threshold."""
        return 1 / (1 + np.exp(-np.clip((x @ self.weights)[:, None] - self.thresholds[None, :], -40, 40)))


def fit(x: np.ndarray, grades: np.ndarray, n_grades: int, steps: int = STEPS, l2: float = 1e-5,
        rate: float = 0.2) -> OrdinalModel:
    """Maximum likelihood of the cumulative logits (Adam on the mean gradient)."""
    x = x.astype(np.float32)
    cuts = n_grades - 1
    shares = np.array([(np.sum(grades > k) + 1) / (len(grades) + 2) for k in range(cuts)])
    start = -np.log(shares / (1 - shares))
    # thresholds = first + running sum of exp(steps): ascending whatever the parameters
    p = np.concatenate([np.zeros(x.shape[1]), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    d = x.shape[1]
    m, v = np.zeros_like(p), np.zeros_like(p)

    def thresholds(p: np.ndarray) -> np.ndarray:
        return p[d] + np.concatenate([[0.0], np.cumsum(np.exp(p[d + 1:]))])

    for i in range(1, (steps if len(np.unique(grades)) > 1 else 0) + 1):
        t = thresholds(p)
        s = (x @ p[:d].astype(np.float32)).astype(float)
        edge = 1 / (1 + np.exp(-np.clip(np.concatenate([[-np.inf], t, [np.inf]])[None, :] - s[:, None], -40, 40)))
        upper, lower = edge[np.arange(len(s)), grades + 1], edge[np.arange(len(s)), grades]
        share = np.maximum(upper - lower, 1e-9)
        g_score = (upper + lower - 1) / len(s)
        g = np.empty_like(p)
        g[:d] = (g_score.astype(np.float32) @ x) - l2 * p[:d]
        g_t = np.array([np.sum((upper * (1 - upper) / share)[grades == k]) - np.sum((lower * (1 - lower) / share)[grades == k + 1])
                        for k in range(cuts)]) / len(s)
        g[d] = g_t.sum()
        for k in range(1, cuts):
            g[d + k] = g_t[k:].sum() * np.exp(p[d + k])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p + rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-8)
    return OrdinalModel(p[:d].astype(np.float32), thresholds(p))


def train(docs: DataFrame, labels: DataFrame, grade: Column, n_grades: int, rows: int = FIT_ROWS,
          id_col: str = "doc_id", text: str = "text") -> OrdinalModel:
    """Fit on a bounded sample of rated documents; ``grade`` is an integer column 0 .. n_grades - 1 of
    ``labels``."""
    chosen = labelled.sample(docs, labels, grade, rows, id_col, text)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([features(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())],
                names=["grade", "x"])

    seen = (chosen.select(F.col(labelled.TARGET).cast("int").alias("grade"), labelled.TEXT)
            .mapInArrow(describe, "grade int, x binary")
            .orderBy(F.xxhash64("x"), "x", "grade").limit(rows).collect())
    x = np.array([np.frombuffer(r["x"], np.float32) for r in seen]).reshape(len(seen), CELLS + 4)
    return fit(x, np.array([r["grade"] for r in seen], dtype=np.int64), n_grades)


def _scorer(model: OrdinalModel, at_least: int, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                tails = model.tails(np.array([features(t or "") for t in some.column(text_at).to_pylist()]))
                yield some, tails.sum(axis=1), tails[:, at_least - 1]
    return run


def score(docs: DataFrame, model: OrdinalModel, at_least: int = 1, id_col: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``doc_id``, ``expected_grade``, ``tail_probability`` = P(grade >= at_least) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    run = _scorer(model, at_least, 1)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, grade, tail in run(batches):
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(grade, pa.float64()), pa.array(tail, pa.float64())],
                                             names=["doc_id", GRADE, TAIL])

    return rows.mapInArrow(out, T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType),
                                              T.StructField(GRADE, T.DoubleType()), T.StructField(TAIL, T.DoubleType())]))


def select_quality(docs: DataFrame, model: OrdinalModel, at_least: int = 1, probability: float = 0.5,
                   text: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose P(grade >= at_least) reaches ``probability``."""
    run = _scorer(model, at_least, docs.columns.index(text))

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, _, tail in run(batches):
            yield some.filter(pa.array(tail >= probability))

    return docs.mapInArrow(out, docs.schema)
