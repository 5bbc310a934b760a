"""Best-fit packing of token sequences by exact-complement hashing.

How many pieces there are of each length is all that a packing plan needs, and that histogram has at
most ``capacity`` entries whatever the size of the corpus.  The plan indexes sums of one, two and
three lengths, consumes combinations that fill a gap exactly as often as the counts allow, and places
what remains by best fit; how many lengths such a combination may take at first (three spend the short ones that
later gaps need) is tried out, plain best fit included, and the smallest plan is improved by packing parts of it anew.
It is a list of patterns — "these lengths together, n times" — and each
pattern uses up a length, so the plan is bounded too.  Pieces find their place by their rank among the
pieces of their length: a running number within the task that tokenised them, plus the counts of the
tasks before it.  Nothing is sorted, no length (however common) is gathered in one task, and token ids
are never shuffled by the planning.

Defined results
* null text is empty: its piece is the end token alone;
* a document over ``capacity`` is cut into ``capacity`` pieces, of which the first may be shorter;
* repeated rows and null ids are packed like any others; an empty table gives an empty result;
* columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from paddock.llm import tokens
from paddock.llm.common import materialise

CAPACITY = 1024
END_ID = 2
ROUNDS = 6          # attempts to improve a plan that is above the lower bound


# --- the plan: a pure function of the length histogram -------------------------------------------

def _pair(have: np.ndarray, gap: int) -> tuple[int, int] | None:
    """Available a >= b with a + b == gap, the largest a; equal ones need two."""
    a = np.arange(gap - 1, (gap - 1) // 2, -1)
    a = a[a < len(have)]
    ok = (have[a] > 0) & (have[gap - a] > 0) & ((2 * a != gap) | (have[a] > 1))
    hit = np.flatnonzero(ok)
    return (int(a[hit[0]]), int(gap - a[hit[0]])) if len(hit) else None


def exact_fill(have: np.ndarray, gap: int) -> list[int] | None:
    """One, two or three available lengths that fill ``gap`` exactly."""
    if gap < len(have) and have[gap] > 0:
        return [gap]
    if two := _pair(have, gap):
        return list(two)
    for a in np.flatnonzero(have[:gap])[::-1]:
        if a < 1 or 3 * a < gap:
            break
        have[a] -= 1
        two = _pair(have, gap - int(a))
        have[a] += 1
        if two:
            return [int(a), *two]
    return None


Patterns = list[tuple[list[int], int]]


class _Stock:
    """Lengths still to place, and the patterns that have used up the others."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.have = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in histogram.items():
            self.have[length] = n
        self.patterns: Patterns = []

    def use(self, lengths: list[int]) -> None:
        """Take this combination as often as there is enough of all of it."""
        need = Counter(lengths)
        n = min(int(self.have[x]) // k for x, k in need.items())
        for x, k in need.items():
            self.have[x] -= n * k
        self.patterns.append((lengths, n))


def complements(stock: _Stock, most: int) -> None:
    """Use up exact combinations of one, two and up to ``most`` lengths, the largest (hardest to place) first."""
    have, capacity = stock.have, stock.capacity
    if have[capacity]:
        stock.use([capacity])
    for a in range(capacity - 1, (capacity - 1) // 2, -1):
        b = capacity - a
        if most >= 2 and have[a] and have[b] and (a != b or have[a] > 1):
            stock.use([a, b])
    for a in range(capacity - 1, 0, -1):
        while most >= 3 and have[a]:
            have[a] -= 1
            two = _pair(have, capacity - a)
            have[a] += 1
            if not two:
                break
            stock.use([a, *two])


def fill_gaps(stock: _Stock, exact_from: int = 1) -> None:
    """The largest length opens a sequence; each gap is filled exactly if three lengths can do it (from lengths of ``exact_from``
    on), else by the best-fitting (largest) length that still goes in."""
    have, capacity = stock.have, stock.capacity
    for a in range(capacity, 0, -1):
        while have[a]:
            taken, gap = [a], capacity - a
            have[a] -= 1
            while gap > 0:
                fill = exact_fill(have, gap) if a >= exact_from else None
                if not fill:
                    fits = np.flatnonzero(have[:gap + 1])
                    if not len(fits):
                        break
                    fill = [int(fits[-1])]
                for x in fill:
                    have[x] -= 1
                taken += fill
                gap -= sum(fill)
            for x in taken:
                have[x] += 1
            stock.use(taken)


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> Patterns:
    """Best fit decreasing, for all sequences of a gap at once: a length goes where it leaves least, and a sequence that takes
    one of it then has the smallest gap, so it takes as many as fit."""
    open_at: dict[int, Patterns] = {capacity: []}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for gap in sorted(g for g in open_at if g >= length and g < capacity) + [capacity]:
            each = gap // length
            bins = open_at.pop(gap) if gap < capacity else [([], -(-left // each))]
            kept: Patterns = []
            for taken, n in bins:
                whole = min(n, left // each)
                rest = left - whole * each if whole < n and left - whole * each < each else 0
                left -= whole * each + rest
                for k, m in ((each, whole), (rest, 1 if rest else 0)):
                    if m:
                        open_at.setdefault(gap - k * length, []).append(([*taken, *[length] * k], m))
                if n > whole + (rest > 0):
                    kept.append((taken, n - whole - (rest > 0)))
            if gap < capacity and kept:
                open_at.setdefault(gap, []).extend(kept)
            if not left:
                break
    return [p for g, some in open_at.items() for p in some if p[0]]


def _size(patterns: Patterns) -> int:
    return sum(n for _, n in patterns)


def least_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> int:
    """A lower bound: lengths over half the capacity never meet; what is longer than ``capacity - k`` meets nothing of at
    least ``k``, and the tokens of the others need room beside those between."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if not len(lengths):
        return 0
    many = np.array([histogram[int(x)] for x in lengths], dtype=np.int64)
    bounds = [-(-int((lengths * many).sum()) // capacity)]
    for k in range(1, capacity // 2 + 1):
        alone, half = lengths > capacity - k, (lengths <= capacity - k) & (2 * lengths > capacity)
        small = (lengths >= k) & (2 * lengths <= capacity)
        room = int((many * (capacity - lengths))[half].sum())
        bounds.append(int(many[alone | half].sum()) + max(0, -(-(int((lengths * many)[small].sum()) - room) // capacity)))
    return max(bounds)


def _plans(histogram: dict[int, int], capacity: int, most: tuple = (3, 2, 1)) -> Iterator[Patterns]:
    for k in most:
        for exact_from in (1, capacity // 2 + 1) if k < 3 else (1,):
            stock = _Stock(histogram, capacity)
            complements(stock, k)
            fill_gaps(stock, exact_from)
            yield stock.patterns
    stock = _Stock(histogram, capacity)
    complements(stock, 2)
    rest = {int(x): int(stock.have[x]) for x in np.flatnonzero(stock.have)}
    yield stock.patterns + best_fit(rest, capacity)
    yield best_fit(histogram, capacity)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Patterns:
    """Patterns (lengths, how often), covering the histogram exactly: the smallest of the plans that use up exact combinations of
    three, two or one length first, and of plain best fit; then improved by unpacking what is not full, with some that
    is, and packing it anew, until the lower bound is met or ``rounds`` are over."""
    least = least_sequences(histogram, capacity)
    best: Patterns | None = None
    for patterns in _plans(histogram, capacity):
        if best is None or _size(patterns) < _size(best):
            best = patterns
        if _size(best) == least:
            return best
    rng = np.random.default_rng(len(histogram))
    for k in range(rounds):
        keep: Patterns = []
        loose: Counter = Counter()
        for lengths, n in best:
            share = 1.0 if sum(lengths) < capacity else rng.random() * (0.2 + 0.6 * (k % 4) / 3)
            out = round(n * share)
            for x in lengths:
                loose[x] += out
            if n > out:
                keep.append((lengths, n - out))
        loose = {x: n for x, n in loose.items() if n}
        again = min(_plans(loose, capacity), key=_size)
        if _size(keep) + _size(again) <= _size(best):
            best = keep + again
        if _size(best) == least:
            break
    return best


def slots(patterns: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """Per pattern and place: which ranks of a length go where; sorted by (length, first rank)."""
    cursor: Counter = Counter()
    rows, first_sequence = [], 0
    for lengths, n in patterns:
        offset = 0
        for x in lengths:
            rows.append((x, cursor[x], first_sequence, offset))
            cursor[x] += n
            offset += x
        first_sequence += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T, strict=True))


# --- the Spark side --------------------------------------------------------------------------------

def tokenise(docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
             id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` tokens: ``ids`` holds them as little-endian unsigned 32-bit
    integers.  ``part`` and ``nth`` number the pieces of each length within the task, so keep
    the result in a table (``materialise``) before ``place`` reads it twice."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(ranks_path, pattern).encode_ordinary
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # long texts: few of them at a time
                some = batch.slice(at, 256)
                of, piece, start, length, ids, nth = [], [], [], [], [], []
                for row, words in enumerate(some.column(1).to_pylist()):
                    got = np.array([*encode(words), end_id], dtype="<u4")
                    first = len(got) % capacity or capacity
                    for k, end in enumerate(range(first, len(got) + 1, capacity)):
                        begin = max(0, end - capacity)
                        of.append(row)
                        piece.append(k)
                        start.append(begin)
                        length.append(end - begin)
                        ids.append(got[begin:end].tobytes())
                        nth.append(seen[end - begin])
                        seen[end - begin] += 1
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(of, pa.int32())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                     pa.array([part] * len(of), pa.int32()), pa.array(nth, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids", "part", "nth"])

    return rows.mapInArrow(cut, schema)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a table with ``length``, ``part``, ``nth``) with ``sequence_id`` and ``offset``
    in place of ``part`` and ``nth``; other columns stay."""
    # One row per task and length; the running sum over the tasks of one length is what must come
    # before a task's own pieces of it.
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("length", "part", (F.sum("n").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    where = slots(plan(histogram, capacity))
    ranked = (pieces.join(before, ["length", "part"])
              .withColumn("nth", F.col("nth") + F.coalesce("before", F.lit(0)))
              .drop("before", "part").select("nth", *[c for c in pieces.columns if c not in ("part", "nth")]))
    keep = [f for f in ranked.schema.fields if f.name != "nth"]
    schema = T.StructType([*keep, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    first = where["length"] * (1 << 44) + where["rank"]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("nth").to_numpy()
            at = np.searchsorted(first, batch.column("length").to_numpy() * (1 << 44) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in keep], pa.array(where["sequence"][at] + rank - where["rank"][at]),
                 pa.array(where["offset"][at])], names=schema.names)

    return ranked.mapInArrow(put, schema)


def pack(docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """All documents packed: one row per piece with its ``ids``, ``sequence_id`` and ``offset``."""
    pieces = tokenise(docs, ranks_path, pattern, capacity, end_id, id_col, text)
    return place(materialise(docs.sparkSession, pieces, "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids``, ``pieces`` (document, piece and offset)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))  # at most `capacity` pieces
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "").alias("hex"),
        F.transform("parts", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"])).alias("pieces"),
    ).select("sequence_id", F.unhex("hex").alias("ids"), "pieces")
