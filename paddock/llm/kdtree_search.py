"""Exact top-k by inner product with a KD-tree per shard.

Vectors are dealt into shards by median splits too: a tree over a bounded sample (``DEAL_SAMPLE`` vectors, ``DEAL_LEAVES``
leaves at most) sends every vector to a leaf, and a leaf of many vectors is cut into shards of bounded size at random, so a
vector that stands a million times makes many shards and no large one.  Each shard becomes a KD-tree: median splits
of the widest dimension, a tight bounding box at every node.  The best inner product a box can hold is
the sum over dimensions of the query's component times the box's upper or lower edge, whichever is
larger; a node is visited best bound first and left out once its bound is below the query's k-th score.

Queries go in blocks.  A first round searches one shard of each query's own leaf, and the k-th scores found
there are handed on: in the second round a query goes only to the leaves whose bounding box (of all their vectors)
can hold that score.  Only a shard's best k of a query are shuffled, and ranked.

Defined results
* components become floor(1024 x), x as double; scores are exact while they fit into 64 bits;
* a vector that is null, empty, or holds a null or a non-finite component takes no part, nor does a null id;
* a query's own row is every row with its id; repeated rows of other ids are candidates each;
* a query row that repeats another exactly is one query; ties go to the smaller id;
* vectors are compared with those of the same length; fewer than k candidates: all of them;
* other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paddock.llm.common import materialise

K = 10
SHARD_ROWS = 8192
BLOCK_ROWS = 1024
LEAF_ROWS = 128
DEAL_SAMPLE = 1 << 16     # vectors that the dealing tree is built from, at most
DEAL_LEAVES = 1 << 10     # its leaves, at most: their boxes are broadcast
EXACT = 2.0 ** 53


def scaled(vector: Column, by: int = 1024) -> Column:
    """floor(by * x) of every component; null where the vector takes no part."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when((F.size(vector) > 0) & ok, F.transform(vector, lambda x: F.floor(x.cast("double") * by).cast("long")))


# --- the tree, inside a task -----------------------------------------------------------------------

class KdTree:
    """Rows in leaf order; node i has box lo[i]..hi[i], rows first[i]..last[i], children left[i], left[i] + 1 (or none)."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF_ROWS):
        order = np.arange(len(ids))
        lo, hi, first, last, left = [rows.min(axis=0)], [rows.max(axis=0)], [0], [len(ids)], [-1]
        todo = [0]
        while todo:
            i = todo.pop()
            a, b = first[i], last[i]
            spread = hi[i] - lo[i]
            if b - a <= leaf or not spread.any():
                continue
            middle = (a + b) // 2
            column = rows[order[a:b], np.argmax(spread)]
            order[a:b] = order[a:b][np.argpartition(column, middle - a)]
            left[i] = len(lo)
            for x, y in ((a, middle), (middle, b)):
                part = rows[order[x:y]]
                lo.append(part.min(axis=0))
                hi.append(part.max(axis=0))
                first.append(x)
                last.append(y)
                left.append(-1)
            todo += [left[i], left[i] + 1]
        self.ids, self.rows = ids[order], rows[order]
        self.lo, self.hi = np.array(lo), np.array(hi)
        self.first, self.last, self.left = np.array(first), np.array(last), np.array(left)

    def dump(self) -> list[bytes]:
        return [np.ascontiguousarray(x, np.int64).tobytes() for x in
                (self.ids, self.rows, self.lo, self.hi, self.first, self.last, self.left)]

    @classmethod
    def load(cls, parts: list[bytes], dim: int) -> KdTree:
        tree = cls.__new__(cls)
        ids, rows, lo, hi, first, last, left = (np.frombuffer(p, np.int64) for p in parts)
        tree.ids, tree.first, tree.last, tree.left = ids, first, last, left
        tree.rows, tree.lo, tree.hi = (x.reshape(-1, dim) for x in (rows, lo, hi))
        return tree

    def search(self, queries: np.ndarray, own: np.ndarray, bounds: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query: ids and scores of its best k here, none of them below its bound."""
        # float64 multiplies the same integers exactly (and fast) unless a sum could reach 2**53
        widest = float(max(np.abs(self.lo).max(), np.abs(self.hi).max())) * float(np.abs(queries).max(initial=0)) * queries.shape[1]
        kind = np.float64 if widest < EXACT else np.int64
        q = queries.astype(kind)
        lo, hi, rows = self.lo.astype(kind), self.hi.astype(kind), self.rows.astype(kind)
        reach = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
        for n in range(len(q)):
            best = reach[n]
            ids, scores, kth = np.empty(0, np.int64), np.empty(0, kind), bounds[n]
            heap = [(-best[0], 0)]
            while heap and -heap[0][0] >= kth:
                i = heapq.heappop(heap)[1]
                if self.left[i] >= 0:
                    for child in (self.left[i], self.left[i] + 1):
                        if best[child] >= kth:
                            heapq.heappush(heap, (-best[child], child))
                    continue
                a, b = self.first[i], self.last[i]
                found = rows[a:b] @ q[n]
                take = (found >= kth) & (self.ids[a:b] != own[n])
                if take.any():
                    ids, scores = np.concatenate([ids, self.ids[a:b][take]]), np.concatenate([scores, found[take]])
                    if len(ids) > k:
                        top = np.lexsort((ids, -scores))[:k]
                        ids, scores = ids[top], scores[top]
                    if len(ids) >= k:
                        kth = max(kth, scores.min())
            yield ids, scores.astype(np.int64)


TREE = ("ids", "rows", "lo", "hi", "first", "last", "links")
LOWEST = -(1 << 63)


# --- dealing vectors to leaves ---------------------------------------------------------------------

class Dealer:
    """Median splits of a sample: node i sends what is at most ``at[i]`` in dimension ``on[i]`` to ``left[i]``, the rest to the next."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.on, self.at, self.left, self.leaf, many = [0], [0], [-1], [0], 1
        todo = [(sample, 0)]
        while todo and many < leaves:
            rows, i = todo.pop(0)
            spread = np.ptp(rows, axis=0) if len(rows) else np.zeros(1)
            d = int(np.argmax(spread))
            if len(rows) < 2 or not spread[d]:
                continue
            middle = np.sort(rows[:, d])[(len(rows) - 1) // 2]
            if middle == rows[:, d].max():  # most are the largest: the others go left
                middle = rows[:, d][rows[:, d] < middle].max()
            self.on[i], self.at[i], self.left[i] = d, int(middle), len(self.on)
            low = rows[:, d] <= middle
            for part in (rows[low], rows[~low]):
                todo.append((part, len(self.on)))
                for some, v in ((self.on, 0), (self.at, 0), (self.left, -1), (self.leaf, 0)):
                    some.append(v)
            many += 1
        number = 0
        for i, child in enumerate(self.left):
            if child < 0:
                self.leaf[i], number = number, number + 1
        self.leaves = number
        self.on, self.at, self.left, self.leaf = (np.array(x, np.int64) for x in (self.on, self.at, self.left, self.leaf))

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        while True:
            inner = np.flatnonzero(self.left[node] >= 0)
            if not len(inner):
                return self.leaf[node]
            n = node[inner]
            node[inner] = self.left[n] + (rows[inner, self.on[n]] > self.at[n])


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, vectors) of the vectors of a batch (columns ``dim``, ``v``)."""
    dims = batch.column("dim").to_numpy()
    lists = batch.column("v")
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        yield int(dim), at, lists.take(pa.array(at)).flatten().to_numpy().reshape(-1, dim)


def with_leaf(rows: DataFrame, dealers) -> DataFrame:
    """``rows`` (``dim``, ``v``, ...) with their ``leaf``; ``dealers`` is a broadcast of length -> :class:`Dealer`."""
    from pyspark.sql.types import IntegerType, StructField, StructType

    out = StructType([*rows.schema.fields, StructField("leaf", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = np.zeros(batch.num_rows, np.int32)
            for dim, at, vectors in _by_length(batch):
                if dim in dealers.value:
                    leaf[at] = dealers.value[dim].leaf_of(vectors)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=out.names)

    return rows.mapInArrow(run, out)


def leaf_boxes(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """length -> (leaves, lower edges, upper edges) over all vectors of each leaf: a box a task and leaf, then a box a leaf."""
    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            leaves = batch.column("leaf").to_numpy()
            for dim, at, vectors in _by_length(batch):
                for leaf in np.unique(leaves[at]):
                    some = vectors[leaves[at] == leaf]
                    lo, hi = some.min(axis=0), some.max(axis=0)
                    if (dim, leaf) in held:
                        lo, hi = np.minimum(lo, held[dim, leaf][0]), np.maximum(hi, held[dim, leaf][1])
                    held[dim, leaf] = lo, hi
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in held], pa.int32()), pa.array([int(k[1]) for k in held], pa.int32()),
                 pa.array([v[0] for v in held.values()], pa.list_(pa.int64())), pa.array([v[1] for v in held.values()], pa.list_(pa.int64()))],
                names=["dim", "leaf", "lo", "hi"])

    each = rows.select("dim", "v", "leaf").mapInArrow(boxes, "dim int, leaf int, lo array<long>, hi array<long>")
    edges = each.select("dim", "leaf", F.posexplode(F.arrays_zip("lo", "hi")).alias("d", "e")).groupBy("dim", "leaf", "d").agg(
        F.min("e.lo").alias("lo"), F.max("e.hi").alias("hi"))
    whole = edges.groupBy("dim", "leaf").agg(F.array_sort(F.collect_list(F.struct("d", "lo", "hi"))).alias("box"))
    out: dict[int, list] = {}
    for r in whole.collect():  # at most DEAL_LEAVES a length
        out.setdefault(r["dim"], []).append((r["leaf"], [e["lo"] for e in r["box"]], [e["hi"] for e in r["box"]]))
    return {dim: tuple(np.array(x, np.int64) for x in zip(*some, strict=True)) for dim, some in out.items()}


def reachable(queries: DataFrame, boxes) -> DataFrame:
    """A row per query (``query``, ``id``, ``v``, ``dim``, ``block``, ``bound``) and ``leaf`` whose box can hold the query's bound."""
    from pyspark.sql.types import IntegerType, StructField, StructType

    out = StructType([*queries.schema.fields, StructField("leaf", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = batch.column("bound").to_numpy()
            for dim, at, vectors in _by_length(batch):
                if dim not in boxes.value:
                    continue
                leaves, lo, hi = boxes.value[dim]
                widest = float(max(np.abs(lo).max(), np.abs(hi).max())) * float(np.abs(vectors).max(initial=0)) * dim
                kind = np.float64 if widest < EXACT else object  # exact either way, beyond 64 bits too
                for k in range(0, len(at), 256):
                    some, q = at[k:k + 256], vectors[k:k + 256].astype(kind)
                    reach = np.maximum(q, 0) @ hi.T.astype(kind) + np.minimum(q, 0) @ lo.T.astype(kind)
                    row, leaf = np.nonzero((reach >= bounds[some].astype(kind)[:, None]).astype(bool))
                    yield pa.RecordBatch.from_arrays(
                        [*batch.take(pa.array(some[row])).columns, pa.array(leaves[leaf], pa.int32())], names=out.names)

    return queries.mapInArrow(run, out)


def build_trees(vectors: DataFrame, leaf: int = LEAF_ROWS) -> DataFrame:
    """One row per shard of ``vectors`` (``dim``, ``leaf``, ``shard``, ``id``, ``v``)."""
    key = ["dim", "leaf", "shard"]

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = KdTree(group["id"].to_numpy(np.int64), np.stack(group["v"].to_numpy()).astype(np.int64), leaf)
        return pd.DataFrame([[*(group[c].iloc[0] for c in key), *tree.dump()]], columns=[*key, *TREE])

    return vectors.select(*key, "id", "v").groupBy(*key).applyInPandas(build, "dim int, leaf int, shard int, " + ", ".join(f"{c} binary" for c in TREE))


def search(pairs: DataFrame, k: int) -> DataFrame:
    """(``query``, ``query_id``, ``vec_id``, ``score``): the best k in its shard of every query of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(name)[r].as_py() for name in ("dim", "numbers", "own", "vs", "bounds", *TREE)}
                tree = KdTree.load([row[c] for c in TREE], row["dim"])
                own, bounds = np.array(row["own"], np.int64), np.array(row["bounds"], np.int64)
                asked = np.array(row["vs"], np.int64).reshape(-1, row["dim"])
                found = list(tree.search(asked, own, bounds, k))
                many = [len(ids) for ids, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(row["numbers"], np.int64), many)), pa.array(np.repeat(own, many)),
                     pa.array(np.concatenate([ids for ids, _ in found])), pa.array(np.concatenate([s for _, s in found]))],
                    names=["query", "query_id", "vec_id", "score"])

    return pairs.mapInArrow(run, "query long, query_id long, vec_id long, score long")


def best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector: str = "embedding",
          shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the ``k`` best rows of every query row."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector)).alias("v"), is_query.alias("asks"))
    rows = materialise(spark, rows.where("id is not null and v is not null").withColumn("dim", F.size("v")), "vectors")
    asked = rows.where("asks").count()
    dealers = spark.sparkContext.broadcast(_dealers(rows, shard_rows))
    rows = materialise(spark, with_leaf(rows, dealers), "dealt")
    boxes = spark.sparkContext.broadcast(leaf_boxes(rows))

    # A leaf of many vectors is several shards.
    sizes = rows.groupBy("dim", "leaf").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))  # DEAL_LEAVES a length
    sizes = materialise(spark, sizes, "leaf-sizes")
    dealt = rows.join(sizes, ["dim", "leaf"]).withColumn("shard", (F.rand(1) * F.col("shards")).cast("int"))
    trees = materialise(spark, build_trees(dealt, leaf_rows), "trees")

    blocks = max(1, -(-asked // block_rows))
    queries = rows.where("asks").select("id", "v", "dim", "leaf").distinct()
    queries = queries.withColumn("query", F.xxhash64("id", "v")).withColumn("block", F.pmod(F.col("query"), F.lit(blocks)).cast("int"))
    queries = materialise(spark, queries, "queries")

    def searched(sent: DataFrame) -> DataFrame:
        """Queries (with ``bound``, ``leaf`` and ``shard``) in blocks to the shards they are sent to."""
        one = F.collect_list(F.struct(F.col("query"), F.col("id"), F.col("v"), F.col("bound")))  # of a block
        block = (sent.groupBy("dim", "leaf", "shard", "block").agg(one.alias("all"))
                 .select("dim", "leaf", "shard", F.col("all.query").alias("numbers"), F.col("all.id").alias("own"),
                         F.flatten("all.v").alias("vs"), F.col("all.bound").alias("bounds")))
        return search(block.join(trees, ["dim", "leaf", "shard"]), k)

    sized = queries.join(sizes, ["dim", "leaf"]).withColumn("bound", F.lit(LOWEST))
    first = searched(sized.withColumn("shard", F.pmod(F.col("block"), F.col("shards")).cast("int")))
    kth = (best(first, k).groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("bound"))
           .where(F.col("n") == k).select("query", "bound"))
    bounded = queries.drop("leaf").join(kth, "query", "left").withColumn("bound", F.coalesce("bound", F.lit(LOWEST)))
    sent = reachable(bounded, boxes).join(sizes, ["dim", "leaf"])
    found = searched(sent.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))))
    return best(found, k).select("query_id", "rank", "vec_id", "score")


def _dealers(rows: DataFrame, shard_rows: int) -> dict[int, Dealer]:
    """A dealing tree for every length of vectors, from a sample by hash."""
    total = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = min(1.0, DEAL_SAMPLE / max(1, sum(total.values())))
    chosen = rows.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30))).select("dim", "v").limit(2 * DEAL_SAMPLE)
    by: dict[int, list] = {}
    for r in chosen.collect():
        by.setdefault(r["dim"], []).append(r["v"])
    return {dim: Dealer(np.array(some, np.int64), min(DEAL_LEAVES, -(-total[dim] // shard_rows))) for dim, some in by.items()}
