"""Exact self-join of documents by Jaccard similarity of word shingles, in the metric space of distances.

``d = 1 - |a & b| / |a | b|`` is a metric, so pivots and the triangle inequality can do the work:

1. Regions.  Shingles are ordered globally, rare ones first.  Two linked documents share several of
   the first ``n - ceil(t n) + l`` shingles of each, so the documents that hold a shingle there meet around
   a pivot, the smallest of them.  Each document is replicated into the regions of its rare shingles' pivots
   (near copies have the same pivot again and again, so few regions each), except for those that so few
   of its shingles lead to that a link could not depend on them.
2. Windows.  The distance of every member to its pivot is exact.  Within ``r = 1 - t`` it is a link.
   ``|d(a, p) - d(b, p)| <= d(a, b)``: a member without a member of another component within ``r`` of
   its own distance is done.
3. Recursion.  What remains of a region gets new pivots; members go to the nearest one's Voronoi cell,
   and into every other cell whose pivot is at most ``2 r`` farther; cells are windowed again.  Pivots
   have met every member, so each round takes them out.  It goes on in a cell as long as a round takes a quarter off the
   members outside its largest component, and they are more than ``LEAF``.
4. Leaves.  A family of copies whose members are as far from each other as from any pivot can't be split by distances.
   Members of such a cell are told apart by their differences from the pivot (:func:`delta_sets`): by the triangle
   inequality in counts, ``|a ^ b| >= ||a ^ p| - |b ^ p||``, and more sharply ``|a ^ b| = |a ^ p| + |b ^ p| - 2 |common
   differences|``, two members that far from the pivot are linked only if they share a given number of differences.  Those
   that are nobody else's are dropped, the others ordered by rarity, and a prefix join with positional filter names the
   pairs to verify (:func:`delta_links`).  It meets samples of rising rate first, all members last: a member with very many
   links finds one in a small sample and is done, so the pairs grow with the members, not with their square.

Documents with equal sets are one node, and links already known make one component of two nodes, so
a large group of copies or near copies costs one distance a member, never its pairs.

Rarity comes from counts of all shingles of all documents in a fixed number of hashed cells: whatever
the input, the table is ``2**SKETCH_BITS`` bytes.  It only orders shingles; any order gives the same links.
Sets are told apart by 64-bit fingerprints, shingles by 64-bit hashes.

Defined results
* null, empty and blank texts have 0 shingles and no links: their component is their own id;
* fewer words than a shingle has: the whole sequence is one shingle;
* repeated rows and equal texts are linked; a null id never becomes a component's id unless all are null;
* columns other than id and text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from paddock.llm.common import fresh_name, materialise, materialise_bucketed
from paddock.llm.components import components
from paddock.llm.shingles import fingerprint, shingle_set

PERCENT = 75
SHINGLE = 5
SKETCH_BITS = 22     # cells of the rarity counts: a byte each, 4 MB, on the driver and in each task
SLACK = 10           # percent of its shingles that a document's prefix has beyond the shortest right one
BLOCK_BITS = 14
FILTER_BITS = 25     # bits of the filter of documents whose sets are needed: 4 MB
LEAF = 64
PIVOTS = 16          # about so many new pivots of a cell in each round
SAMPLE = 64          # members that a leaf's open members meet in the first round; 16 times as many in each later one
STEP = 0.05          # width of a distance class of the windows


def signatures(docs: DataFrame, shingle: int = SHINGLE, bits: int = SKETCH_BITS) -> DataFrame:
    """In one pass over the texts: a row (``doc_id``, ``n``, ``fp``) per document, and the task's shingle
    counts in blocks (``part``, ``block``, ``counts``)."""
    block = 1 << min(BLOCK_BITS, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, part = np.zeros(1 << bits, np.uint32), TaskContext.get().partitionId()
        for batch in batches:
            n, fp = [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text or "", shingle)
                np.add.at(counts, (s >> np.uint64(64 - bits)).astype(np.int64), 1)
                n.append(len(s))
                fp.append(fingerprint(s))
            yield _rows(out, doc_id=batch.column(0), n=n, fp=fp)
        for k in range(0, len(counts), block):
            some = counts[k:k + block]
            if some.any():
                yield _rows(out, part=[part], block=[k // block], counts=[_pack(some)])

    rows = docs.select("doc_id", "text")
    out = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n", T.LongType()),
                        T.StructField("fp", T.LongType()), T.StructField("part", T.IntegerType()),
                        T.StructField("block", T.IntegerType()), T.StructField("counts", T.BinaryType())])
    return rows.mapInArrow(run, out)


def _pack(counts: np.ndarray) -> bytes:
    return pa.compress(counts.astype("<u4").tobytes(), codec="zstd", asbytes=True)


def _rows(schema: T.StructType, **cols) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    size = len(next(iter(cols.values())))
    return pa.RecordBatch.from_arrays(
        [(c if isinstance(c := cols.get(f.name), pa.Array) else pa.array(c, f.type)) if f.name in cols else pa.nulls(size, f.type)
         for f in arrow], schema=arrow)


def rarity(spark: SparkSession, blocks: DataFrame, bits: int = SKETCH_BITS) -> np.ndarray:
    """Counts of all tasks added up, in classes of a logarithmic scale (a byte each)."""
    block = 1 << min(BLOCK_BITS, bits)
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
                           T.StructField("counts", T.BinaryType())])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(block, np.uint64)
        for batch in batches:
            for packed in batch.column("counts").to_pylist():
                total += np.frombuffer(pa.decompress(packed, block * 4, "zstd", asbytes=True), "<u4")
        yield _rows(schema, part=[key[0].as_py()], block=[key[1].as_py()], counts=[_pack(np.minimum(total, 2**32 - 1))])

    # A tree: each level adds up 64 tasks a block, so no group grows with the input.
    parts = (blocks.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        blocks = (blocks.withColumn("part", (F.col("part") / 64).cast("int"))
                  .groupBy("part", "block").applyInArrow(add, schema))
        parts = -(-parts // 64)
        if parts == 1:
            break

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, packed in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total = np.frombuffer(pa.decompress(packed, block * 4, "zstd", asbytes=True), "<u4").astype(np.float32)
                yield _rows(schema, part=[0], block=[at], counts=[np.round(7 * np.log2(1 + total)).astype(np.uint8).tobytes()])

    scale = np.zeros(1 << bits, np.uint8)
    for r in blocks.mapInArrow(grade, schema).toLocalIterator():  # 2**bits bytes, whatever the input
        scale[r["block"] * block:(r["block"] + 1) * block] = np.frombuffer(bytes(r["counts"]), np.uint8)
    return scale


def prefixes(docs: DataFrame, scale, shingle: int = SHINGLE, percent: int = PERCENT, bits: int = SKETCH_BITS,
             slack: int = SLACK) -> DataFrame:
    """(``s``, ``fp``): the rare shingles by which a document must meet whatever it is linked with.

    Linked documents of n and m shingles share ``ceil(t n)`` at least, so of the first ``n - ceil(t n) + l`` of each
    they share ``l`` at least; ``l`` is ``SLACK`` percent of the smaller one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = scale.value
        for batch in batches:
            keys, fps = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for text in batch.column(0).to_pylist():
                s = shingle_set(text or "", shingle)
                if len(s):
                    first = len(s) + percent * -len(s) // 100 - slack * -len(s) // 100
                    rare = classes[(s >> np.uint64(64 - bits)).astype(np.int64)]
                    order = np.argsort((rare.astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8)), kind="stable")
                    keys.append(s[order[:first]])
                    fps.append(np.full(first, fingerprint(s)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(fps))],
                                             names=["s", "fp"])

    return docs.select("text").mapInArrow(run, "s long, fp long")


def needed_in_common(n: Column, m: Column, percent: int, slack: int) -> Column:
    """A lower bound of how many shingles the prefixes of linked documents of n and m shingles share.

    Linked, they share ``t (n + m) / (1 + t)`` in all, of which no more can lie behind either prefix than it leaves."""
    whole, behind = percent / (100 + percent) * (n + m), (percent - slack) / 100
    return whole - behind * F.greatest(n, m) - 1


def regions(keys: DataFrame, nodes: DataFrame, percent: int = PERCENT, slack: int = SLACK) -> DataFrame:
    """(member ``a``, pivot ``b``): the pivot of a shingle is the smallest document that holds it.

    A document leaves the regions that few of its shingles lead to.  Linked documents of n >= m >= t n shingles
    share ``slack m`` in their prefixes; each leaves less than ``slack t / (1 + t)`` of its own number behind, together
    less than ``slack m``, so one shingle's region at least keeps them both.  It also leaves a region where it
    can't be linked with a document of any size in it, as it has too few shingles that any other one has."""
    spark = keys.sparkSession
    shared = (keys.groupBy("s").agg(F.min("fp").alias("pivot"), F.max("fp").alias("last"))
              .where("pivot <> last").select("s", "pivot"))
    shared = materialise(spark, shared, "shared")
    led = keys.join(shared, "s").groupBy(F.col("fp").alias("a"), F.col("pivot").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    one = Window.partitionBy("a")  # a document has at most its prefix of regions
    others = F.when(F.col("a") != F.col("b"), F.col("c")).otherwise(0)
    led = led.withColumn("common", F.sum("c").over(one)).withColumn("below", F.sum(others).over(one.orderBy(others, "b")))
    led = led.join(nodes.select(F.col("fp").alias("a"), "n"), "a")
    led = materialise(spark, led.where((F.col("a") == F.col("b")) | (F.col("below") * (100 * (100 + percent)) >= slack * percent * F.col("n"))), "led")
    sizes = led.groupBy("b").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    low = F.greatest(F.col("least"), F.col("n") * (percent / 100))
    high = F.least(F.col("most"), F.col("n") / (percent / 100))
    bound = F.least(needed_in_common(F.col("n"), low, percent, slack), needed_in_common(F.col("n"), high, percent, slack))
    return led.where("a <> b").join(sizes, "b").where(F.col("common") >= bound).select("a", "b", "common")


def needed_sets(docs: DataFrame, nodes: DataFrame, needed: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(``fp``, ``shingles``) of the nodes in ``needed`` (``fp``), from one document of each.

    A bit filter of their documents' ids (bounded, so it lets more pass as it fills) spares the others the
    trip to Python; the join by fingerprint decides."""
    spark = docs.sparkSession
    of = nodes.join(needed, "fp").select("doc_id")
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    held = (of.select((bit + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect())
    bitmap = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in held:  # buckets of 4096 bytes, numbered from 1
        bitmap[(r["bucket"] - 1) * 4096:r["bucket"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    shared = spark.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(1).to_numpy()
            take = (shared.value[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1
            fps, sets = [], []
            for text in batch.column(0).filter(pa.array(take.astype(bool))).to_pylist():
                s = shingle_set(text or "", shingle)
                fps.append(fingerprint(s))
                sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["fp", "shingles"])

    rows = docs.select("text", bit.alias("bit"))
    sets = rows.mapInArrow(run, "fp long, shingles array<long>").join(needed, "fp", "left_semi")
    return sets.dropDuplicates(["fp"])


def distances(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``pairs`` (``a``, ``b``, ...) with the exact distance ``d`` and whether it is a ``link``.

    ``sets`` is bucketed by fingerprint and stays where it is.  Few documents are a ``b`` (a pivot), but one may have very
    many members: their sets are dealt out for a join that can split it."""
    pivots = pairs.select(F.col("b").alias("fp")).distinct()
    pivots = materialise(sets.sparkSession, sets.join(pivots, "fp", "left_semi"), "pivot-sets")
    one = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("sa"))
    two = pivots.select(F.col("fp").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    both = both.withColumn("common", common).withColumn("all", F.size("sa") + F.size("sb") - F.col("common"))
    return both.select(*pairs.columns, (1 - F.col("common") / F.col("all")).alias("d"),
                       (100 * F.col("common") >= percent * F.col("all")).alias("link"))


def with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return (rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))


def undecided(members: DataFrame, roots: DataFrame, radius: float) -> DataFrame:
    """Members (``cell``, ``node``, ``d``) with ``root`` that have one of another component in their window."""
    rows = with_roots(members, roots).withColumn("class", F.floor(F.col("d") / STEP).cast("int"))
    reach = int(radius / STEP + 1e-6) + 1
    classes = rows.groupBy("cell", "class").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    windows = (classes.select("cell", F.explode(F.sequence(F.col("class") - reach, F.col("class") + reach)).alias("class"), "lo", "hi")
               .groupBy("cell", "class").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi")
               .select("cell", "class"))
    return rows.join(windows, ["cell", "class"], "left_semi").drop("class")


def distances_in_cells(members: DataFrame, pivots: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(``cell``, ``a``, ``b``, ``d``, ``link``) of every member (``cell``, ``node``) and pivot (``cell``, ``pivot``) of a
    cell.  Each set travels once for each cell it is in, not once for each pair, and a cell
    with very many members can be split."""
    one = members.join(sets.select(F.col("fp").alias("node"), F.col("shingles").alias("sa")), "node")
    two = pivots.join(sets.select(F.col("fp").alias("pivot"), F.col("shingles").alias("sb")), "pivot")
    two = two.withColumnRenamed("cell", "x_cell")
    both = one.join(two, (F.col("cell") == F.col("x_cell")) & (F.col("node") != F.col("pivot")))
    both = both.withColumn("common_n", F.size(F.array_intersect("sa", "sb")).cast("long"))
    both = both.withColumn("all_n", F.size("sa") + F.size("sb") - F.col("common_n"))
    return both.select("cell", F.col("node").alias("a"), F.col("pivot").alias("b"), (1 - F.col("common_n") / F.col("all_n")).alias("d"),
                       (100 * F.col("common_n") >= percent * F.col("all_n")).alias("link"))


def delta_sets(spark: SparkSession, leaves: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """A row per member (``cell``, ``ref``, ``node``, ``root``, ``main``) of a leaf with what sets it apart from the pivot ``ref``:
    ``delta``, the differences that members of other components have too, rare ones first, their number ``len``,
    and ``e``, ``g``, ``class``.

    With ``D = a ^ p`` let ``e(a) = (100 + percent) |D| - (100 - percent) |a|``.  Then a and b are linked if and only if
    ``e(a) + e(b) <= 2 (100 + percent) |D(a) & D(b)|``.  As the right side is at most that of a's own ``len``, b is out of the
    question if ``e(b) > g(a) = 2 (100 + percent) len(a) - e(a)``.  Classes of ``e`` are as wide as a quarter of what
    members linked with the pivot spread over, and grow with ``e`` beyond that, so a cell has few."""
    far, near = 100 + percent, 100 - percent
    refs = materialise(spark, sets.join(leaves.select(F.col("ref").alias("fp")).distinct(), "fp", "left_semi"), "leaf-pivots")
    rows = (leaves.join(sets.select(F.col("fp").alias("node"), F.col("shingles").alias("sa")), "node")
            .join(refs.select(F.col("fp").alias("ref"), F.col("shingles").alias("sb")), "ref"))
    rows = rows.withColumn("delta", F.concat(F.array_except("sa", "sb"), F.array_except("sb", "sa")))
    e = (far * F.size("delta") - near * F.size("sa")).cast("long")
    rows = rows.select("cell", "node", "root", "main", "delta", e.alias("e"), (near * F.size("sb")).cast("long").alias("reach"))
    rows = materialise(spark, rows, "leaf-deltas")
    each = rows.select("cell", "node", "root", F.explode("delta").alias("s"))
    shared = (each.groupBy("cell", "s").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("held"))
              .where("lo <> hi").select("cell", "s", "held"))
    kept = (each.join(shared, ["cell", "s"]).groupBy("cell", "node")
            .agg(F.array_sort(F.collect_list(F.struct("held", "s"))).alias("kept")))  # at most a member's own differences
    rows = rows.drop("delta").join(kept.select("cell", "node", F.col("kept.s").alias("delta")), ["cell", "node"])
    rows = rows.withColumn("len", F.size("delta")).withColumn("g", 2 * far * F.col("len") - F.col("e"))
    linear = F.floor((F.col("e") + F.col("reach")) * 2 / F.col("reach"))
    beyond = 4 + F.floor(2 * F.log2(F.greatest(F.col("e"), F.col("reach")) / F.col("reach")))
    rows = rows.withColumn("class", F.when(F.col("e") <= F.col("reach"), linear).otherwise(beyond).cast("int"))
    return materialise(spark, rows.drop("reach"), "deltas")


def _postings(rows: DataFrame, classes: DataFrame, own: str, other: str, percent: int) -> DataFrame:
    """The prefix of each member's ``delta`` for every class of the other side that may hold a partner.  Partners of class
    ``k`` share ``(e + lo(k)) / (2 (100 + percent))`` differences at least, so one of the first ``len`` less that, plus one."""
    k = classes.select(F.col("cell").alias("k_cell"), F.col("class").alias(other), "lo", "top")
    need = F.greatest(F.lit(1), F.ceil((F.col("e") + F.col("lo")) / (2 * (100 + percent)) - 1e-9)).cast("int")
    on = ((F.col("cell") == F.col("k_cell")) & (F.col("e") <= F.col("top")) & (F.col("lo") <= F.col("g")))
    met = rows.withColumnRenamed("class", own).join(k, on).withColumn("need", need).where("need <= len")
    first = F.slice("delta", F.lit(1), F.col("len") - F.col("need") + 1)
    return met.select("cell", own, other, "node", "top_root", "is_main", "e", "g", "len", F.posexplode(first).alias("at", "s"))


def leaf_candidates(open_rows: DataFrame, some: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (``cell``, ``a``, ``b``) of an open member and one of ``some`` that may be linked: prefix, length and
    positional filters on the differences."""
    def classes(of: DataFrame) -> DataFrame:
        return of.groupBy("cell", "class").agg(F.min("e").alias("lo"), F.max("g").alias("top"))

    x = _postings(open_rows, classes(some), "cx", "cy", percent)
    y = _postings(some, classes(open_rows), "cy", "cx", percent)
    y = y.select("cell", "cx", "cy", "s", *[F.col(c).alias(f"y_{c}") for c in ("node", "top_root", "is_main", "e", "g", "len", "at")])
    # What the pair can share: what stands before the place of this one in both, and after it in both.
    most = F.least("at", "y_at") + F.least(F.col("len") - F.col("at"), F.col("y_len") - F.col("y_at"))
    fits = ((F.col("top_root") != F.col("y_top_root")) & (F.col("e") <= F.col("y_g")) & (F.col("y_e") <= F.col("g"))
            & (F.col("e") + F.col("y_e") <= 2 * (100 + percent) * most))
    return (x.join(y, ["cell", "cx", "cy", "s"]).where(fits)
            .select("cell", F.col("node").alias("a"), F.col("y_node").alias("b")).distinct())


def delta_links(spark: SparkSession, leaves: DataFrame, sets: DataFrame, roots: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Roots after all links within leaves (``cell``, ``ref``, ``node``, ``root``, ``main``).

    An open member is one outside its cell's largest component.  Round by round the open ones meet a larger sample (by hash) of
    their cell, and the last one all of it."""
    rows = delta_sets(spark, leaves, sets, percent)
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
    rows = materialise(spark, rows.join(sizes, "cell"), "leaf-rows")
    largest = rows.agg(F.max("m")).first()[0] or 0
    sample = SAMPLE
    while largest:
        now = roots.select("node", F.col("root").alias("top_root"))
        tops = roots.select(F.col("node").alias("main"), F.col("root").alias("main_top"))
        state = (rows.join(now, "node", "left").join(tops, "main", "left")
                 .withColumn("top_root", F.coalesce("top_root", "node"))
                 .withColumn("is_main", F.col("top_root") == F.coalesce("main_top", "main")))
        state = materialise(spark, state.drop("root", "main", "main_top"), "leaf-state")
        some = state.where(F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 30)) * F.col("m") < F.lit(sample << 30).cast("long"))
        found = materialise(spark, leaf_candidates(state.where("not is_main"), some, percent), "leaf-candidates")
        held = state.select("cell", "node", "e", "delta")
        pairs = (found.join(held.withColumnsRenamed({"node": "a", "e": "ea", "delta": "da"}), ["cell", "a"])
                 .join(held.withColumnsRenamed({"node": "b", "e": "eb", "delta": "db"}), ["cell", "b"]))
        linked = F.col("ea") + F.col("eb") <= 2 * (100 + percent) * F.size(F.array_intersect("da", "db"))
        roots = _merge(spark, roots, pairs.where(linked).select("a", "b"))
        if sample >= largest:
            break
        sample *= 16
    return roots


def _merge(spark: SparkSession, roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots after more links: components of the graph whose nodes are the roots so far."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    edges = (links.select("a", "b").join(a, "a", "left").join(b, "b", "left")
             .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b").distinct())
    edges = materialise(spark, edges, "root-links")
    if edges.isEmpty():
        return roots
    up = components(spark, edges)
    old = (roots.join(up.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
           .select("node", F.coalesce("top", "root").alias("root")))
    new = up.join(roots.select("node"), "node", "left_anti")
    return materialise(spark, old.unionByName(new), "roots")


def join_regions(spark: SparkSession, pairs: DataFrame, sets: DataFrame, percent: int = PERCENT,
                 leaf: int = LEAF, pivots_each: int = PIVOTS) -> DataFrame:
    """``node``, ``root`` of every node that is linked; ``pairs`` are the (member ``a``, pivot ``b``) of regions."""
    radius = 1 - percent / 100
    met = materialise(spark, distances(pairs.select("a", "b"), sets, percent), "regions")
    roots = components(spark, met.where("link"))
    # A pivot is a member of its own region at distance 0, but has met everyone in it.
    members = met.select(F.col("b").alias("cell"), F.col("b").alias("ref"), F.col("a").alias("node"), "d", F.lit(None).cast("long").alias("was"))
    aside, k = [], 0
    while True:
        left = undecided(members, roots, radius)
        parts = left.groupBy("cell", "root").agg(F.count(F.lit(1)).alias("m"))
        main = parts.groupBy("cell").agg(F.sum("m").alias("all"), F.max(F.struct("m", "root")).alias("main"))
        main = main.select("cell", F.col("main.root").alias("main"), (F.col("all") - F.col("main.m")).alias("others"))
        left = materialise(spark, left.join(main, "cell"), "undecided")
        # Every open pair has a member outside its cell's largest component.  Few of those, or hardly fewer than the round
        # before: a leaf.
        done = (F.col("others") <= leaf) | F.coalesce(4 * F.col("others") > 3 * F.col("was"), F.lit(False))
        aside.append(left.where(done).select("cell", "ref", "node", "root", "main"))
        large = left.where(~done)
        # Else new pivots.  A cell's member nearest to the last one is near the middle of a family of copies: it goes
        # first, alone.  Later it is joined by about k members outside the largest component, by hash.
        first = large.groupBy("cell").agg(F.min(F.struct("d", "node")).alias("near")).select("cell", F.col("near.node").alias("pivot"))
        chance = F.pmod(F.xxhash64("node", F.lit(k)), F.lit(1 << 30)) < (1 << 30) * min(k, pivots_each) / F.col("others")
        pivots = (large.where((F.col("root") != F.col("main")) & chance).select("cell", F.col("node").alias("pivot"))
                  .unionByName(first).distinct())
        pivots = materialise(spark, pivots, "pivots")
        if pivots.isEmpty():
            break
        meet = distances_in_cells(large.select("cell", "node"), pivots, sets, percent)
        meet = materialise(spark, meet, "voronoi")
        roots = _merge(spark, roots, meet.where("link").select("a", "b"))
        # Every member but the pivots goes on: into the cell of its nearest pivot, and of every other that is at most
        # 2 r farther.  A cell that this would not thin out (its members are as far from each other as from
        # any pivot) stays whole, with the distances to one pivot.
        to = F.collect_list(F.struct("b", "d"))  # one for each pivot of the cell
        on = meet.groupBy("cell", "a").agg(to.alias("to"), F.min("d").alias("near"))
        on = on.withColumn("close", F.filter("to", lambda t: t["d"] <= F.col("near") + 2 * radius + 1e-9))
        on = materialise(spark, on.select("cell", "a", "close", F.array_min("to").alias("one")), "cells")
        on = on.join(pivots.select("cell", F.col("pivot").alias("a")), ["cell", "a"], "left_anti")  # one row a member
        thin = on.groupBy("cell").agg((F.sum(F.size("close")) <= 2 * F.count(F.lit(1))).alias("thin"))
        before = large.groupBy("cell").agg(F.max("others").alias("was"))
        goes = F.when(F.col("thin"), F.col("close")).otherwise(F.array("one"))
        members = on.join(thin, "cell").join(before, "cell").select("cell", F.col("a").alias("node"), "was", "thin", F.explode(goes).alias("t"))
        # The round with one pivot has shown nothing yet about how far others thin out.
        members = members.select(F.when(F.col("thin"), F.xxhash64("cell", "t.b")).otherwise(F.col("cell")).alias("cell"),
                                 F.col("t.b").alias("ref"), "node", F.col("t.d").alias("d"), (F.col("was") if k else F.lit(None).cast("long")).alias("was"))
        k += pivots_each
    leaves = aside[0]
    for more in aside[1:]:
        leaves = leaves.unionByName(more)
    return delta_links(spark, leaves, sets, roots, percent)


def jaccard_join(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, bits: int = SKETCH_BITS,
                 leaf: int = LEAF, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id linked with it, directly or not),
    ``copies`` (documents with the same set)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    found = materialise(spark, signatures(docs, shingle, bits), "signatures")
    rows = found.where("n is not null").select("doc_id", "n", "fp")
    scale = spark.sparkContext.broadcast(rarity(spark, found.where("block is not null").select("part", "block", "counts"), bits))
    nodes = materialise(spark, rows.where("n > 0").groupBy("fp").agg(
        F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")), "nodes")

    keys = materialise(spark, prefixes(docs, scale, shingle, percent, bits), "prefixes")
    pairs = materialise(spark, regions(keys, nodes, percent), "pairs")
    needed = materialise(spark, pairs.select(F.col("a").alias("fp")).unionAll(pairs.select("b")).distinct(), "needed")
    sets, _ = materialise_bucketed(spark, needed_sets(docs, nodes, needed, shingle), "sets", "fp")
    roots = join_regions(spark, pairs, sets, percent, leaf)

    ids = with_roots(nodes.withColumnRenamed("fp", "node"), roots)
    tops = ids.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    known = ids.join(tops, "root").select(F.col("node").alias("fp"), "component_id", "copies")
    # Empty documents are nodes of their own.
    return (rows.join(known, "fp", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.when(F.col("n") > 0, F.col("copies")).otherwise(1).alias("copies")))


def one_per_component(docs: DataFrame, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, less all but the first of every component.

    Rows are numbered by their place in the files ``docs`` is read from, so repeated and null ids don't
    matter; give it a table, not a frame that may come in another order when it is read again."""
    row = fresh_name("__row", docs)
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    joined = jaccard_join(numbered, percent, id_col=row, text=text)
    first = joined.where("doc_id = component_id").select(F.col("doc_id").alias(row))
    return numbered.join(first, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
