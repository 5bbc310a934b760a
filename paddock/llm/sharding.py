"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

Every shard owns ``vnodes`` points of a ring; a row's key hashes to a place on it and belongs to the
arc that ends at the next point clockwise.  Loads are bounded by ``ceil`` or ``floor`` of rows /
shards, so counts differ by one at most (law ``rows``): what overflows a full shard goes on clockwise
to the next shard with room.  A bound that tight depends on how many rows there are, not on how the
rows are spread, so the whole walk can be worked out from the row count of each arc — shards x vnodes
numbers, whatever the input — and each row only needs its rank within its arc.

Ranks come in two steps: an arc is cut into cells, cell counts are summed up in front of a row's cell,
and only the rows of a cell are sorted.  Cells are cut by a second hash of key and text, so even one
key that holds a third of all rows is spread over many.  One shard more or less moves the rows of the
arcs it takes over, plus what the new bounds make overflow; most rows stay.

Defined results
* null text has size 8 and the CRC of no bytes; a null key is a key like any other;
* repeated rows get places of their own; an empty table gives an empty result;
* columns other than the key and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paddock.llm.common import materialise

SHARDS = 24
VNODES = 64
CELLS = 64
RING = 1 << 48


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, clockwise; a shard's places depend on its number alone."""
    import hashlib

    def place(shard: int, k: int) -> int:
        return int.from_bytes(hashlib.sha256(f"shard {shard} node {k}".encode()).digest()[:6], "big")

    return sorted((place(s, k), s) for s in range(shards) for k in range(vnodes))


def walk(arcs: list[int], owner: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Where the rows of each arc go: (arc, first rank, last rank, shard, first slot).

    Every shard first takes rows of its own arcs, in ring order, up to its bound; what is left over
    walks on clockwise.  Bounds add up to the number of rows, so all of them are met exactly."""
    total = sum(arcs)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    taken = [0] * shards
    moves: list[tuple[int, int, int, int, int]] = []

    def give(arc: int, rank: int, n: int, shard: int) -> int:
        n = min(n, room[shard] - taken[shard])
        if n > 0:
            moves.append((arc, rank, rank + n - 1, shard, taken[shard]))
            taken[shard] += n
        return max(n, 0)

    waiting: list[tuple[int, int, int]] = []  # (arc, rank, rows) on their way clockwise
    for arc, n in enumerate(arcs):
        got = give(arc, 0, n, owner[arc])
        if got < n:
            waiting.append((arc, got, n - got))
    for arc, rank, n in waiting:
        at = arc
        while n:
            at = (at + 1) % len(arcs)
            got = give(arc, rank, n, owner[at])
            rank, n = rank + got, n - got
    return moves


def arc_of(places: list[int], at: Column) -> Column:
    """Number of the first of ``places`` (ascending) at or after ``at``; past the last one, 0.

    The ring is cut into equal slices; a literal array holds how many places lie before a slice and
    another the few within it, so a row compares with those only."""
    slices = 1 << (2 * len(places)).bit_length()
    width = RING // slices
    inside: list[list[int]] = [[] for _ in range(slices)]
    for p in places:
        inside[p // width].append(p)
    before = [0]
    for some in inside[:-1]:
        before.append(before[-1] + len(some))
    one = F.floor(at / F.lit(width)).cast("int") + 1
    counts = F.expr(f"array({','.join(map(str, before))})")
    points = F.expr("array(" + ",".join(
        "array(" + ",".join(f"{p}L" for p in some) + ")" if some else "cast(array() as array<bigint>)" for some in inside) + ")")
    passed = F.size(F.filter(F.element_at(points, one), lambda p: p < at))
    return ((F.element_at(counts, one) + passed) % len(places)).cast("int")


def assign(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, cells: int = CELLS,
           id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot``."""
    spark: SparkSession = docs.sparkSession
    nodes = ring(shards, vnodes)
    places, owner = [p for p, _ in nodes], [s for _, s in nodes]
    content = F.coalesce(F.col(text), F.lit(""))
    at = F.pmod(F.xxhash64(F.lit("ring"), F.col(id_col)), F.lit(RING))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(content).cast("long") + 8).alias("size"),
        F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"), at.alias("__at"))
    rows = rows.select("doc_id", "size", "text_crc32",
                       arc_of(places, F.col("__at")).alias("arc"),
                       F.pmod(F.xxhash64(F.lit("cell"), "doc_id", "text_crc32", "size"), F.lit(cells)).cast("int").alias("cell"))
    rows = materialise(spark, rows, "ring-rows")

    counts = rows.groupBy("arc", "cell").agg(F.count(F.lit(1)).alias("n"))  # arcs x cells rows at most
    before = counts.select("arc", "cell", F.coalesce(F.sum("n").over(
        Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    per_arc = {r["arc"]: r["n"] for r in counts.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    moves = walk([per_arc.get(a, 0) for a in range(len(nodes))], owner, shards)
    target = spark.createDataFrame(moves, "arc int, first long, last long, shard int, slot long")

    in_cell = F.row_number().over(Window.partitionBy("arc", "cell").orderBy("doc_id", "text_crc32", "size"))
    ranked = (rows.withColumn("rank", in_cell - 1).join(F.broadcast(before), ["arc", "cell"])
              .withColumn("rank", F.col("rank") + F.col("before")))
    # `moves` has at most arcs + shards x arcs rows, whatever the input.
    t = F.broadcast(target)
    return (ranked.join(t, (ranked["arc"] == t["arc"]) & ranked["rank"].between(t["first"], t["last"]))
            .select("doc_id", "size", "text_crc32", "shard", (t["slot"] + F.col("rank") - t["first"]).alias("slot")))
