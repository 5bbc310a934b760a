"""Importance resampling towards a target: documents are drawn by how far their hashed n-grams favour the target's.

Overlapped regular-expression scanning.  A text's bytes are lower-cased (A-Z only), every run of separators collapses to
one space, and for each n a pattern of n words, held between lookarounds for word boundaries, is run with
``overlapped=True``: its matches are the n-gram spans themselves, whose CRC-32 modulo ``buckets`` is the feature.

1. One scan of the texts writes each document's features (two or four bytes each) and each task's bucket counts to the
   shared folder; the target's texts only give counts.  Counts of all tasks are added up by an aggregation.
2. A bucket's gain is ``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))``: ``buckets`` numbers, whatever the input.  A
   document's weight is the sum of its features' gains.
3. The Gumbel top-k trick draws without replacement: the score is the weight plus noise from a hash of the id, and
   the highest scores are drawn.  Ranks come from a range partitioning by score: a row's place in its partition
   plus the sizes of those before it; no window holds all rows, and rows of equal score and id are told apart by
   their place in the table, so no partition must hold them all.

Defined results
* null and empty texts have no words: weight 0, and they are drawn only if ``min_words`` is 0;
* a null id has no noise: score and rank are null, and the row isn't counted among those to draw from;
* repeated rows are drawn one by one, in any order among themselves; ties of the score go to the smaller id;
* very long texts are scanned whole, once; columns other than id and text are not read;
* an empty table gives an empty result; an empty target gives gains as its counts of 0 say.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import starmap

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm.common import materialise

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024

# Separators: ASCII other than digits and letters, once A-Z are lower-cased.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_RUN = regex.compile(rb" {2,}")


def gram_pattern(n: int) -> regex.Pattern:
    """A span of n words of a text whose words stand one space apart."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def collapse(text: str | None) -> bytes:
    """The text's words in UTF-8, A-Z lower-cased, one space between them."""
    return _RUN.sub(b" ", (text or "").encode().translate(_FOLD)).strip(b" ")


def buckets_of(words: bytes, patterns: list[regex.Pattern], buckets: int) -> np.ndarray:
    """The bucket of every n-gram, repeats included."""
    view, crc = memoryview(words), zlib.crc32
    return np.fromiter(
        (crc(view[a:b]) for p in patterns for a, b in (m.span() for m in p.finditer(words, overlapped=True))), np.int64) % buckets


def features(docs: DataFrame, n_min: int = 1, n_max: int = 1, buckets: int = BUCKETS, keep: bool = True) -> DataFrame:
    """In one pass over the texts (``doc_id``, ``text``): a row (``doc_id``, ``n_words``, ``n_features``, ``codes``) per document,
    if ``keep``, and a row with the task's bucket ``counts``."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    rows = docs.select("doc_id", "text")
    out = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
                        T.StructField("n_features", T.LongType()), T.StructField("codes", T.BinaryType()),
                        T.StructField("counts", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = list(map(gram_pattern, range(n_min, n_max + 1)))
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            n_words, n_features, codes = [], [], []
            for text in batch.column(1).to_pylist():
                words = collapse(text)
                found = buckets_of(words, patterns, buckets)
                total += np.bincount(found, minlength=buckets)
                n_words.append(words.count(b" ") + 1 if words else 0)
                n_features.append(len(found))
                codes.append(found.astype(kind).tobytes() if keep else b"")
            if keep:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), pa.array(codes, pa.binary()),
                     pa.nulls(batch.num_rows, pa.list_(pa.int64()))], names=out.names)
        if total.any():
            lone = [pa.nulls(1, batch_type) for batch_type in _arrow_types(out)[:4]]
            yield pa.RecordBatch.from_arrays([*lone, pa.array([total], pa.list_(pa.int64()))], names=out.names)

    return rows.mapInArrow(run, out)


def _arrow_types(schema: T.StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(schema).types)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of all tasks added up: ``buckets`` rows reach the driver, whatever the input."""
    added = (found.where("counts is not null").select(F.posexplode("counts").alias("bucket", "n"))
             .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(buckets, np.int64)
    for r in added:
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` of each bucket, in doubles."""
    size = len(source)
    whole_s, whole_t = float(source.sum() + size), float(target.sum() + size)
    return np.array(list(starmap(lambda s, t: math.floor(1000 * math.log(((t + 1.0) * whole_s) / ((s + 1.0) * whole_t))),
                                 zip(source.tolist(), target.tolist(), strict=True))), np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of SHA-256 of ``seed:id``."""
    digest = F.sha2(F.encode(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), "UTF-8"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` of every document of :func:`features`."""
    rows = found.where("counts is null").select("doc_id", "n_words", "n_features", "codes")
    table = rows.sparkSession.sparkContext.broadcast(gain)
    kind = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")
    out = T.StructType([*rows.schema.fields[:3], T.StructField("weight", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(table.value[np.frombuffer(codes, kind)].sum()) for codes in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=out.names)

    return rows.mapInArrow(run, out)


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3, ... in the given order, by a range partitioning."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The number holds the partition above 33 bits and the row's place in it below; it is stored, so it stays as it is.
    dealt = (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
             .withColumn("at", F.monotonically_increasing_id()))
    dealt = materialise(spark, dealt, "ranked")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r["part"], r["n"]) for r in dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()  # one number a partition
    starts = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before[:-1], strict=True)], "part long, before long")
    dealt = dealt.withColumn("part", part)
    return dealt.join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + place + 1).drop("part", "before", "at")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, n_min: int = 1, n_max: int = 1, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, seed: int = SEED, id_col: str = "doc_id", text: str = "text",
             target_text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` (null: not drawn).

    Of the documents with at least ``min_words`` words, ``percent`` per cent are drawn."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), F.col(target_text).alias("text"))
    found = materialise(spark, features(docs, n_min, n_max, buckets), "features")
    gain = gains(bucket_counts(found, buckets), bucket_counts(features(wanted, n_min, n_max, buckets, keep=False), buckets))
    scored = weights(found, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    # Its place in the table tells rows of equal score and id apart.
    scored = materialise(spark, scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    fit = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    drawn_rows = scored.where(fit).agg(F.count(F.lit(1)).alias("n")).first()["n"] * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("row").asc()]
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = ranked(scored.where(fit).select(*columns, "row"), order)
    drawn = drawn.select(*columns, F.when(F.col("rank") <= drawn_rows, F.col("rank")).alias("rank"))
    return drawn.unionByName(scored.where(~fit).select(*columns, F.lit(None).cast("long").alias("rank")))
