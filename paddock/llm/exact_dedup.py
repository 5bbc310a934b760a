"""Exact deduplication against a persistent digest index.

The index is a table of one row per distinct text — ``digest``, ``keep_id``, ``group_size`` —
bucketed and sorted by ``digest``.  A batch is reduced to its own digests first (map-side combined,
so a text that makes up a third of the batch costs one row per task), then sort-merge anti-joined
with the index: the index side is read in bucket order and is never shuffled.  What is new is
appended with the same bucketing.

Defined results
* null text counts as empty; all empty texts are one group;
* of equal texts in a batch the largest id stays (nulls lose; a group of null ids keeps null);
* a text the index already holds is dropped, its ``keep_id`` is the one recorded earlier;
* repeated rows (same id, same text) are one document: ``unique_rows`` returns it once;
* an empty batch appends nothing; other columns, whatever their names, pass through (names added inside are
  ones that the batch doesn't have);
* very long texts are hashed whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import fold_az, fresh_name, materialise
from paddock.session import scratch_path

HOT_SHARE = 1000   # a text with more than one in so many rows is hot: there are fewer than so many of them


class DigestIndex:
    """One bucketed, sorted table of known digests; ``path`` is its folder.  A session sized for its input gives it as many
    ``buckets`` as shuffles have partitions."""

    def __init__(self, spark: SparkSession, name: str | None = None, path: str | None = None,
                 buckets: int | None = None):
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        self.path = path or scratch_path(spark, "llm/digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        """In bucket order: joins on ``digest`` shuffle only the other side."""
        return self.spark.table(self.name)

    def read_plain(self) -> DataFrame:
        """Without bucketing, so that both sides of a join are dealt out anew and a digest with
        very many rows on the other side can be split by the skew join."""
        return self.spark.read.schema(self.read().schema).parquet(self.path)

    def create(self) -> None:
        """The empty table, bucketed and sorted, unless it is there."""
        if not self.exists():
            empty = self.spark.createDataFrame([], "digest string, keep_id long, group_size long")
            self.append(empty)

    def append(self, groups: DataFrame) -> None:
        (groups.write.format("parquet").mode("append").option("path", self.path)
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def with_digest(docs: DataFrame, text: str = "text", name: str = "digest") -> DataFrame:
    """Adds column ``name``, the SHA-256 (hex) of the whole text, A-Z lower-cased; never null, so that joins on it
    don't evaluate it a second time in a null filter."""
    return docs.withColumn(name, F.coalesce(F.sha2(F.encode(fold_az(docs[text]), "UTF-8"), 256), F.lit("")))


def index_batch(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text: str = "text", digest: str | None = None) -> None:
    """Append the digests of ``docs`` that the index doesn't hold yet; ``digest`` names the column if ``docs`` carries
    them already (``with_digest``)."""
    if digest is None:
        digest = "digest"
        docs = with_digest(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))).select(F.col("id").alias(id_col), digest)
    groups = (docs.groupBy(F.col(digest).alias("digest"))
              .agg(F.max(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    index.create()
    groups = groups.hint("merge").join(index.read().select("digest").hint("merge"), "digest", "left_anti")
    # One task per bucket writes one sorted file: no bucket is split over thousands of files.
    index.append(groups.repartition(index.buckets, "digest"))


def _known(index: DigestIndex, digest: str, keep: str, size: str) -> tuple[DataFrame, DataFrame]:
    """The index's rows under the given names: hot ones (fewer than ``HOT_SHARE``, whatever the input) and the others.
    The first read is of the index alone."""
    known = index.read().select(F.col("digest").alias(digest), F.col("keep_id").alias(keep), F.col("group_size").alias(size))
    rows = known.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    is_hot = F.col(size) * HOT_SHARE > rows
    return known.where(is_hot), known.where(~is_hot)


def members(docs: DataFrame, index: DigestIndex, digest: str, keep: str, size: str) -> DataFrame:
    """``docs`` (a table with its digests in column ``digest``) with columns ``keep`` and ``size`` from the index.

    Rows of hot texts meet them as a broadcast, and none of their rows is shuffled.  The others are dealt to the
    index's buckets, which stay where they are."""
    hot, cold = _known(index, digest, keep, size)
    rest = docs.join(F.broadcast(hot.select(digest)), digest, "left_anti")
    return docs.join(F.broadcast(hot), digest).unionByName(rest.hint("merge").join(cold.hint("merge"), digest))


def unique_rows(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each distinct text of ``docs`` — the one the index keeps.  Of hot texts no other row is shuffled."""
    digest, keep, size = (fresh_name(n, docs) for n in ("digest", "keep_id", "group_size"))
    hot, _ = _known(index, digest, keep, size)
    gone = F.col(size).isNotNull() & ~F.col(id_col).eqNullSafe(F.col(keep))
    rows = with_digest(docs, text, digest).join(F.broadcast(hot), digest, "left").where(~gone).drop(keep, size)
    known = index.read_plain().select(F.coalesce("digest", F.lit("")).alias(digest), F.col("keep_id").alias(keep))
    kept = rows.join(known, digest).where(F.col(id_col).eqNullSafe(F.col(keep)))
    return kept.dropDuplicates([digest]).select(*[F.col(f"`{c}`") for c in docs.columns])


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Index the batch, then report one row per input row, dropped ones too: ``doc_id``,
    ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.  Texts are read once: their digests
    are written to the shared folder and serve both steps."""
    spark = docs.sparkSession
    index = index or DigestIndex(spark)
    digests = with_digest(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))).drop("text")
    digests = materialise(spark, digests, "digests")
    index_batch(digests, index, digest="digest")
    return members(digests, index, "digest", "keep_id", "group_size").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))
