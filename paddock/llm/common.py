"""Helpers shared by the operators: table reads, shared scratch tables, A-Z folding."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage is cut, and a lost
    executor costs a re-read instead of a recomputation."""
    path = scratch_path(spark, f"llm/{name}")
    schema = df.schema
    df.write.parquet(path)
    del df
    release_shuffles(spark)
    return spark.read.schema(schema).parquet(path)


def materialise_bucketed(spark: SparkSession, df: DataFrame, name: str, key: str) -> tuple[DataFrame, DataFrame]:
    """``df`` written once, bucketed and sorted by ``key``: read in bucket order (joins on ``key`` shuffle
    only the other side), and read plainly."""
    path, schema = scratch_path(spark, f"llm/{name}"), df.schema
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    called = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(called))
    del df
    release_shuffles(spark)
    return spark.table(called), spark.read.schema(schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of plans that the driver has collected as garbage; after a step
    is written nothing needs its own, so don't wait until the driver runs short of memory."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh_name(name: str, df: DataFrame) -> str:
    """``name``, or with underscores more, that no column of ``df`` has (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold_az(text: Column) -> Column:
    """Lower-case A-Z only; null is empty.

    ``lower`` touches nothing but A-Z in pure ASCII and is far cheaper there than ``translate``.
    """
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def drop_scratch(spark: SparkSession) -> None:
    """Delete every scratch table of this folder; call it once no result is needed any more."""
    from paddock.session import checkpoint_root

    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/paddock/llm")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
