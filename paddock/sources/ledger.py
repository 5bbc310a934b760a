"""What has been ingested, file by file (S3, S8): a stored ledger that new listings are compared with.

A session's file may be delivered again under its name.  The ledger keeps each entry's length and modification
time as of its import, so a listing falls into new, changed and unchanged entries without opening a file, and
entries that are gone show up as vanished.  Both sides are one row per file; the comparison is one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock import schemas
from paddock.sources.tables import VersionedTable

ENTRY_KEY = ["kind", *schemas.SLICE_KEY]
SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("round", T.IntegerType()),
    T.StructField("session_type", T.StringType()), T.StructField("file_name", T.StringType()),
    T.StructField("length", T.LongType()), T.StructField("modified", T.TimestampType())])


def entries(listing: DataFrame) -> DataFrame:
    """One row per entry of a parsed listing with ``length`` and ``modified`` of its files: an entry may be a folder of parts."""
    return (listing.groupBy(*ENTRY_KEY, "file_name")
            .agg(F.sum("length").cast("long").alias("length"), F.max("modified").alias("modified")))


class IngestLedger:
    """The entry that each (kind, session) was last imported from."""

    def __init__(self, root: str):
        self.table = VersionedTable(root, SCHEMA, ENTRY_KEY)

    def compare(self, spark: SparkSession, listed: DataFrame) -> DataFrame:
        """(``kind``, session, ``file_name``, ``status``) of every entry listed or known: ``new``, ``changed`` (another name, length or
        time), ``unchanged`` or ``vanished``."""
        told = ["file_name", "length", "modified"]
        now = listed.select(*ENTRY_KEY, F.struct(*told).alias("now"))
        known = self.table.read(spark).select(*ENTRY_KEY, F.struct(*told).alias("known"))
        status = (F.when(F.col("known").isNull(), "new").when(F.col("now").isNull(), "vanished")
                  .when(F.col("now") == F.col("known"), "unchanged").otherwise("changed"))
        both = now.join(known, ENTRY_KEY, "full_outer")
        return both.select(*ENTRY_KEY, F.coalesce("now.file_name", "known.file_name").alias("file_name"), status.alias("status"))

    def record(self, spark: SparkSession, listed: DataFrame) -> int:
        """The given entries are imported as they are listed; other entries stay."""
        return self.table.upsert(spark, listed)
