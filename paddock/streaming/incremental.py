"""Keep silver and gold current as new session files land (Structured Streaming).

The original refreshed weekly and skipped sessions already on disk.  Here the
bronze folder of each kind is a streaming file source: the stream's own
checkpoint (kept with the lake, on the shared file system) remembers which
files were seen, so every run handles exactly the files that arrived since
the last one — no driver-side bookkeeping, and a run killed half-way resumes.

Each micro-batch is used only to *name* the sessions that changed.  Those
sessions are then re-read whole from bronze (partition-pruned) and replaced
in silver, in its rejects and in the gold states, so a batch that carries only part of a session's files, or a
batch replayed after a failure, still leaves the right result: the refresh is
idempotent.  Gold rows of the events and seasons that the sessions belong to, before or now, are merged
from states and replaced, so gold is that of a full run.  Silver and gold then become an epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock import schemas
from paddock.plans.medallion import GOLD_TABLES, SILVER_KINDS, Layout, publish_epoch, refresh_silver, run_gold


def _refresh_sessions(spark: SparkSession, layout: Layout, table: str, touched: DataFrame,
                      on_duplicate: str) -> list[tuple]:
    # The session set of one batch is small (sessions, not rows) and bounded by the batch.
    sessions = [tuple(r) for r in touched.select(*schemas.SLICE_KEY).distinct().collect()]
    if sessions:
        refresh_silver(spark, layout, table, sessions, on_duplicate)
    return sessions


def start_incremental(spark: SparkSession, layout: Layout, table: str = "silver_laps",
                      with_gold: bool = True, on_duplicate: str = "dedup", checkpoint: str | None = None,
                      available_now: bool = True, publish: bool = True):
    """Start the stream for one silver table; returns the ``StreamingQuery``.

    ``available_now`` processes everything new and stops (a scheduled batch
    run); without it the query keeps watching the folder.  ``publish``: each batch ends with an epoch.
    """
    kind = SILVER_KINDS[table]
    source = f"{layout.bronze}/{kind}"
    schema = schemas.bronze_schema(kind)
    # Stream progress belongs to the lake it feeds (which lives in the shared folder).
    checkpoint = checkpoint or f"{layout.root}/_streams/{table}"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        touched = batch.select(F.col("year").cast("int"), F.col("round").cast("int"),
                               F.col("session_type").cast("string"))
        sessions = _refresh_sessions(batch.sparkSession, layout, table, touched, on_duplicate)
        if with_gold and table == "silver_laps" and sessions:
            run_gold(batch.sparkSession, layout, sessions=sessions)
        if sessions and publish:
            publish_epoch(batch.sparkSession, layout)

    stream = (spark.readStream.schema(schema).option("basePath", source)
              .option("maxFileAge", "36500d")   # a restored archive's files may be old: none is too old to be new
              .parquet(source)
              .select(*schemas.SLICE_KEY))
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_incremental(spark: SparkSession, layout: Layout, tables=tuple(SILVER_KINDS), with_gold: bool = True,
                    on_duplicate: str = "dedup", checkpoint_base: str | None = None) -> None:
    """One scheduled run: process every new bronze file of every kind, then stop.
    Kinds with no bronze folder yet are skipped (their stream starts once files exist)."""
    from paddock.sources.tables import path_exists

    for table in tables:
        if not path_exists(spark, f"{layout.bronze}/{SILVER_KINDS[table]}"):
            continue
        ck = f"{checkpoint_base}/{table}" if checkpoint_base else None
        q = start_incremental(spark, layout, table, with_gold, on_duplicate, ck, available_now=True, publish=False)
        q.awaitTermination()
    versions = {t: layout.table(t).current_version(spark) for t in (*SILVER_KINDS, *GOLD_TABLES)}
    if with_gold and versions != layout.epoch(spark):  # one epoch for the whole run, and none if nothing came
        publish_epoch(spark, layout)
