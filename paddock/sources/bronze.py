"""Bronze (raw session) files: write, list, discover, scan.

Two layouts are read:

* the paddock layout written by :func:`write_bronze` —
  ``<root>/<kind>/year=Y/round=R/session_type=S/part-*.parquet`` — where
  session labels are partition columns, so a session filter prunes
  directories and one scan covers every session;
* flat checkpoint files ``<kind>_checkpoint_<year>_r<round>[_<R|Q>].parquet``
  (the format of existing archives), listed with the ``binaryFile`` source
  (names only, no content read) and scanned in one multi-file read with the
  file path as provenance.

Files whose physical schemas conflict (e.g. ``Speed`` DOUBLE in one, BIGINT in
another) cannot share one Parquet scan.  Their footers are read in parallel
by Spark tasks, files are grouped by schema, each group is scanned once and
conformed to the declared types, and the groups are unioned by name.
"""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock import schemas
from paddock.functions import scalars
from paddock.operators import conform

PARTITION_PATH = r"/year=(\d+)/round=(\d+)/session_type=([^/]+)/"
NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"
ARCHIVE_ROW_GROUP = 100_000   # rows of an archive file that a task holds before it writes them


def bronze_prefix(bronze_table: str) -> str:
    """Bronze table name -> file prefix / kind (``bronze_laps`` -> ``laps``)."""
    return schemas.BRONZE_PREFIX[bronze_table]


# ---------------------------------------------------------------- writing

def write_bronze(df: DataFrame, root: str, kind: str, mode: str = "overwrite") -> str:
    """Write one kind of bronze rows, one directory per session.

    With dynamic partition overwrite only the sessions present in ``df`` are
    replaced, so re-ingesting a session is idempotent and leaves the others
    alone.  Columns are stored under their declared names and types (S2, P1, P11, P12), so files of
    one kind always read together; timestamps as microsecond TIMESTAMP_NTZ.
    """
    path = f"{root.rstrip('/')}/{kind}"
    table = next(t for t, k in schemas.BRONZE_PREFIX.items() if k == kind)
    df = conform.rename_bronze_columns(df, table)
    failed = conform.cast_failures(df)
    if any(isinstance(f.dataType, T.StringType) and schemas.BRONZE_TYPES.get(f.name, f.dataType) != f.dataType for f in df.schema.fields):
        df = df.withColumn(schemas.CAST_FAILED, failed)   # kept with the row: silver sends it to the rejects
    df = conform.conform_bronze_types(df)
    (clustered_by_slice(df).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*schemas.SLICE_KEY).parquet(path))
    return path


def clustered_by_slice(df: DataFrame, key=schemas.SLICE_KEY) -> DataFrame:
    """Group rows of a session into few tasks before a partitioned write.

    Without it every task writes one file per session it happens to hold
    (tasks x sessions small files).  ``rebalance`` lets AQE size the output
    partitions: small sessions share a task and a file, and a session that
    holds a large share of all rows is split across several tasks instead of
    landing on one.
    """
    return df.hint("rebalance", *key)


# ------------------------------------------------------------- listing

def list_files(spark: SparkSession, root: str, glob: str = "*.parquet", recursive: bool = False) -> DataFrame:
    """File listing as a DataFrame (``path``, ``length``, ``modified``); file contents are never read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(root).select("path", "length", F.col("modificationTime").alias("modified"))


def total_bytes(spark: SparkSession, root: str) -> int:
    """Bytes of all Parquet files below ``root`` (a listing; file contents are not read)."""
    return int(list_files(spark, root, recursive=True).agg(F.sum("length")).first()[0] or 0)


def parse_checkpoint_listing(listing: DataFrame) -> DataFrame:
    """Kind, year, round, session type and legacy flag from checkpoint names.

    A checkpoint is either one file or a folder of part files named like one;
    ``entry`` is the readable path of the checkpoint in both cases.
    """
    name = scalars.checkpoint_entry_name("path")
    told = [c for c in ("length", "modified") if c in listing.columns]
    return (listing.select("path", *told, name.alias("file_name"))
            .filter(F.col("file_name").rlike(scalars.CHECKPOINT_NAME))
            .select(F.expr("substring(path, 1, instr(path, file_name) + length(file_name) - 1)").alias("entry"),
                    "path", "file_name",
                    scalars.checkpoint_kind("file_name").alias("kind"),
                    scalars.checkpoint_year("file_name").alias("year"),
                    scalars.checkpoint_round("file_name").alias("round"),
                    scalars.checkpoint_session("file_name").alias("session_type"),
                    scalars.is_legacy_name("file_name").alias("is_legacy"), *told))


def prefer_suffixed(files: DataFrame) -> DataFrame:
    """One file per (kind, year, round, session_type); a suffixed name wins over a legacy one.

    ``min(struct(is_legacy, file_name))`` per session: false < true, so the
    suffixed file is chosen; a hash aggregate, not a window.
    """
    key = ["kind", *schemas.SLICE_KEY]
    pick = F.min(F.struct(F.col("is_legacy"), F.col("file_name"))).alias("_pick")
    return files.groupBy(*key).agg(pick).select(
        *key, F.col("_pick.file_name").alias("file_name"), F.col("_pick.is_legacy").alias("is_legacy"))


def discover_checkpoint_sessions(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """S3: distinct sessions of one kind present as flat checkpoint files under ``root``."""
    files = parse_checkpoint_listing(list_files(spark, root, recursive=True))
    return files.filter(F.col("kind") == kind).select(*schemas.SLICE_KEY).distinct()


def discover_partition_sessions(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """S3 for the paddock layout: sessions from directory names of a recursive listing."""
    listing = list_files(spark, f"{root.rstrip('/')}/{kind}", recursive=True)
    return listing.select(
        F.regexp_extract("path", PARTITION_PATH, 1).cast("int").alias("year"),
        F.regexp_extract("path", PARTITION_PATH, 2).cast("int").alias("round"),
        F.regexp_extract("path", PARTITION_PATH, 3).alias("session_type"),
    ).filter(F.col("session_type") != "").distinct()


# ------------------------------------------------------------- scanning

def scan_bronze(spark: SparkSession, root: str, kind: str, sessions=None, with_source: bool = False) -> DataFrame:
    """Every session of one kind in one scan (paddock layout).

    ``sessions`` (a list of (year, round, session_type) or a small frame of
    them) becomes a predicate on the partition columns, so only those session
    folders are read — static partition pruning, no join.  The schema is the kind's declared
    one: no footer is read to infer it, and a column that only some sessions have is NULL in the others.
    """
    from paddock.operators.refresh import restrict_to_slices

    path = f"{root.rstrip('/')}/{kind}"
    df = spark.read.schema(schemas.bronze_schema(kind)).option("basePath", path).parquet(path)
    if with_source:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    df = df.withColumns({"year": F.col("year").cast("int"), "round": F.col("round").cast("int"),
                         "session_type": F.col("session_type").cast("string")})
    if sessions is not None:
        if isinstance(sessions, DataFrame):  # one row per session, like the folders that are listed here
            sessions = [tuple(r) for r in sessions.select(*schemas.SLICE_KEY).distinct().collect()]
        df = restrict_to_slices(df, sessions)
    return df


def _schemas_by_entry(spark: SparkSession, entries: list[str]) -> dict[str, list[str]]:
    """Group checkpoint entries by physical schema.

    All parts of one entry share a schema (one session, one writer), so one
    footer per entry is read — by Spark tasks, not the driver — and the
    groups hold entries (sessions), never the growing list of part files.
    """
    import pandas as pd

    def read_footers(batches):
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs
        for pdf in batches:
            out = []
            for p in pdf["path"]:
                filesystem, inner = pafs.FileSystem.from_uri(p if "://" in p else p.replace("file:", "file://", 1))
                out.append(str(pq.read_schema(inner, filesystem=filesystem)))
            yield pd.DataFrame({"entry": pdf["entry"], "schema": out})

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(entries).select("path", "length"))
    one_per_entry = parse_checkpoint_listing(files).groupBy("entry").agg(F.min("path").alias("path"))
    grouped = (one_per_entry.mapInPandas(read_footers, "entry string, schema string")
               .groupBy("schema").agg(F.collect_list("entry").alias("entries")))
    # One row per distinct schema, listing sessions: bounded by the number of sessions.
    return {r["schema"]: list(r["entries"]) for r in grouped.collect()}


def read_checkpoint_files(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Read flat checkpoint files of one kind as one conformed frame.

    * TIMESTAMP(NANOS) columns read as BIGINT nanoseconds and are converted by
      type (P12), never rejected;
    * labels come from the file name (``file_year``, ``file_round``,
      ``file_session_type``) next to whatever the data carries;
    * conflicting physical schemas are read per schema group and unioned.

    The rows are written once to the shared folder and read from there: the archive is scanned once
    however often the result is used, and the reader setting for nanoseconds is put back.
    """
    from paddock.sources.tables import materialize

    before = spark.conf.get(NANOS_AS_LONG, None)
    spark.conf.set(NANOS_AS_LONG, "true")
    try:
        return materialize(spark, _conformed_checkpoints(spark, list(paths)), "checkpoint-rows")
    finally:
        if before is None:
            spark.conf.unset(NANOS_AS_LONG)
        else:
            spark.conf.set(NANOS_AS_LONG, before)


def _condition(exc: Py4JJavaError) -> str:
    """The error class of a Spark error; '' for any other."""
    try:
        return exc.java_exception.getCondition() or ""
    except Py4JError:
        return ""


def _conformed_checkpoints(spark: SparkSession, paths: list[str]) -> DataFrame:
    try:
        groups = [spark.read.option("mergeSchema", "true").parquet(*paths)]
    except Py4JJavaError as exc:  # only conflicting physical types are expected here
        if not _condition(exc).startswith("CANNOT_MERGE"):
            raise
        groups = [spark.read.parquet(*group) for group in _schemas_by_entry(spark, paths).values()]
    frames = []
    for g in groups:
        g = conform.conform_bronze_types(g.withColumn("_path", F.col("_metadata.file_path")))
        frames.append(g)
    df = frames[0]
    for g in frames[1:]:
        df = df.unionByName(g, allowMissingColumns=True)
    name = scalars.checkpoint_entry_name("_path")
    return df.withColumns({
        "file_year": scalars.checkpoint_year(name),
        "file_round": scalars.checkpoint_round(name),
        "file_session_type": scalars.checkpoint_session(name),
    })


def label_from_file(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P4 + DECISION: session labels for rows read from checkpoint files.

    ``session_type`` always comes from the file name; ``year``/``round`` come
    from the data when present, else from the name.  Rows whose data
    year/round disagree with their file go to the reject frame.
    """
    df = conform.rename_bronze_columns(df, "bronze_laps")
    df = conform.require_columns(df, ["year", "round"])
    labelled = df.withColumns({
        "year": F.coalesce(F.col("year").cast("int"), F.col("file_year")),
        "round": F.coalesce(F.col("round").cast("int"), F.col("file_round")),
        "session_type": F.col("file_session_type"),
    })
    # NULL-safe: a row whose file name yields no label is rejected, never lost.
    agree = F.coalesce((F.col("year") == F.col("file_year")) & (F.col("round") == F.col("file_round")),
                       F.lit(False))
    drop = ["file_year", "file_round", "file_session_type"]
    return labelled.filter(agree).drop(*drop), labelled.filter(~agree)


def session_labels(files: DataFrame, schedule: DataFrame) -> DataFrame:
    """The constant label columns each session file carries (Year, Round, SessionType, GrandPrix)."""
    parsed = files.select("file_name",
                          scalars.checkpoint_year("file_name").alias("year"),
                          scalars.checkpoint_round("file_name").alias("round"),
                          scalars.checkpoint_session("file_name").alias("session_type"))
    return (parsed.join(schedule.select("year", "round", "grand_prix"), on=["year", "round"], how="left")
            .select("file_name", F.col("year").alias("Year"), F.col("round").alias("Round"),
                    F.col("session_type").alias("SessionType"), F.col("grand_prix").alias("GrandPrix")))


def write_checkpoint_archive(df: DataFrame, root: str, kind: str, labels=("year", "round", "session_type"),
                             durations: tuple[str, ...] = (), legacy: bool = False) -> DataFrame:
    """Write rows in the archive format of the original pipeline, as Spark tasks (``legacy``: under names
    without the session suffix).

    One folder per session named ``<kind>_checkpoint_<year>_r<round>_<R|Q>.parquet``
    holding part files written by pyarrow with TIMESTAMP(NANOS) timestamps and
    BIGINT-nanosecond durations — physical types Spark itself never writes.
    Each task writes only its own rows; nothing passes through the driver, and
    file names are deterministic per task so retries are idempotent.
    Rows are clustered and sorted by session first, so a task writes one file for each of its few
    sessions: every reader's driver lists and plans part files, whose number must follow the bytes and
    the sessions, not batches times sessions.
    Lazy: returns one row per written part file (path, rows).
    """
    from itertools import groupby

    import pandas as pd
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    root = root.rstrip("/")
    labels = list(labels)
    # One fixed file schema for every part (pandas would otherwise turn a nullable
    # long into double in some batches): nanosecond timestamps, int64 durations.
    target = pa.schema([
        pa.field(f.name, pa.timestamp("ns") if pa.types.is_timestamp(f.type)
                 else pa.int64() if f.name in durations else f.type)
        for f in to_arrow_schema(df.schema)])

    def write(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        # Names depend only on the partition: a retried or speculative
        # attempt rewrites the same files instead of adding duplicates.
        part = TaskContext.get().partitionId()
        filesystem, base = pafs.FileSystem.from_uri(root if "://" in root else "file://" + root)

        def by_folder():
            for pdf in batches:
                if pdf[labels].isna().any(axis=None):
                    raise ValueError(f"a row without {labels} has no session file to go to")
                for (y, r, s), rows in pdf.groupby(labels, sort=False):
                    yield f"{base}/{kind}_checkpoint_{int(y)}_r{int(r)}{'' if legacy else f'_{s}'}.parquet", rows

        def to_table(rows):
            data = rows.reset_index(drop=True)
            for c in durations:
                if c in data:
                    data[c] = (data[c] * 1e9).round().astype("Int64")
            return pa.Table.from_pandas(data, schema=target, preserve_index=False)

        for folder, runs in groupby(by_folder(), key=lambda run: run[0]):   # rows come sorted: a folder's stand together
            filesystem.create_dir(folder, recursive=True)
            path, written, held = f"{folder}/part-{part:05d}.parquet", 0, []
            with pq.ParquetWriter(path, target, filesystem=filesystem) as out:
                for _, rows in runs:
                    held.append(to_table(rows))
                    written += len(rows)
                    if sum(t.num_rows for t in held) >= ARCHIVE_ROW_GROUP:
                        out.write_table(pa.concat_tables(held))
                        held = []
                if held:
                    out.write_table(pa.concat_tables(held))
            yield pd.DataFrame([(path, written)], columns=["path", "rows"])

    return (clustered_by_slice(df, labels).sortWithinPartitions(*labels)
            .mapInPandas(write, "path string, rows long"))


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """Per-driver (or per-file) frames into one, by name, missing columns as NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
