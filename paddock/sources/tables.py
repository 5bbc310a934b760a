"""Silver and gold table storage on a shared file system.

Two layouts, both plain Parquet:

* **Slice tables** (silver, rejects, gold states): every refresh writes the slices it carries into folders of their own
  (``data/year=/round=/session_type=/write=<id>``; nothing is overwritten), then publishes a new *slice map*: session ->
  write and row count, by renaming a complete commit file.  Readers resolve one map and prune to its folders, so
  they see a refresh in full or not at all, and a failed write leaves folders that no map names.  A requested
  slice that came out empty leaves the map.  Work is proportional to the refreshed sessions; the map has one
  entry per session.

* **Versioned tables** (gold, small): every refresh writes a complete new
  version directory, then publishes it by renaming a complete commit file to
  ``_commits/<n>``, which fails if that exists (atomic where the store's rename is).
  Readers resolve the newest commit, so they never see half a table, and the
  plan that reads version *n* never writes into it.

All file-system calls go through the Hadoop ``FileSystem`` API of the session,
so the same code runs against local disk, HDFS or an object store.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock import schemas
from paddock.operators import conform, refresh


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.delete(p, True)


class AlreadyThere(RuntimeError):
    """The file to create exists."""


def _write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Create ``path`` with ``text`` all at once: written under another name, then renamed without
    overwriting (the commit point).  Raises :class:`AlreadyThere` if it exists; any other error is
    passed on as it is."""
    from py4j.protocol import Py4JJavaError

    temporary = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    fs, p, jvm = _fs(spark, temporary)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), fs.getConf())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(fs.makeQualified(p), target, no_options)
    except Py4JJavaError as exc:
        fs.delete(p, False)
        if exc.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise AlreadyThere(path) from exc
        raise


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p, jvm = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


# ---------------------------------------------------------------- commits

class CommitConflict(RuntimeError):
    """Another writer published the version this writer was about to publish."""


class CommitLog:
    """Numbered commit files of one table (or lake): each is published whole, once, under the next number."""

    def __init__(self, root: str):
        self.folder = f"{root.rstrip('/')}/_commits"

    def current(self, spark: SparkSession) -> int:
        fs, p, _ = _fs(spark, self.folder)
        if not fs.exists(p):
            return 0
        # A commit without content (a writer of another kind died half-way) is none.
        versions = [int(s.getPath().getName()) for s in fs.listStatus(p)
                    if s.getPath().getName().isdigit() and s.getLen() > 0]
        return max(versions) if versions else 0

    def text(self, spark: SparkSession, version: int) -> str:
        return _read_text(spark, f"{self.folder}/{version:020d}")

    def has(self, spark: SparkSession, version: int) -> bool:
        return path_exists(spark, f"{self.folder}/{version:020d}")

    def publish(self, spark: SparkSession, version: int, text: str) -> int:
        """Raises :class:`CommitConflict` if another writer has published that version."""
        try:
            _write_text_once(spark, f"{self.folder}/{version:020d}", text)
        except AlreadyThere as exc:
            raise CommitConflict(f"version {version} in {self.folder} was published concurrently") from exc
        return version

    def publish_next(self, spark: SparkSession, text_of, attempts: int = 20) -> int:
        """Publish ``text_of(current version)`` as the next version, again on top of whoever was faster."""
        for attempt in range(attempts):
            base = self.current(spark)
            try:
                return self.publish(spark, base + 1, text_of(base))
            except CommitConflict:
                if attempt == attempts - 1:
                    raise
        raise AssertionError("unreachable")


# ------------------------------------------------------------------ slice tables

WRITE = "write"
COUNTED_SLICES = 20_000   # sessions whose rows one write counts by itself; beyond, footers are asked


def in_slices(entries: list[tuple], columns: list[str]) -> Column:
    """Rows whose ``columns`` equal one of the entries; NULL equals NULL.  Folder columns prune by it."""
    whole = refresh.slice_predicate(entries, columns)
    for e in (e for e in entries if any(v is None for v in e)):
        one = F.lit(True)
        for c, v in zip(columns, e, strict=True):
            one = one & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
        whole = F.coalesce(whole, F.lit(False)) | one
    return whole


class SliceTable:
    """A table partitioned by session, refreshed one slice set at a time, published by slice map."""

    def __init__(self, root: str, schema: T.StructType, key: list[str], look_up: str | None = None):
        """Files are sorted by ``look_up`` within a slice and carry a Bloom filter on it, so a filter on that column skips
        most of a slice's row groups (F14)."""
        self.root = root.rstrip("/")
        self.schema = schema
        self.key = key
        self.look_up = look_up
        self.log = CommitLog(self.root)

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    def exists(self, spark: SparkSession) -> bool:
        return self.log.current(spark) > 0

    def current_version(self, spark: SparkSession) -> int:
        return self.log.current(spark)

    def _map(self, spark: SparkSession, version: int | None = None) -> dict:
        """A version's slice map (the newest) as stored: ``schemas``, and per slice its session, write, rows and schema number."""
        version = self.log.current(spark) if version is None else version
        return json.loads(self.log.text(spark, version)) if version else {"schemas": [], "slices": []}

    def slice_map(self, spark: SparkSession, version: int | None = None) -> dict[tuple, tuple[str, int]]:
        """session -> (write, rows) of a version: one entry per session."""
        return {tuple(e[:3]): (e[3], e[4]) for e in self._map(spark, version)["slices"]}

    def read(self, spark: SparkSession, version: int | None = None, slices=None) -> DataFrame:
        """Scan of one version with partition pruning and pushed filters; an empty frame if there is none.

        A plan keeps the map it was made with: refreshes published later don't change it.  Slices are read by the schema that
        they were written with and conformed to the declared one (P14): columns added since are NULL, changed types
        are cast.  All slices of one schema are one scan."""
        stored = self._map(spark, version)
        wanted = None if slices is None else {tuple(x) for x in slices}
        groups: dict[int, list[tuple]] = {}
        for e in stored["slices"]:
            if wanted is None or tuple(e[:3]) in wanted:
                groups.setdefault(e[5], []).append(tuple(e[:4]))
        out = None
        for number, entries in sorted(groups.items()):
            written = T.StructType.fromJson(stored["schemas"][number])
            # A known schema: no footer inference; partition values parse to the declared types.
            df = (spark.read.schema(T.StructType([*written.fields, T.StructField(WRITE, T.StringType())]))
                  .option("basePath", self.data).parquet(self.data))
            df = conform.conform_schema(df.where(in_slices(entries, [*schemas.SLICE_KEY, WRITE])).drop(WRITE), self.schema)
            out = df if out is None else out.unionByName(df)
        return spark.createDataFrame([], self.schema) if out is None else out

    def refresh(self, spark: SparkSession, stage: DataFrame, requested: list[tuple] | None = None,
                check_key: bool = True, observe: dict | None = None, guard=None) -> dict:
        """Replace every slice present in ``stage`` and every requested slice, all at once for readers.

        Returns the written row count per slice (A10), counted while writing.  With
        ``check_key`` the stage's primary key is verified first (R3, R4): a
        violation fails the refresh before anything is published, as the
        database constraint did.  ``observe`` (name -> aggregate) is measured in the same pass and comes back as
        ``observed``; columns that only it needs are not written.  ``guard``, given the report, may raise: then nothing is
        published.
        """
        from paddock.sources.bronze import clustered_by_slice

        if check_key:
            # Computed once, validated and written from the copy in the shared folder.
            with staged(spark, conform.conform_schema(stage, self.schema), "slice-stage") as copy:
                _, bad = refresh.not_null_split(copy, self.key)
                dups = refresh.pk_violations(copy, self.key)
                if not bad.isEmpty() or not dups.isEmpty():
                    raise ValueError(f"stage violates the primary key {self.key} of {self.root}")
                return self.refresh(spark, copy, requested, False, observe, guard)
        # A stage may be derived from this very table: nothing it reads is touched.
        measured = Observation(f"measured_{uuid.uuid4().hex}") if observe else None
        if measured:
            stage = stage.observe(measured, *[c.alias(n) for n, c in observe.items()])
        write = uuid.uuid4().hex
        obs = Observation(f"slice_rows_{write}")
        stage = clustered_by_slice(conform.conform_schema(stage, self.schema))
        out = stage.observe(obs, F.count(F.lit(1)).alias("rows"), counted_slices().alias("slices")).withColumn(WRITE, F.lit(write))
        if self.look_up:  # the folders' order first, which the write asks for anyway
            out = out.sortWithinPartitions(*schemas.SLICE_KEY, self.look_up)
        writer = out.write.mode("append").partitionBy(*schemas.SLICE_KEY, WRITE)
        if self.look_up:
            writer = writer.option(f"parquet.bloom.filter.enabled#{self.look_up}", "true")
        writer.parquet(self.data)
        rows, counts = obs.get.get("rows", 0), [(*_slice_of(r["item"]), r["count"]) for r in obs.get.get("slices") or []]
        if sum(c[-1] for c in counts) != rows:  # more sessions than are counted exactly
            counts = self._footer_counts(spark, write)
        written = {tuple(c[:3]): (write, c[3]) for c in counts}
        report = {"rows": rows, "slice_rows": [
            {**dict(zip(schemas.SLICE_KEY, s, strict=True)), "row_count": n} for s, (_, n) in sorted(written.items(), key=lambda e: _null_first(e[0]))]}
        if measured:
            report["observed"] = measured.get
        if guard:
            guard(report)
        removed: list[tuple] = []

        def next_map(base: int) -> str:
            old = self._map(spark, base)
            live = {tuple(e[:3]): (e[3], e[4], old["schemas"][e[5]]) for e in old["slices"]}
            removed[:] = sorted((s for s in {tuple(r) for r in requested or []} - set(written) if live.pop(s, None)), key=_null_first)
            live |= {s: (*w, self.schema.jsonValue()) for s, w in written.items()}
            kinds: list[dict] = []
            for _, _, kind in live.values():
                if kind not in kinds:
                    kinds.append(kind)
            ordered = sorted(live.items(), key=lambda e: _null_first(e[0]))
            return json.dumps({"schemas": kinds, "slices": [[*s, w, n, kinds.index(k)] for s, (w, n, k) in ordered]})

        version = self.log.publish_next(spark, next_map)
        return report | {"emptied_slices": removed, "version": version}

    def _footer_counts(self, spark: SparkSession, write: str) -> list[tuple]:
        """Rows per slice of one write from its footers: only partition columns are asked for, no data is read."""
        stored = T.StructType([*self.schema.fields, T.StructField(WRITE, T.StringType())])
        df = spark.read.schema(stored).option("basePath", self.data).parquet(self.data).where(F.col(WRITE) == write)
        return [tuple(r) for r in refresh.slice_row_counts(df).collect()]

    def slice_rows(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """A10: rows per slice of a version, from the counts its writes carried; no data is read."""
        rows = [(*s, n) for s, (_, n) in self.slice_map(spark, version).items()]
        return spark.createDataFrame(rows, "year int, round int, session_type string, row_count long")

    def vacuum(self, spark: SparkSession, keep: int = 2, also: tuple = ()) -> int:
        """Delete slice folders that old maps name and neither the newest ``keep`` versions nor those in ``also`` do; a folder that no
        map names may be another writer's and is left."""
        top = self.log.current(spark)
        live, old = set(), set()
        for v in range(1, top + 1):
            if self.log.has(spark, v):
                named = {(*s, w) for s, (w, _) in self.slice_map(spark, v).items()}
                (live if v > top - keep or v in also else old).update(named)
        return sum(delete_path(spark, self._folder(*e)) for e in sorted(old - live, key=repr))

    def _folder(self, year, rnd, session_type, write) -> str:
        def part(name, value):
            return f"{name}={'__HIVE_DEFAULT_PARTITION__' if value is None else _escaped(str(value))}"

        named = zip([*schemas.SLICE_KEY, WRITE], (year, rnd, session_type, write), strict=True)
        return "/".join([self.data, *[part(n, v) for n, v in named]])


def _escaped(value: str) -> str:
    """A partition value as Spark names its folder."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in "\"#%'*/:=?\\\x7f{[]^" else c for c in value)


def counted_slices() -> Column:
    """Aggregate: rows per session as a bounded list of (``item``, ``count``); exact up to ``COUNTED_SLICES`` sessions (the
    sketch behind it evicts nothing before it is three quarters full), which the sum of the counts shows."""
    year, rnd, session_type = schemas.SLICE_KEY
    session = f"concat(ifnull(string(`{year}`), ''), '|', ifnull(string(`{rnd}`), ''), '|', ifnull(concat('=', `{session_type}`), ''))"
    return F.expr(f"approx_top_k({session}, {COUNTED_SLICES}, {2 * COUNTED_SLICES})")


def _null_first(values: tuple) -> list:
    return [(v is not None, v) for v in values]


def _slice_of(item: str) -> tuple:
    year, rnd, session_type = item.split("|", 2)
    return (int(year) if year else None, int(rnd) if rnd else None, session_type[1:] if session_type else None)


# -------------------------------------------------------------- versioned tables

class VersionedTable:
    """A table published as immutable versions behind an atomic commit pointer."""

    def __init__(self, root: str, schema: T.StructType, key: list[str], partition_by: list[str] | None = None):
        self.root = root.rstrip("/")
        self.schema = schema
        self.key = key
        self.partition_by = partition_by or []

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.root)

    @property
    def commits(self) -> str:
        return self.log.folder

    def current_version(self, spark: SparkSession) -> int:
        return self.log.current(spark)

    def path_of(self, spark: SparkSession, version: int | None = None) -> str | None:
        v = self.log.current(spark) if version is None else version
        return f"{self.root}/{self.log.text(spark, v)}" if v else None

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """One committed version (the newest); an empty frame of the declared schema if there is none."""
        path = self.path_of(spark, version)
        if path is None:
            return spark.createDataFrame([], self.schema)
        reader = spark.read.schema(self.schema)
        if self.partition_by:
            reader = reader.option("basePath", path)
        return conform.conform_schema(reader.parquet(path), self.schema)

    def commit(self, spark: SparkSession, df: DataFrame, base: int | None = None) -> int:
        """Write ``df`` as version ``base + 1`` and publish it.

        Raises :class:`CommitConflict` (after removing the unpublished folder)
        if another writer published that version first.
        """
        base = self.current_version(spark) if base is None else base
        name = f"v{base + 1:06d}-{uuid.uuid4().hex[:8]}"
        writer = conform.conform_schema(df, self.schema).write.mode("errorifexists")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.root}/{name}")
        try:
            return self.log.publish(spark, base + 1, name)
        except CommitConflict:  # someone else won
            delete_path(spark, f"{self.root}/{name}")
            raise

    def upsert(self, spark: SparkSession, stage: DataFrame, attempts: int = 5) -> int:
        """R2: delete rows whose key is in ``stage``, insert ``stage``; a no-op for an empty stage.

        The stage is materialised once in the shared checkpoint folder (it is
        an aggregate, so small) — like a staging table it survives executor
        loss and is not recomputed for the emptiness check and the merge.
        Optimistic concurrency: if another writer publishes first, the merge
        is redone on top of its version, so no update is lost; after ``attempts``
        conflicts in a row :class:`CommitConflict` is raised and nothing is published.
        """
        from paddock.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(spark)
        stage = conform.conform_schema(stage, self.schema).checkpoint(eager=True)
        if stage.isEmpty():
            return self.current_version(spark)
        return self._redo(spark, lambda old: refresh.upsert_by_key(old, stage, self.key), attempts)

    def replace(self, spark: SparkSession, stage: DataFrame, scopes: list[tuple], scope_key: list[str], attempts: int = 5) -> int:
        """The rows of the given scopes (events, seasons) become exactly those of ``stage``: keys that are gone disappear."""
        from paddock.session import ensure_checkpoint_dir

        if not scopes:
            return self.current_version(spark)
        ensure_checkpoint_dir(spark)
        stage = conform.conform_schema(stage, self.schema).checkpoint(eager=True)
        inside = F.coalesce(in_slices(scopes, scope_key), F.lit(False))
        return self._redo(spark, lambda old: old.where(~inside).unionByName(stage.where(inside)), attempts)

    def _redo(self, spark: SparkSession, merge, attempts: int) -> int:
        """Publish ``merge(current rows)``, again on top of whoever was faster."""
        for attempt in range(attempts):
            base = self.current_version(spark)
            try:
                return self.commit(spark, merge(self.read(spark, base)), base)
            except CommitConflict:
                if attempt == attempts - 1:
                    raise
        raise AssertionError("unreachable")

    def overwrite(self, spark: SparkSession, df: DataFrame) -> int:
        """Full rebuild: the new version holds exactly ``df`` (stale keys disappear)."""
        return self.commit(spark, df)

    def vacuum(self, spark: SparkSession, keep: int = 2, also: tuple = ()) -> list[str]:
        """Delete the versions that commits before the newest ``keep`` (and not those in ``also``) name; a folder that no commit
        names may be another writer's next version and is left."""
        v = self.current_version(spark)
        named = {n: self.log.text(spark, n) for n in range(1, v + 1) if self.log.has(spark, n)}
        live = {name for n, name in named.items() if n > v - keep or n in also}
        old = sorted(name for name in named.values() if name and name not in live)
        return [name for name in old if delete_path(spark, f"{self.root}/{name}")]


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back (cuts lineage)."""
    from paddock.session import scratch_path

    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


@contextmanager
def staged(spark: SparkSession, df: DataFrame, name: str):
    """``df`` written once below the shared checkpoint folder, as long as the block runs; then the copy is deleted."""
    from paddock.session import scratch_path

    path, schema = scratch_path(spark, name), df.schema
    try:
        df.write.parquet(path)
        yield spark.read.schema(schema).parquet(path)
    finally:
        delete_path(spark, path)


def table_columns(spark: SparkSession, table: str) -> list[str]:
    """Declared columns of a target table, in order; error for an unknown table."""
    if table not in schemas.TARGETS:
        raise ValueError(f"Target table {table} does not exist")
    return schemas.schema_of(table).fieldNames()


# ------------------------------------------------------------------- JDBC

def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """Database table scan; pass a numeric partition column to read in parallel."""
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, mode: str = "overwrite") -> None:
    """Optional database sink (the stage table of the original design)."""
    df.write.jdbc(url=url, table=table, mode=mode, properties=properties)
