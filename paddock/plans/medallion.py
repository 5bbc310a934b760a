"""Whole runs: bronze -> silver -> gold -> epoch (R5), one Spark job per table.

Where the original looped over years x tables x sessions issuing one tiny job
each, a run here scans every selected session of a kind in one multi-file
read, cleans it, and publishes exactly the affected sessions.

* A kind's bronze is scanned once: rows are flagged (failed cast, null key), written to the shared folder, and split from there
  into the silver table and the rejects; duplicates are counted while silver is written, so the rejects cost a second pass
  over the copy only if there are any.  Which keys may repeat is told by a bit filter over their hashes: rows of other
  keys are neither aggregated nor sorted by key, for silver or for the rejects.
* Gold comes from states kept per session (``operators.gold``): refreshed sessions replace theirs, and the events and
  seasons that they belong to, now or before, are merged anew and replaced as a whole.
* An epoch is one commit that names a version of each silver and gold table, written last: readers of the epoch never see
  silver and gold of different runs, and a run that dies in between leaves the epoch before.  A gate publishes an
  epoch only if the contract's metrics hold on the versions it would name.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock import schemas
from paddock.operators import gold, refresh, silver
from paddock.sources import bronze, ledger, tables

# silver table -> bronze kind (file prefix), from the bronze table each transform reads.
SILVER_KINDS = {table: bronze.bronze_prefix(source) for table, (source, _) in silver.TRANSFORMS.items()}


@dataclass
class Layout:
    """Where a deployment keeps its layers (all below one shared root)."""
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    def silver(self, table: str) -> tables.SliceTable:
        schema, key = schemas.TARGETS[table]
        return tables.SliceTable(f"{self.root}/silver/{table}", schema, key, "driver" if "driver" in key else None)

    def rejects(self, table: str) -> tables.SliceTable:
        schema, key = schemas.TARGETS[table]
        return tables.SliceTable(f"{self.root}/rejects/{table}", refresh.reject_schema(schema), key)

    def gold(self, table: str) -> tables.VersionedTable:
        schema, key = schemas.TARGETS[table]
        part = ["year", "session_type"] if table == "gold_driver_performance" else []
        return tables.VersionedTable(f"{self.root}/gold/{table}", schema, key, part)

    def gold_states(self, spark: SparkSession) -> tables.SliceTable:
        """Mergeable states of each session's laps, of the grain of gold drivers."""
        return tables.SliceTable(f"{self.root}/state/gold_laps", state_schema(spark), STATE_GRAIN)

    def gold_rejects(self) -> tables.SliceTable:
        return tables.SliceTable(f"{self.root}/rejects/gold_laps", refresh.reject_schema(schemas.SILVER_LAPS), schemas.SILVER_LAPS_KEY)

    @property
    def ledger(self) -> ledger.IngestLedger:
        return ledger.IngestLedger(f"{self.root}/ledger")

    @property
    def epochs(self) -> tables.CommitLog:
        return tables.CommitLog(f"{self.root}/_epochs")

    def epoch(self, spark: SparkSession, number: int | None = None) -> dict[str, int]:
        """table -> version of an epoch (the newest); empty if there is none."""
        number = self.epochs.current(spark) if number is None else number
        return json.loads(self.epochs.text(spark, number)) if number else {}

    def read(self, spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
        """A table as the epoch names it; an empty frame if it names no version."""
        stored = self.table(table)
        return stored.read(spark, self.epoch(spark, number).get(table, 0))

    def table(self, name: str) -> "tables.SliceTable | tables.VersionedTable":
        return self.gold(name) if name in GOLD_TABLES else self.silver(name)


GOLD_TABLES = ("gold_driver_performance", "gold_team_season_stats")
STATE_GRAIN = [*schemas.SLICE_KEY, "grand_prix", "driver", "team"]


def state_schema(spark: SparkSession) -> T.StructType:
    empty = spark.createDataFrame([], schemas.SILVER_LAPS)
    return gold.lap_states(empty, STATE_GRAIN).schema


def silver_rows(spark: SparkSession, layout: Layout, table: str, sessions=None) -> DataFrame:
    """Bronze of every selected session -> cleaned silver rows with the ``reason`` why one can't be in the table (or NULL)."""
    _, transform = silver.TRANSFORMS[table]
    rows = transform(bronze.scan_bronze(spark, layout.bronze, SILVER_KINDS[table], sessions), with_failed=True)
    return refresh.flagged(rows, schemas.key_of(table), schemas.CAST_FAILED)


def refresh_silver(spark: SparkSession, layout: Layout, table: str, sessions: list[tuple], on_duplicate: str = "dedup") -> dict:
    """R1, R3, R4 for one table: its bronze is scanned once, then silver and rejects of the sessions are replaced.

    With ``fail`` a row that would be rejected stops the refresh before anything is published."""
    key = schemas.key_of(table)
    seen = Observation()
    rows = silver_rows(spark, layout, table, sessions).observe(seen, F.count("reason").alias("flagged"))
    rows = rows.withColumn(refresh.KEY_HASH, refresh.key_hash(rows, key))

    def guard(report: dict) -> None:
        if on_duplicate == "fail" and (left_out := seen.get["flagged"] + (report["observed"]["extra"] or 0)):
            raise ValueError(f"{left_out} rows violate the primary key {key} of {table}")

    with (tables.staged(spark, rows, f"stage-{table}") as stage,
          tables.staged(spark, refresh.repeated_filter(stage.where("reason is null")), f"repeats-{table}") as repeated):
        marked = refresh.with_repeats(stage, repeated).drop(refresh.KEY_HASH)
        good = marked.where("reason is null").drop("reason")
        alone = good.where("not _repeats").drop("_repeats").withColumn("copies", F.lit(1).cast("long"))
        kept = alone.unionByName(refresh.one_per_key(good.where("_repeats").drop("_repeats"), key))
        report = layout.silver(table).refresh(spark, kept, requested=sessions, check_key=False,
                                              observe={"extra": F.sum(F.col("copies") - 1)}, guard=guard)
        left_out = seen.get["flagged"] + (report.pop("observed")["extra"] or 0)
        target = layout.rejects(table)
        if left_out:
            against = marked.where("reason is not null or _repeats").drop("_repeats")
            target.refresh(spark, refresh.rejects(against, key), requested=sessions, check_key=False)
        elif target.exists(spark):  # only the map changes
            target.refresh(spark, spark.createDataFrame([], target.schema), requested=sessions, check_key=False)
    return report | {"rejected_rows": left_out}


def concurrently(jobs: dict, workers: int = 3) -> dict:
    """Run independent Spark actions from a few driver threads.

    The scheduler interleaves their tasks, so one job's tail (its last, slow
    tasks) overlaps with the others' work instead of idling the cluster.
    """
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(jobs)))) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def run_silver(spark: SparkSession, layout: Layout, sessions: list[tuple] | None = None,
               on_duplicate: str = "dedup", parallel: bool = True) -> dict:
    """Refresh the three silver tables for the selected sessions (all if None).

    The three tables are independent jobs and run side by side when ``parallel``.
    Per kind, only requested sessions that have bronze files of that kind are
    replaced: a session whose telemetry never arrived keeps its silver rows, as
    the original left sessions it did not discover untouched.
    """
    out = {}
    jobs = {}
    for table, kind in SILVER_KINDS.items():
        if not tables.path_exists(spark, f"{layout.bronze}/{kind}"):
            out[table] = {"skipped": "no bronze files of this kind"}
            continue
        # One entry per session of this kind; all of them are replaced when none are named, so that a
        # session whose rows were all cleaned away loses its old ones.
        present = sorted(tuple(r) for r in bronze.discover_partition_sessions(spark, layout.bronze, kind).collect())
        wanted = present if sessions is None else [tuple(s) for s in sessions if tuple(s) in set(present)]

        def job(table=table, wanted=wanted):
            return refresh_silver(spark, layout, table, wanted, on_duplicate)
        jobs[table] = job
    out.update(concurrently(jobs, 3 if parallel else 1))
    return {t: out[t] for t in SILVER_KINDS if t in out}


def refresh_states(spark: SparkSession, layout: Layout, sessions: list[tuple] | None = None) -> dict:
    """States (and rejects: laps with a NULL in a gold key) of the given sessions' silver laps, or of all sessions.

    Returns the events and seasons that the given sessions belong to, by their old states or their new ones."""
    stored, silver_laps = layout.gold_states(spark), layout.silver("silver_laps")
    before, every = stored.slice_map(spark), sessions is None
    sessions = sorted(set(before) | set(silver_laps.slice_map(spark)), key=repr) if every else sessions
    events = set() if every else _events(stored.read(spark, slices=sessions))
    laps = silver_laps.read(spark, slices=sessions)
    bad = gold.gold_rejects(laps).withColumn("reason", F.lit("null gold key"))
    layout.gold_rejects().refresh(spark, bad, requested=sessions, check_key=False)
    keyed, _ = gold.split_null_keys(laps, schemas.GOLD_TEAM_KEY)
    stored.refresh(spark, gold.stored_states(keyed, STATE_GRAIN), requested=sessions, check_key=False)
    if every:  # whatever there is
        return {"events": [], "seasons": []}
    events |= _events(stored.read(spark, slices=sessions))
    seasons = {(y, s) for y, _, s in events} | {(y, s) for y, _, s in sessions}
    return {"events": sorted(events, key=repr), "seasons": sorted(seasons, key=repr)}


EVENT, SEASON = ["year", "grand_prix", "session_type"], ["year", "session_type"]


def _events(states: DataFrame) -> set[tuple]:
    """(year, grand_prix, session_type) of some sessions' states: about one a session."""
    return {tuple(r) for r in states.select(*EVENT).distinct().collect()}


def run_gold(spark: SparkSession, layout: Layout, mode: str = "upsert", sessions: list[tuple] | None = None) -> dict:
    """Gold from the current silver laps, by way of states; table -> version.

    ``upsert`` keeps stale keys, ``rebuild`` replaces everything.  With ``sessions`` only their states are made anew, and
    exactly the events and seasons they belong to are replaced (``replace``): the result is that of a rebuild."""
    touched = refresh_states(spark, layout, sessions)
    states = layout.gold_states(spark).read(spark)
    if sessions is not None:
        states = states.where(F.coalesce(tables.in_slices(touched["seasons"], SEASON), F.lit(False)))
    named, _ = gold.split_null_keys(states, schemas.GOLD_DRIVER_KEY)
    if sessions is not None:  # a round's event is its name, which several rounds may carry: all states of the touched events
        named = named.where(F.coalesce(tables.in_slices(touched["events"], EVENT), F.lit(False)))
    jobs = {}
    for table, rows, scope, scopes in (("gold_driver_performance", gold.stored_driver_rows(named), EVENT, touched["events"]),
                                       ("gold_team_season_stats", gold.stored_team_rows(states), SEASON, touched["seasons"])):
        def job(table=table, rows=rows, scope=scope, scopes=scopes):
            target = layout.gold(table)
            if sessions is not None:
                return target.replace(spark, rows, scopes, scope)
            return target.upsert(spark, rows) if mode == "upsert" else target.overwrite(spark, rows)
        jobs[table] = job
    return concurrently(jobs, 2)       # two independent merges of the same states


def publish_epoch(spark: SparkSession, layout: Layout, gate: bool = False) -> dict:
    """Name the current versions of all five tables in one commit.  With ``gate`` only if the contract's metrics (D1-D3) pass on
    exactly these versions; otherwise the epoch before stays.  Metrics are in the report either way."""
    versions = {t: layout.table(t).current_version(spark) for t in (*SILVER_KINDS, *GOLD_TABLES)}
    report: dict = {"versions": versions, "published": True}
    if gate:
        metrics = contract_metrics(spark, layout, versions)
        report |= {"quality": metrics, "published": all(m["passed"] for m in metrics if m["value_pct"] is not None)}
    if report["published"]:
        report["epoch"] = layout.epochs.publish_next(spark, lambda base: json.dumps(versions))
    return report


def vacuum(spark: SparkSession, layout: Layout, keep: int = 2) -> None:
    """Delete what neither the newest ``keep`` versions nor the newest ``keep`` epochs name."""
    top = layout.epochs.current(spark)
    kept = [layout.epoch(spark, n) for n in range(max(1, top - keep + 1), top + 1) if layout.epochs.has(spark, n)]
    for t in (*SILVER_KINDS, *GOLD_TABLES):
        layout.table(t).vacuum(spark, keep, tuple(e.get(t, 0) for e in kept))
    for t in SILVER_KINDS:
        layout.rejects(t).vacuum(spark, 1)
    layout.gold_states(spark).vacuum(spark, 1)
    layout.gold_rejects().vacuum(spark, 1)


def select_sessions(spark: SparkSession, layout: Layout, seasons=None, rounds=None, session_types=None,
                    kind: str | None = None, strict: bool = False, resume_year: int | None = None,
                    calendar: DataFrame | None = None, as_of: dt.date | None = None) -> list[tuple]:
    """Sessions present in bronze (in any kind, unless one is named) that match the filters.

    With ``as_of``, events that the ``calendar`` (year, round, event_date) dates later are left out (F12); an event that it doesn't
    list has no date and stays.  With ``strict`` a requested season without any session is an error (the
    original raised when a year had no files).  Returns a session list: small,
    one entry per race or qualifying.
    """
    from paddock.operators import selection

    sessions: set[tuple] = set()
    for one in [kind] if kind else schemas.KINDS:
        if tables.path_exists(spark, f"{layout.bronze}/{one}"):
            found = selection.select_rounds_sessions(
                selection.select_seasons(bronze.discover_partition_sessions(spark, layout.bronze, one), seasons,
                                         resume_year), rounds, session_types)
            if as_of is not None:
                future = calendar.join(selection.events_until(calendar, as_of).select("year", "round"), ["year", "round"], "left_anti")
                found = found.join(future.where("event_date is not null").select("year", "round"), ["year", "round"], "left_anti")
                found = found.select(*schemas.SLICE_KEY)
            sessions |= {tuple(r) for r in found.collect()}
    sessions = sorted(sessions)
    if strict and seasons is not None:
        missing = sorted(set(int(y) for y in seasons) - {s[0] for s in sessions})
        if missing:
            raise FileNotFoundError(f"no bronze sessions for seasons {missing} under {layout.bronze}")
    return sessions


def import_archive(spark: SparkSession, archive: str, layout: Layout) -> dict:
    """Bring an archive of flat checkpoint files (any naming generation, any of the
    known physical types) into the bronze layout, one job per kind.

    Listing reads names only; where a suffixed and a legacy file describe the
    same session the suffixed one wins; rows whose data year/round disagree
    with their file name are kept as rejects rather than written.  The ledger tells what is new or has been
    delivered again since (S8): nothing else is read, and a session whose rows were all rejected isn't read
    again for that.
    """
    listing = bronze.parse_checkpoint_listing(bronze.list_files(spark, archive, recursive=True))
    best = bronze.prefer_suffixed(listing.select("kind", "year", "round", "session_type", "file_name", "is_legacy"))
    listed = ledger.entries(listing.join(best.select("kind", "file_name"), ["kind", "file_name"], "left_semi"))
    listed = listed.checkpoint()  # one row per session; as listed now, whatever arrives meanwhile
    to_read = layout.ledger.compare(spark, listed).where(F.col("status").isin("new", "changed"))
    entries = (listing.join(to_read.select("kind", "file_name"), on=["kind", "file_name"], how="left_semi")
               .select("kind", "entry").distinct().collect())
    by_kind: dict[str, list[str]] = {}
    for r in entries:
        by_kind.setdefault(r.kind, []).append(r.entry)
    out = {}
    for kind, paths in sorted(by_kind.items()):
        accepted, rejected = bronze.label_from_file(bronze.read_checkpoint_files(spark, paths))
        if kind == "tel":
            accepted = conform_car_driver(accepted)
        bronze.write_bronze(accepted.drop("_path"), layout.bronze, kind)
        # By the session of the file: a file that comes again replaces its rejects.
        rejects = f"{layout.root}/rejects/bronze_{kind}"
        seen = Observation()
        (rejected.withColumn("reason", F.lit("labels disagree with the file name")).observe(seen, F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("file_year", "file_round", "file_session_type").parquet(rejects))
        out[kind] = {"files": len(paths), "rejected_rows": seen.get["rows"]}
    if out:
        layout.ledger.record(spark, listed)
    return out


def conform_car_driver(df: DataFrame) -> DataFrame:
    from paddock.operators import conform
    return conform.rename_bronze_columns(df, "bronze_car_data")


def contract_metrics(spark: SparkSession, layout: Layout, versions: dict[str, int] | None = None) -> list[dict]:
    """D1-D3 over stored tables (the newest versions, or those given), as the contract asks after every run
    (three global aggregates; three small rows reach the driver)."""
    from paddock.operators import quality

    versions = versions or {}
    report = quality.quality_report(layout.gold("gold_driver_performance").read(spark, versions.get("gold_driver_performance")),
                                    layout.silver("silver_laps").read(spark, versions.get("silver_laps")))
    return [r.asDict() for r in report.collect()]


def silver_slice_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    """A10 for all silver tables: rows per (table, slice), as their writes counted them."""
    frames = [layout.silver(t).slice_rows(spark).select(F.lit(t).alias("table_name"), "*") for t in SILVER_KINDS]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
