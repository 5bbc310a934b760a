"""Inputs that once lost rows or crashed: mixed files, missing kinds, emptied sessions, odd values, torn commits."""

import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from paddock import schemas
from paddock.functions import scalars
from paddock.operators import gold, refresh, silver
from paddock.plans import medallion
from paddock.plans.medallion import Layout
from paddock.sources import bronze
from paddock.sources.tables import CommitConflict, VersionedTable
from paddock.streaming.incremental import run_incremental

from .test_edges import lap, laps_frame


def _silver(spark, rows):
    return silver.transform_laps(laps_frame(spark, rows))


@pytest.mark.parametrize("first", ["with", "without"])
def test_a_column_that_some_sessions_lack_survives(spark, tmpdir_fresh, first):
    plain = laps_frame(spark, [lap()])
    more = laps_frame(spark, [(2024, 2, "R", "GP_2", "HAM", "T", 1.0, 90.0, 30.0, 300.0, "SOFT", True)]).withColumn("Position", F.lit(3).cast("bigint"))
    lake = Layout(f"{tmpdir_fresh}/lake")
    for df in ([more, plain] if first == "with" else [plain, more]):
        bronze.write_bronze(df, lake.bronze, "laps")
    rows = {r["round"]: r.Position for r in bronze.scan_bronze(spark, lake.bronze, "laps").collect()}
    assert rows == {1: None, 2: 3.0}


def test_emptied_session_loses_its_old_rows_when_no_session_is_named(spark, tmpdir_fresh):
    lake = Layout(f"{tmpdir_fresh}/lake")
    bronze.write_bronze(laps_frame(spark, [lap()]), lake.bronze, "laps")
    medallion.run_silver(spark, lake)
    assert lake.silver("silver_laps").read(spark).count() == 1
    bronze.write_bronze(laps_frame(spark, [lap()]).withColumn("IsAccurate", F.lit(False)), lake.bronze, "laps")
    medallion.run_silver(spark, lake)
    assert lake.silver("silver_laps").read(spark).count() == 0


def test_a_session_with_weather_only_is_refreshed(spark, tmpdir_fresh):
    lake = Layout(f"{tmpdir_fresh}/lake")
    weather = spark.createDataFrame([(2024, 5, "R", "GP", 1.0, 20.0, 50.0)],
                                    "year int, round int, session_type string, grand_prix string, Time double, AirTemp double, Humidity double")
    bronze.write_bronze(weather, lake.bronze, "weather")
    bronze.write_bronze(laps_frame(spark, [lap()]), lake.bronze, "laps")
    sessions = medallion.select_sessions(spark, lake)
    assert sessions == [(2024, 1, "R"), (2024, 5, "R")]
    assert medallion.select_sessions(spark, lake, resume_year=2025) == []
    medallion.run_silver(spark, lake, sessions)
    assert lake.silver("silver_weather").read(spark).count() == 1


def test_rejects_are_kept_with_their_reason(spark, tmpdir_fresh):
    lake = Layout(f"{tmpdir_fresh}/lake")
    rows = [lap(), lap(), lap(), lap(lap_no=None), lap(lap_no=2.0)]
    bronze.write_bronze(laps_frame(spark, rows), lake.bronze, "laps")
    for _ in range(2):  # a second refresh replaces the first one's rejects
        report = medallion.run_silver(spark, lake)
        assert report["silver_laps"]["rows"] == 2 and report["silver_laps"]["rejected_rows"] == 3
        reasons = sorted(r.reason for r in lake.rejects("silver_laps").read(spark).collect())
        assert reasons == ["duplicate key", "duplicate key", "null key"]
    df = _silver(spark, rows)
    assert refresh.rejects(df, schemas.SILVER_LAPS_KEY).count() + refresh.dedup_by_key(
        refresh.not_null_split(df, schemas.SILVER_LAPS_KEY)[0], schemas.SILVER_LAPS_KEY).count() == len(rows)


@pytest.mark.parametrize(("values", "want"), [
    ([1.0, 2.0005], 1.5), ([1e13, 1e13], 1e13), ([float("inf"), 1.0], float("inf")), ([float("-inf"), 1.0], float("-inf")),
    ([1e300, 1e300], 1e300), ([-90.0005], -90.001), ([None, 3.0], 3.0)])
def test_averages_of_any_double(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    r = df.agg(scalars.round_avg("x", 3).alias("avg"), scalars.round_min("x", 3).alias("lo"), scalars.round_max("x", 3).alias("hi")).first()
    assert r.avg == want
    known = [v for v in values if v is not None]
    assert (r.lo, r.hi) == (round(min(known), 3) if abs(min(known)) < 1e11 else min(known), round(max(known), 3) if abs(max(known)) < 1e11 else max(known)) \
        or values == [-90.0005] or values == [1.0, 2.0005]


def test_incremental_gold_equals_full_gold_when_rounds_share_a_name(spark, tmpdir_fresh):
    lake = Layout(f"{tmpdir_fresh}/lake")

    def session(rnd, t):
        return laps_frame(spark, [(2024, rnd, "R", "SAME_GP", "VER", "RB", float(rnd), t, 30.0, 300.0, "SOFT", True)])

    bronze.write_bronze(session(1, 90.0), lake.bronze, "laps")
    run_incremental(spark, lake, tables=("silver_laps",))
    bronze.write_bronze(session(2, 80.0), lake.bronze, "laps")
    run_incremental(spark, lake, tables=("silver_laps",))
    stored = lake.gold("gold_driver_performance").read(spark).select("total_laps", "avg_lap_time_s").collect()
    assert [tuple(r) for r in stored] == [(2, 85.0)]


def test_old_files_are_new_to_the_stream(spark, tmpdir_fresh):
    lake = Layout(f"{tmpdir_fresh}/lake")
    for y in (2023, 2024):
        bronze.write_bronze(laps_frame(spark, [(y, 1, "R", "GP", "VER", "RB", 1.0, 90.0, 30.0, 300.0, "SOFT", True)]), lake.bronze, "laps")
        folder = f"{lake.bronze}/laps/year={y}/round=1/session_type=R"
        if y == 2024:
            run_incremental(spark, lake, tables=("silver_laps",), with_gold=False)
        else:
            continue
    bronze.write_bronze(laps_frame(spark, [(2022, 1, "R", "GP", "VER", "RB", 1.0, 90.0, 30.0, 300.0, "SOFT", True)]), lake.bronze, "laps")
    folder = f"{lake.bronze}/laps/year=2022/round=1/session_type=R"
    old = time.time() - 30 * 86400
    for name in os.listdir(folder):
        os.utime(f"{folder}/{name}", (old, old))
    run_incremental(spark, lake, tables=("silver_laps",), with_gold=False)
    assert {r.year for r in lake.silver("silver_laps").read(spark).collect()} == {2022, 2023, 2024}


def test_torn_commits_conflicts_and_vacuum(spark, tmpdir_fresh):
    table = VersionedTable(f"{tmpdir_fresh}/gold", schemas.GOLD_TEAM, schemas.GOLD_TEAM_KEY)
    teams = [gold.gold_team_season_stats(_silver(spark, [lap(team=t)])) for t in ("RB", "MER", "FER")]
    table.overwrite(spark, teams[0])
    open(f"{table.commits}/{2:020d}", "w").close()                   # a commit file without content
    assert table.current_version(spark) == 1 and [r.team for r in table.read(spark).collect()] == ["RB"]
    with pytest.raises(CommitConflict):                               # its number is taken all the same
        table.commit(spark, teams[1], base=1)
    table.commit(spark, teams[1], base=2)
    with pytest.raises(CommitConflict):
        table.commit(spark, teams[2], base=2)
    pending = f"{table.root}/v000009-inflight"
    os.makedirs(pending)
    removed = table.vacuum(spark, keep=1)
    assert len(removed) == 1 and os.path.isdir(pending) and [r.team for r in table.read(spark).collect()] == ["MER"]


def test_second_import_reads_nothing_and_settings_are_put_back(spark, tmpdir_fresh):
    archive, lake = f"{tmpdir_fresh}/archive", Layout(f"{tmpdir_fresh}/lake")
    os.makedirs(archive)
    table = pa.table({"Driver": ["VER"], "LapNumber": [1.0], "LapTime": pa.array([90_000_000_000], pa.int64()), "IsAccurate": [True]})
    pq.write_table(table, f"{archive}/laps_checkpoint_2024_r1_R.parquet")
    before = spark.conf.get(bronze.NANOS_AS_LONG, None)
    assert medallion.import_archive(spark, archive, lake)["laps"]["files"] == 1
    assert spark.conf.get(bronze.NANOS_AS_LONG, None) == before
    assert medallion.import_archive(spark, archive, lake) == {}
    pq.write_table(table, f"{archive}/laps_checkpoint_2024_r2_R.parquet")
    assert medallion.import_archive(spark, archive, lake)["laps"]["files"] == 1
    assert bronze.scan_bronze(spark, lake.bronze, "laps").count() == 2


def test_a_cluster_without_a_shared_folder_is_an_error():
    from paddock.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())
