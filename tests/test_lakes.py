"""Published versions: readers during a refresh, failed writes and runs, the gate, states, rejects of one pass, counts of a write."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from paddock import schemas
from paddock.operators import gold, refresh, silver
from paddock.plans import lakes, medallion
from paddock.plans.medallion import Layout
from paddock.sources import bronze, tables
from paddock.sources.tables import CommitConflict, SliceTable
from paddock.streaming.incremental import run_incremental

from .conftest import SF_SMALL
from .test_edges import lap, laps_frame

KEY = schemas.SILVER_LAPS_KEY


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def laps(spark, *sessions):
    """(round, lap time, accurate) -> two laps of one driver each."""
    return laps_frame(spark, [(2024, r, "R", "GP", "VER", "RB", float(10 * r + k), t, 30.0, 300.0, "SOFT", ok)
                              for r, t, ok in sessions for k in range(2)])


def silver_of(spark, *sessions):
    return silver.transform_laps(laps(spark, *sessions))


def slice_table(folder):
    return SliceTable(f"{folder}/silver_laps", schemas.SILVER_LAPS, KEY)


def test_a_reader_keeps_its_map_while_slices_are_refreshed(spark, tmpdir_fresh):
    table = slice_table(tmpdir_fresh)
    table.refresh(spark, silver_of(spark, (1, 90.0, True), (2, 91.0, True)))
    open_read = table.read(spark)
    before = rows_of(open_read)
    table.refresh(spark, silver_of(spark, (1, 80.0, True)), requested=[(2024, 1, "R"), (2024, 2, "R")])
    assert rows_of(open_read) == before                     # planned before: old in full
    assert {(r["round"], r.lap_time_s) for r in table.read(spark).collect()} == {(1, 80.0)}
    assert rows_of(table.read(spark, version=1)) == before  # old versions stay readable until vacuum
    assert table.vacuum(spark, keep=1) == 2 and len(rows_of(table.read(spark))) == 2


@pytest.mark.parametrize("where", ["write", "guard", "publish"])
def test_a_refresh_that_fails_leaves_the_old_table(spark, tmpdir_fresh, where, monkeypatch):
    table = slice_table(tmpdir_fresh)
    table.refresh(spark, silver_of(spark, (1, 90.0, True), (2, 91.0, True)))
    before = rows_of(table.read(spark))
    stage, guard = silver_of(spark, (1, 80.0, True), (2, 81.0, True)), None
    if where == "write":                                    # one of its rows can't be computed
        stage = stage.withColumn("lap_time_s", F.when(F.col("round") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("lap_time_s")))
    elif where == "guard":
        def guard(report):
            raise ValueError(report["rows"])
    else:
        def torn(*args):
            raise OSError("lost the file system")
        monkeypatch.setattr(tables, "_write_text_once", torn)
    with pytest.raises(Exception):  # noqa: B017
        table.refresh(spark, stage, check_key=False, guard=guard)
    monkeypatch.undo()
    assert rows_of(table.read(spark)) == before and table.current_version(spark) == 1
    table.refresh(spark, silver_of(spark, (1, 70.0, True)))
    assert {(r["round"], r.lap_time_s) for r in table.read(spark).collect()} == {(1, 70.0), (2, 91.0)}


def test_two_writers_of_different_slices_both_count(spark, tmpdir_fresh, monkeypatch):
    table, calls = slice_table(tmpdir_fresh), []
    real = tables.CommitLog.publish

    def racing(self, spark_, version, text):
        if not calls:
            calls.append(1)
            slice_table(tmpdir_fresh).refresh(spark, silver_of(spark, (2, 91.0, True)), check_key=False)
        return real(self, spark_, version, text)

    monkeypatch.setattr(tables.CommitLog, "publish", racing)
    table.refresh(spark, silver_of(spark, (1, 90.0, True)), check_key=False)
    assert {r["round"] for r in table.read(spark).collect()} == {1, 2} and table.current_version(spark) == 2


def test_null_and_odd_session_values(spark, tmpdir_fresh):
    table = SliceTable(f"{tmpdir_fresh}/t", refresh.reject_schema(schemas.SILVER_LAPS), KEY)
    base = silver_of(spark, (1, 90.0, True)).withColumn("reason", F.lit("x"))
    odd = base.withColumn("session_type", F.lit("Q/=%'\\ é"))
    none = base.withColumn("session_type", F.lit(None).cast("string")).withColumn("year", F.lit(None).cast("int"))
    report = table.refresh(spark, base.unionByName(odd).unionByName(none), check_key=False)
    assert report["rows"] == 6 and [s["row_count"] for s in report["slice_rows"]] == [2, 2, 2]
    assert len(rows_of(table.read(spark))) == 6
    table.refresh(spark, base.limit(0), requested=[(None, 1, None), (2024, 1, "Q/=%'\\ é")], check_key=False)
    assert {r.session_type for r in table.read(spark).collect()} == {"R"}
    assert table.vacuum(spark, keep=1) == 2


def test_counts_come_from_the_write_itself(spark, tmpdir_fresh):
    stage, table = silver_of(spark, (1, 90.0, True), (2, 91.0, True)), slice_table(tmpdir_fresh)
    spark.sparkContext.setJobGroup("counting", "counting")
    report = table.refresh(spark, stage, check_key=False)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("counting")
    spark.sparkContext.setJobGroup("other", "other")
    assert [s["row_count"] for s in report["slice_rows"]] == [2, 2]
    assert len(jobs) <= 2  # the shuffle stage that AQE runs first, and the write
    assert rows_of(table.slice_rows(spark)) == [(2024, 1, "R", 2), (2024, 2, "R", 2)]


def test_more_sessions_than_are_counted_ask_the_footers(spark, tmpdir_fresh, monkeypatch):
    monkeypatch.setattr(tables, "COUNTED_SLICES", 3)
    table = slice_table(tmpdir_fresh)
    report = table.refresh(spark, silver_of(spark, *[(r, 90.0, True) for r in range(1, 12)]), check_key=False)
    assert [s["row_count"] for s in report["slice_rows"]] == [2] * 11 and len(rows_of(table.read(spark))) == 22


def test_a_crash_between_silver_and_gold_leaves_the_epoch_before(spark, tmpdir_fresh, monkeypatch):
    lake = Layout(f"{tmpdir_fresh}/lake")
    bronze.write_bronze(laps(spark, (1, 90.0, True)), lake.bronze, "laps")
    run_incremental(spark, lake, tables=("silver_laps",))
    seen = rows_of(lake.read(spark, "silver_laps")), rows_of(lake.read(spark, "gold_driver_performance"))
    assert len(seen[0]) == 2 and len(seen[1]) == 1
    bronze.write_bronze(laps(spark, (1, 80.0, True), (2, 85.0, True)), lake.bronze, "laps")
    from paddock.streaming import incremental

    def crash(*args, **kw):
        raise RuntimeError("between silver and gold")

    monkeypatch.setattr(incremental, "run_gold", crash)
    with pytest.raises(Exception):  # noqa: B017
        run_incremental(spark, lake, tables=("silver_laps",))
    monkeypatch.undo()
    assert lake.silver("silver_laps").read(spark).count() == 4                       # silver itself went on
    assert (rows_of(lake.read(spark, "silver_laps")), rows_of(lake.read(spark, "gold_driver_performance"))) == seen
    run_incremental(spark, lake, tables=("silver_laps",))                             # the batch is done again
    assert len(rows_of(lake.read(spark, "silver_laps"))) == 4
    assert {r.best_lap_time_s for r in lake.read(spark, "gold_driver_performance").collect()} == {80.0}
    medallion.vacuum(spark, lake, keep=1)
    assert len(rows_of(lake.read(spark, "silver_laps"))) == 4


def test_gate_keeps_the_epoch_and_reports(spark, tmpdir_fresh):
    lake = Layout(f"{tmpdir_fresh}/lake")
    for t, published in ((90.0, True), (300.0, False), (91.0, True)):
        bronze.write_bronze(laps(spark, (1, t, True)), lake.bronze, "laps")
        medallion.run_silver(spark, lake)
        medallion.run_gold(spark, lake, mode="rebuild")
        report = medallion.publish_epoch(spark, lake, gate=True)
        assert report["published"] is published and len(report["quality"]) == 3
    assert {r.lap_time_s for r in lake.read(spark, "silver_laps").collect()} == {91.0}
    assert {r.lap_time_s for r in lake.read(spark, "silver_laps", 1).collect()} == {90.0}
    with pytest.raises(CommitConflict):
        lake.epochs.publish(spark, 1, "{}")


def test_incremental_gold_is_that_of_a_full_run(spark, tmpdir_fresh):
    """Random deliveries: sessions come, change, come out empty; one event has two rounds; a driver changes teams."""
    rng = random.Random(3)
    lake = Layout(f"{tmpdir_fresh}/lake")
    for _ in range(4):
        some = [(2024, r, "R", "SAME" if r < 3 else f"GP_{r}", rng.choice("ABC"), rng.choice(["X", "Y", None]), rng.choice([1.0, 2.0, 65.0, 1.5, -3.0]) + k,
                 80.0 + rng.random(), 30.0, 300.0, rng.choice(["SOFT", "HARD"]), rng.random() < 0.7)
                for r in rng.sample([1, 2, 3, 4], 2) for k in range(rng.randint(1, 6))]
        bronze.write_bronze(laps_frame(spark, some), lake.bronze, "laps")
        run_incremental(spark, lake, tables=("silver_laps",))
        now = lake.silver("silver_laps").read(spark)
        assert rows_of(lake.read(spark, "gold_driver_performance")) == rows_of(gold.gold_driver_performance(now))
        assert rows_of(lake.read(spark, "gold_team_season_stats")) == rows_of(gold.gold_team_season_stats(now))
        assert rows_of(lake.gold_rejects().read(spark).drop("reason")) == rows_of(gold.gold_rejects(now))


def test_distinct_laps_of_any_number(spark):
    numbers = [1.0, 1.0, 64.0, 63.0, 65.0, 0.0, -0.0, -1.0, -64.0, 1.5, 1.5, 2.0**53, 2.0**60, float("inf"), None, 128.0]
    df = spark.createDataFrame([(2024, "R", "T", f"D{k % 3}", n, 90.0, None, None, None, None, None) for k, n in enumerate(numbers)],
                               "year int, session_type string, team string, driver string, lap_number double, lap_time_s double, sector1_s double, "
                               "sector2_s double, sector3_s double, speed_st double, tyre_compound string").repartition(4)
    key = schemas.GOLD_TEAM_KEY
    want = df.groupBy(*key).agg(F.count_distinct("lap_number").alias("n"), F.count_distinct("driver").alias("d")).first()
    got = gold.gold_team_season_stats(df).first()
    assert (got.total_laps, got.drivers_count) == (want.n, want.d)


def test_states_merge_to_the_same_whatever_the_split(spark):
    df = silver.transform_laps(laps_frame(spark, [lap(driver=d, team=t, lap_no=float(n), t=90 + n / 7) for d, t, n in
                                                  itertools.product("ABC", "XY", (1, 2, 64, 200))]))
    whole = rows_of(gold.driver_rows(gold.lap_states(df, schemas.GOLD_DRIVER_KEY)))
    parts = [gold.lap_states(df.where(F.col("lap_number") % 3 == k), medallion.STATE_GRAIN) for k in range(3)]
    assert rows_of(gold.driver_rows(parts[0].unionByName(parts[1]).unionByName(parts[2]))) == whole


def test_gold_plans_expand_nothing(spark):
    from paddock.plans import registry
    for build in (registry.gold_driver_of, registry.gold_team_of):
        plan = build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "partial_bit_or" in plan


def test_the_stream_keeps_rejects_like_a_run(spark, tmpdir_fresh):
    rows = [lap(), lap(), lap(lap_no=None), lap(lap_no=2.0)]
    reasons = []
    for name, run in (("a", medallion.run_silver), ("b", lambda s, lake: run_incremental(s, lake, tables=("silver_laps",)))):
        lake = Layout(f"{tmpdir_fresh}/{name}")
        frame = laps_frame(spark, rows)
        text = F.when(F.col("LapNumber") == 2.0, F.lit("fast")).otherwise(F.col("SpeedST").cast("string"))
        bronze.write_bronze(frame.withColumn("SpeedST", text), lake.bronze, "laps")
        run(spark, lake)
        reasons.append(sorted(r.reason for r in lake.rejects("silver_laps").read(spark).collect()))
        assert lake.silver("silver_laps").read(spark).count() == 1
        bronze.write_bronze(laps_frame(spark, [lap()]), lake.bronze, "laps")          # a sound delivery clears them
        run(spark, lake)
        assert lake.rejects("silver_laps").read(spark).count() == 0
    assert reasons == [["duplicate key", "failed cast: SpeedST", "null key"]] * 2


def test_a_refresh_scans_bronze_once_and_leaves_no_scratch(spark, tmpdir_fresh, monkeypatch):
    import os

    from paddock.session import checkpoint_root

    lake = Layout(f"{tmpdir_fresh}/lake")
    bronze.write_bronze(laps_frame(spark, [lap(), lap(), lap(lap_no=None)]), lake.bronze, "laps")
    scans, real = [], bronze.scan_bronze
    monkeypatch.setattr(bronze, "scan_bronze", lambda *a, **k: scans.append(a) or real(*a, **k))
    root = f"{checkpoint_root(spark).removeprefix('file:')}/paddock"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    assert medallion.run_silver(spark, lake)["silver_laps"]["rejected_rows"] == 2 and len(scans) == 1
    assert {n for n in set(os.listdir(root)) - before if n.startswith(("stage-", "slice-stage"))} == set()


def test_failed_duplicates_publish_nothing(spark, tmpdir_fresh):
    lake = Layout(f"{tmpdir_fresh}/lake")
    bronze.write_bronze(laps_frame(spark, [lap(), lap()]), lake.bronze, "laps")
    with pytest.raises(ValueError, match="primary key"):
        medallion.run_silver(spark, lake, on_duplicate="fail")
    assert not lake.silver("silver_laps").exists(spark) and lakes.CHANGED != lakes.EMPTIED


def test_a_file_delivered_again_is_imported_and_nothing_else(spark, tmpdir_fresh):
    import os

    import pyarrow.parquet as pq

    from .test_cli import _laps
    archive, lake = f"{tmpdir_fresh}/archive", Layout(f"{tmpdir_fresh}/lake")
    os.makedirs(archive)
    for rnd, year in ((1, 2024), (2, 2024), (3, 2023)):          # round 3's rows disagree with its name: all rejected
        pq.write_table(_laps(rnd, 3, year=year), f"{archive}/laps_checkpoint_2024_r{rnd}_R.parquet")
    assert medallion.import_archive(spark, archive, lake) == {"laps": {"files": 3, "rejected_rows": 3}}
    assert medallion.import_archive(spark, archive, lake) == {}
    pq.write_table(_laps(2, 5), f"{archive}/laps_checkpoint_2024_r2_R.parquet")
    os.remove(f"{archive}/laps_checkpoint_2024_r1_R.parquet")
    assert medallion.import_archive(spark, archive, lake) == {"laps": {"files": 1, "rejected_rows": 0}}
    assert {r["round"]: r["count"] for r in bronze.scan_bronze(spark, lake.bronze, "laps").groupBy("round").count().collect()} == {1: 3, 2: 5}
    assert spark.read.parquet(f"{lake.root}/rejects/bronze_laps").count() == 3


def test_slices_of_older_schemas_read_by_the_newest(spark, tmpdir_fresh):
    from pyspark.sql import types as T
    older = T.StructType([T.StructField(f.name, T.StringType() if f.name == "lap_number" else f.dataType)
                          for f in schemas.SILVER_LAPS.fields if f.name not in ("stint", "speed_st")])
    SliceTable(f"{tmpdir_fresh}/t", older, KEY).refresh(spark, silver_of(spark, (1, 90.0, True), (2, 91.0, True)), check_key=False)
    table = SliceTable(f"{tmpdir_fresh}/t", schemas.SILVER_LAPS, KEY)
    table.refresh(spark, silver_of(spark, (2, 80.0, True)), check_key=False)
    got = {(r["round"], r.lap_number, r.lap_time_s, r.speed_st) for r in table.read(spark).collect()}
    assert got == {(1, 10.0, 90.0, None), (1, 11.0, 90.0, None), (2, 20.0, 80.0, 300.0), (2, 21.0, 80.0, 300.0)}
    assert table.read(spark).schema.simpleString() == schemas.SILVER_LAPS.simpleString()


def test_one_drivers_laps_skip_most_row_groups(spark, tmpdir_fresh):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "65536")
    try:
        rows = spark.range(60_000).selectExpr(
            "2024 AS year", "1 AS round", "'R' AS session_type", "'GP' AS grand_prix", "concat('D', id % 20) AS driver",
            "CAST(id AS DOUBLE) AS lap_number", "90 + rand(1) AS lap_time_s").repartition(4)
        table = SliceTable(f"{tmpdir_fresh}/t", schemas.SILVER_LAPS, KEY, "driver")
        table.refresh(spark, rows, check_key=False)
    finally:
        hadoop.unset("parquet.block.size")
    from paddock.operators.selection import driver_laps

    def scanned(df):
        assert len(df.collect()) > 0
        plan = df._jdf.queryExecution().executedPlan()
        return plan.collectLeaves().head().metrics().get("numOutputRows").get().value()

    assert scanned(table.read(spark)) == 60_000
    assert scanned(driver_laps(table.read(spark), "D7")) < 15_000 and driver_laps(table.read(spark), "D7").count() == 3_000
