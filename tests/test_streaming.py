"""Incremental refresh: only new bronze files are processed; reruns change nothing."""

from pyspark.sql import functions as F

from paddock.plans.medallion import Layout
from paddock.sources import bronze
from paddock.streaming.incremental import run_incremental

from .test_edges import laps_frame


def _session(spark, rnd, n, t0=90.0):
    rows = [(2024, rnd, "R", f"GP_{rnd}", d, "RB", float(i), t0 + i, 30.0, 300.0, "SOFT", True)
            for i in range(n) for d in ("A", "B")]
    return laps_frame(spark, rows)


def test_new_sessions_are_picked_up_and_reruns_are_noops(spark, tmpdir_fresh):
    layout = Layout(f"{tmpdir_fresh}/lake")
    ck = f"{tmpdir_fresh}/streams"
    bronze.write_bronze(_session(spark, 1, 3).unionByName(_session(spark, 2, 2)), layout.bronze, "laps")
    run_incremental(spark, layout, checkpoint_base=ck)      # no tel/weather bronze yet: skipped
    silver = layout.silver("silver_laps")
    assert silver.read(spark).count() == 10
    g1 = layout.gold("gold_driver_performance")
    assert g1.read(spark).count() == 4 and g1.current_version(spark) == 1

    bronze.write_bronze(_session(spark, 3, 1), layout.bronze, "laps")
    run_incremental(spark, layout, tables=("silver_laps",), checkpoint_base=ck)
    assert silver.read(spark).count() == 12
    assert g1.read(spark).count() == 6
    assert {r.round for r in silver.read(spark).select("round").distinct().collect()} == {1, 2, 3}

    before = sorted(tuple(r) for r in silver.read(spark).collect())
    run_incremental(spark, layout, tables=("silver_laps",), checkpoint_base=ck)
    assert sorted(tuple(r) for r in silver.read(spark).collect()) == before
    assert g1.current_version(spark) == 2          # nothing new: no new gold version

    team = layout.gold("gold_team_season_stats").read(spark).collect()
    assert [(r.team, r.total_laps, r.drivers_count) for r in team] == [("RB", 3, 2)]


def test_replaced_session_file_replaces_the_slice(spark, tmpdir_fresh):
    layout = Layout(f"{tmpdir_fresh}/lake")
    ck = f"{tmpdir_fresh}/streams"
    bronze.write_bronze(_session(spark, 1, 3), layout.bronze, "laps")
    run_incremental(spark, layout, tables=("silver_laps",), checkpoint_base=ck, with_gold=False)
    bronze.write_bronze(_session(spark, 1, 1, t0=80.0), layout.bronze, "laps")   # re-delivered session
    run_incremental(spark, layout, tables=("silver_laps",), checkpoint_base=ck, with_gold=False)
    rows = layout.silver("silver_laps").read(spark).filter(F.col("round") == 1).collect()
    assert sorted(r.lap_time_s for r in rows) == [80.0, 80.0]


def test_telemetry_stream_refreshes_silver_car_data(spark, tmpdir_fresh):
    layout = Layout(f"{tmpdir_fresh}/lake")
    car = spark.createDataFrame([(2024, 1, "R", "GP_1", d, 100.0 + i, 9000.0, 50.0)
                                 for i, d in enumerate(("A", "B", "A"))],
                                "year int, round int, session_type string, grand_prix string, driver string, "
                                "Speed double, RPM double, Throttle double") \
        .withColumn("Date", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, Speed)"))
    bronze.write_bronze(car, layout.bronze, "tel")
    run_incremental(spark, layout, checkpoint_base=f"{tmpdir_fresh}/streams")
    rows = layout.silver("silver_car_data").read(spark).collect()
    assert sorted((r.driver, r.speed_kmh) for r in rows) == [("A", 100.0), ("A", 102.0), ("B", 101.0)]
