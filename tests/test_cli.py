"""Archive import, session selection and the whole run through the command line entry."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from paddock.plans import medallion


def _laps(rnd, n, year=2024):
    return pa.table({
        "Year": [year] * n, "Round": [rnd] * n, "GrandPrix": [f"GP_{rnd}"] * n, "Driver": ["VER"] * n,
        "Team": ["RB"] * n, "LapNumber": [float(i + 1) for i in range(n)],
        "LapTime": pa.array([90_000_000_000 + i for i in range(n)], pa.int64()),
        "SpeedST": [300.0] * n, "Compound": ["SOFT"] * n, "IsAccurate": [True] * n,
    })


def test_import_select_and_run(spark, tmpdir_fresh):
    archive = f"{tmpdir_fresh}/archive"
    import os
    os.makedirs(archive)
    pq.write_table(_laps(1, 3), f"{archive}/laps_checkpoint_2024_r1_R.parquet")
    pq.write_table(_laps(1, 1), f"{archive}/laps_checkpoint_2024_r1.parquet")      # legacy twin: loses
    pq.write_table(_laps(2, 2), f"{archive}/laps_checkpoint_2024_r2_Q.parquet")
    pq.write_table(_laps(3, 2, year=2023), f"{archive}/laps_checkpoint_2024_r3_R.parquet")  # disagrees
    lake = medallion.Layout(f"{tmpdir_fresh}/lake")
    report = medallion.import_archive(spark, archive, lake)
    assert report == {"laps": {"files": 3, "rejected_rows": 2}}
    sessions = medallion.select_sessions(spark, lake, seasons=[2024])
    assert sessions == [(2024, 1, "R"), (2024, 2, "Q")]
    assert medallion.select_sessions(spark, lake, seasons=[2024], session_types=["Q"]) == [(2024, 2, "Q")]
    with pytest.raises(FileNotFoundError):
        medallion.select_sessions(spark, lake, seasons=[2024, 2019], strict=True)
    medallion.run_silver(spark, lake, sessions)
    laps = lake.silver("silver_laps").read(spark)
    assert laps.count() == 5 and {r.lap_time_s for r in laps.collect()} >= {90.0, 90.000000001}
    medallion.run_gold(spark, lake)
    g = lake.gold("gold_driver_performance").read(spark).collect()
    assert sorted((r.grand_prix, r.session_type, r.total_laps, r.rank_in_race) for r in g) == [
        ("GP_1", "R", 3, 1), ("GP_2", "Q", 2, 1)]
    q = {m["metric"]: (m["value_pct"], m["passed"]) for m in medallion.contract_metrics(spark, lake)}
    assert q == {"completeness_avg_lap_time_s": (100.0, True), "validity_session_type": (100.0, True),
                 "consistency_lap_time": (100.0, True)}


def test_cli_arguments():
    from paddock.__main__ import parse_args
    a = parse_args(["--lake", "/x", "--seasons", "2024", "2025", "--sessions", "R", "--gold", "rebuild"])
    assert (a.seasons, a.sessions, a.gold, a.incremental) == ([2024, 2025], ["R"], "rebuild", False)


def test_sizing_follows_input_and_leaves_the_deployment_alone(spark, monkeypatch):
    from paddock import session
    from paddock.session import MB, size_for_input

    class Unset:
        """A deployment that has set nothing but the named key."""
        def __init__(self, *keys):
            self.keys = keys

        def contains(self, key):
            return key in self.keys

    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = {k: spark.conf.get(k) for k in keys}
    try:
        monkeypatch.setattr(type(spark.sparkContext), "getConf", lambda self: Unset())
        assert size_for_input(spark, 10) == 2 * spark.sparkContext.defaultParallelism
        assert size_for_input(spark, 100_000 * MB) == 782
        assert size_for_input(spark, 100_000_000 * MB) == 20_000
        monkeypatch.setattr(type(spark.sparkContext), "getConf", lambda self: Unset("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        assert size_for_input(spark, 100_000 * MB) == 7
    finally:
        monkeypatch.undo()
        for k, v in before.items():
            spark.conf.set(k, v)
    assert session.MB == MB


def test_session_without_files_of_a_kind_keeps_its_silver_rows(spark, tmpdir_fresh):
    from pyspark.sql import functions as F

    from paddock.sources import bronze
    lake = medallion.Layout(f"{tmpdir_fresh}/lake")
    car = spark.createDataFrame([(2024, r, "R", "GP", "VER", 100.0, 9000.0, 50.0) for r in (1, 2)],
                                "year int, round int, session_type string, grand_prix string, driver string, "
                                "Speed double, RPM double, Throttle double") \
        .withColumn("Date", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    bronze.write_bronze(car, lake.bronze, "tel")
    medallion.run_silver(spark, lake, [(2024, 1, "R"), (2024, 2, "R")])
    bronze.write_bronze(car.filter("round = 1").withColumn("Speed", F.lit(200.0)), lake.bronze, "tel")
    # round 2's telemetry folder is gone from bronze for this test: remove it
    from paddock.sources.tables import delete_path
    delete_path(spark, f"{lake.bronze}/tel/year=2024/round=2")
    medallion.run_silver(spark, lake, [(2024, 1, "R"), (2024, 2, "R")])
    got = sorted((r.round, r.speed_kmh) for r in lake.silver("silver_car_data").read(spark).collect())
    assert got == [(1, 200.0), (2, 100.0)]


def test_main_end_to_end(spark, tmpdir_fresh, capsys):
    import json

    from paddock.__main__ import main
    archive = f"{tmpdir_fresh}/archive"
    import os
    os.makedirs(archive)
    pq.write_table(_laps(1, 3), f"{archive}/laps_checkpoint_2024_r1_R.parquet")
    lake = f"{tmpdir_fresh}/lake"
    assert main(["--lake", lake, "--import-archive", archive, "--seasons", "2024"], spark=spark) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["sessions"] == 1 and report["silver"]["silver_laps"]["rows"] == 3
    assert {m["metric"] for m in report["quality"]} == {
        "completeness_avg_lap_time_s", "validity_session_type", "consistency_lap_time"}
    assert main(["--lake", lake, "--incremental"], spark=spark) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["incremental"] == "done"


def test_events_after_the_given_day_are_left_out(spark, tmpdir_fresh):
    import datetime as dt

    from paddock.__main__ import parse_args
    from paddock.sources import bronze

    from .test_edges import laps_frame
    lake = medallion.Layout(f"{tmpdir_fresh}/lake")
    rows = [(2024, r, "R", "GP", "VER", "RB", 1.0, 90.0, 30.0, 300.0, "SOFT", True) for r in (1, 2, 3, 4)]
    bronze.write_bronze(laps_frame(spark, rows), lake.bronze, "laps")
    calendar = spark.createDataFrame([(2024, 1, dt.date(2024, 3, 1)), (2024, 2, dt.date(2024, 4, 1)), (2024, 3, None)],
                                     "year int, round int, event_date date")
    found = medallion.select_sessions(spark, lake, as_of=dt.date(2024, 3, 1), calendar=calendar)
    assert found == [(2024, 1, "R"), (2024, 3, "R"), (2024, 4, "R")]   # no date: nothing says that it is still to come
    with pytest.raises(SystemExit):
        parse_args(["--lake", "x", "--as-of", "2024-03-01"])
