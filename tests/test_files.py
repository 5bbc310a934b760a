"""Bronze files on disk: legacy and suffixed names, nanosecond types, mixed schemas."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from paddock.operators import silver
from paddock.sources import bronze


def _write(path, table):
    pq.write_table(table, path, version="2.6")


def _laps_table(n, year=2024, rnd=1, speed_type=pa.float64(), nanos=False):
    lap_time = pa.array([90_500_000_000 + i for i in range(n)], pa.int64()) if nanos \
        else pa.array([90.5 + i for i in range(n)], pa.float64())
    return pa.table({
        "Year": pa.array([year] * n, pa.int64()),
        "Round": pa.array([rnd] * n, pa.int64()),
        "GrandPrix": pa.array(["Bahrain"] * n),
        "Driver": pa.array(["VER"] * n),
        "LapNumber": pa.array([float(i + 1) for i in range(n)]),
        "LapTime": lap_time,
        "SpeedST": pa.array([300 + i for i in range(n)], speed_type),
        "IsAccurate": pa.array([True] * n),
    })


def test_listing_parses_legacy_and_suffixed_names(spark, tmpdir_fresh):
    for name in ("laps_checkpoint_2024_r1_R.parquet", "laps_checkpoint_2024_r1.parquet",
                 "laps_checkpoint_2024_r2_Q.parquet", "tel_checkpoint_2024_r1_R.parquet", "notes.parquet"):
        _write(f"{tmpdir_fresh}/{name}", _laps_table(1))
    files = bronze.parse_checkpoint_listing(bronze.list_files(spark, tmpdir_fresh, "laps_checkpoint_*.parquet"))
    got = sorted((r.year, r.round, r.session_type, r.is_legacy) for r in files.collect())
    assert got == [(2024, 1, "R", False), (2024, 1, "R", True), (2024, 2, "Q", False)]
    chosen = bronze.prefer_suffixed(files).collect()
    assert sorted((r.round, r.session_type, r.file_name) for r in chosen) == [
        (1, "R", "laps_checkpoint_2024_r1_R.parquet"), (2, "Q", "laps_checkpoint_2024_r2_Q.parquet")]
    sessions = bronze.discover_checkpoint_sessions(spark, tmpdir_fresh, "laps").collect()
    assert sorted(tuple(r) for r in sessions) == [(2024, 1, "R"), (2024, 2, "Q")]


def test_mixed_double_bigint_schemas_and_nanos(spark, tmpdir_fresh):
    a = f"{tmpdir_fresh}/laps_checkpoint_2024_r1_R.parquet"
    b = f"{tmpdir_fresh}/laps_checkpoint_2024_r2.parquet"
    _write(a, _laps_table(2, rnd=1, speed_type=pa.float64()))
    _write(b, _laps_table(3, rnd=2, speed_type=pa.int64(), nanos=True))
    df = bronze.read_checkpoint_files(spark, [a, b])
    ok, rejected = bronze.label_from_file(df)
    assert rejected.count() == 0
    assert dict(ok.dtypes)["SpeedST"] == "double" and dict(ok.dtypes)["LapTime"] == "double"
    laps = silver.transform_laps(ok).orderBy("round", "lap_number").collect()
    assert [(r.round, r.session_type, r.lap_time_s) for r in laps] == [
        (1, "R", 90.5), (1, "R", 91.5), (2, "R", 90.5), (2, "R", 90.500000001), (2, "R", 90.500000002)]
    assert [r.speed_st for r in laps] == [300.0, 301.0, 300.0, 301.0, 302.0]


def test_timestamp_nanos_become_utc_micros(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/tel_checkpoint_2024_r1_R.parquet"
    ts = pa.array([1704067207179575123], pa.timestamp("ns"))
    _write(p, pa.table({"Date": ts, "Driver": ["1"], "Speed": [100.0], "RPM": [9000.0], "Throttle": [50.0],
                        "Year": [2024], "Round": [1]}))
    df = bronze.read_checkpoint_files(spark, [p])
    assert dict(df.dtypes)["Date"] == "timestamp_ntz"
    assert df.first()["Date"] == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    ok, _ = bronze.label_from_file(df)
    car = silver.transform_car_data(ok).first()
    assert car.recorded_at == dt.datetime(2024, 1, 1, 0, 0, 7, 179575) and car.driver == "1"


def test_interval_durations_convert_to_seconds(spark):
    df = spark.range(1).select(F.make_dt_interval(secs=F.lit(90.123456).cast("decimal(18,6)")).alias("LapTime"))
    from paddock.operators import conform
    assert conform.conform_bronze_types(df).first()["LapTime"] == 90.123456


def test_rows_disagreeing_with_their_file_are_rejected(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/laps_checkpoint_2024_r3_Q.parquet"
    _write(p, _laps_table(2, rnd=4))
    ok, rejected = bronze.label_from_file(bronze.read_checkpoint_files(spark, [p]))
    assert ok.count() == 0 and rejected.count() == 2


def test_partitioned_bronze_roundtrip_and_pruning(spark, tmpdir_fresh):
    rows = [(2024, r, s, "GP", "VER", float(i), 90.0 + i, True) for r in (1, 2) for s in ("R", "Q") for i in range(3)]
    df = spark.createDataFrame(rows, "year int, round int, session_type string, grand_prix string, Driver string, "
                                     "LapNumber double, LapTime double, IsAccurate boolean")
    bronze.write_bronze(df, tmpdir_fresh, "laps")
    found = sorted(tuple(r) for r in bronze.discover_partition_sessions(spark, tmpdir_fresh, "laps").collect())
    assert found == [(2024, 1, "Q"), (2024, 1, "R"), (2024, 2, "Q"), (2024, 2, "R")]
    wanted = spark.createDataFrame([(2024, 2, "Q")], "year int, round int, session_type string")
    scan = bronze.scan_bronze(spark, tmpdir_fresh, "laps", wanted)
    assert scan.count() == 3
    # Re-writing one session replaces only that session.
    bronze.write_bronze(df.filter((F.col("round") == 1) & (F.col("session_type") == "R")).limit(1),
                        tmpdir_fresh, "laps")
    assert bronze.scan_bronze(spark, tmpdir_fresh, "laps").count() == 10


def test_archive_folders_with_mixed_schemas(spark, tmpdir_fresh):
    a = spark.createDataFrame([(2024, 1, "R", "VER", 100.0, 9000.0, 50.0)],
                              "Year int, Round int, SessionType string, Driver string, Speed double, RPM double, "
                              "Throttle double").withColumn("Date", F.lit("2024-01-01 00:00:01").cast("timestamp_ntz"))
    b = spark.createDataFrame([(2024, 2, "R", "HAM", 120, 9500.0, 60.0)],
                              "Year int, Round int, SessionType string, Driver string, Speed long, RPM double, "
                              "Throttle double").withColumn("Date", F.lit("2024-01-02 00:00:02").cast("timestamp_ntz"))
    for df in (a, b):
        written = bronze.write_checkpoint_archive(df, tmpdir_fresh, "tel", labels=("Year", "Round", "SessionType"))
        assert written.count() == 1
    listing = bronze.parse_checkpoint_listing(bronze.list_files(spark, tmpdir_fresh, recursive=True))
    entries = sorted(r.entry for r in listing.select("entry").distinct().collect())
    assert [e.rsplit("/", 1)[1] for e in entries] == ["tel_checkpoint_2024_r1_R.parquet",
                                                      "tel_checkpoint_2024_r2_R.parquet"]
    ok, rejected = bronze.label_from_file(bronze.read_checkpoint_files(spark, entries))
    car = silver.transform_car_data(ok).orderBy("round").collect()
    assert [(r.round, r.driver, r.speed_kmh) for r in car] == [(1, "VER", 100.0), (2, "HAM", 120.0)]
    assert car[1].recorded_at == dt.datetime(2024, 1, 2, 0, 0, 2)
    assert rejected.count() == 0


def test_rows_without_a_file_label_are_rejected_not_lost(spark):
    df = spark.createDataFrame([(2024, 1, None, None, "R"), (2024, 1, 2024, 1, "R")],
                               "Year int, Round int, file_year int, file_round int, file_session_type string")
    ok, rejected = bronze.label_from_file(df)
    assert ok.count() == 1 and rejected.count() == 1


def test_archive_files_follow_sessions_not_batches(spark, tmpdir_fresh, monkeypatch):
    import glob

    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    monkeypatch.setattr(bronze, "ARCHIVE_ROW_GROUP", 30)
    df = spark.range(0, 400, 1, 8).selectExpr(
        "2024 AS Year", "CAST(id % 2 + 1 AS INT) AS Round", "IF(id % 4 < 2, 'R', 'Q') AS SessionType", "'VER' AS Driver",
        "CAST(id AS DOUBLE) AS LapNumber", "IF(id % 5 = 0, NULL, id / 4) AS LapTime")
    spark.conf.set(batch, "10")
    try:
        written = bronze.write_checkpoint_archive(df, tmpdir_fresh, "laps", labels=("Year", "Round", "SessionType"),
                                                  durations=("LapTime",)).collect()
    finally:
        spark.conf.set(batch, before)
    files = glob.glob(f"{tmpdir_fresh}/*/*.parquet")
    assert sorted(files) == sorted(r.path for r in written)
    assert len(files) == 4 and {r.rows for r in written} == {100}   # 160 when each batch wrote its own: 8 tasks x 5 x 4 sessions
    assert [pq.ParquetFile(f).metadata.num_row_groups for f in files] == [4] * 4
    ok, rejected = bronze.label_from_file(bronze.read_checkpoint_files(spark, sorted(glob.glob(f"{tmpdir_fresh}/*"))))
    assert rejected.count() == 0
    got = sorted((r.round, r.session_type, r.LapNumber, r.LapTime) for r in ok.collect())
    assert got == sorted((i % 2 + 1, "R" if i % 4 < 2 else "Q", float(i), None if i % 5 == 0 else i / 4) for i in range(400))


def test_a_hot_session_is_archived_by_several_tasks(spark, tmpdir_fresh):
    import glob

    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    df = spark.range(0, 60_000, 1, 6).selectExpr("2024 AS Year", "IF(id % 100 = 0, 2, 1) AS Round", "'R' AS SessionType", "uuid() AS Driver",
                                                 "CAST(id AS DOUBLE) AS LapNumber")
    spark.conf.set(size, "400k")
    try:
        written = bronze.write_checkpoint_archive(df, tmpdir_fresh, "laps", labels=("Year", "Round", "SessionType"), legacy=True).collect()
    finally:
        spark.conf.unset(size)
    hot = glob.glob(f"{tmpdir_fresh}/laps_checkpoint_2024_r1.parquet/*.parquet")
    assert 2 <= len(hot) and len(written) <= 16
    back = bronze.read_checkpoint_files(spark, glob.glob(f"{tmpdir_fresh}/*"))
    assert {r.file_round: (r.n, r.d) for r in back.groupBy("file_round").agg(
        F.count("*").alias("n"), F.countDistinct("LapNumber").alias("d")).collect()} == {1: (59_400, 59_400), 2: (600, 600)}
