"""Literal edge frames: NULL/NaN, range boundaries, ties, case, duplicates, missing columns."""

import math

from pyspark.sql import functions as F

from paddock import schemas
from paddock.operators import conform, gold, quality, refresh, silver


def laps_frame(spark, rows, extra_cols=()):
    cols = ["year", "round", "session_type", "grand_prix", "Driver", "Team", "LapNumber", "LapTime",
            "Sector1Time", "SpeedST", "Compound", "IsAccurate", *extra_cols]
    types = ("year int, round int, session_type string, grand_prix string, Driver string, Team string, "
             "LapNumber double, LapTime double, Sector1Time double, SpeedST double, Compound string, "
             "IsAccurate boolean")
    for c in extra_cols:
        types += f", {c} double"
    return spark.createDataFrame(rows, types).select(*cols)


def lap(driver="VER", team="RB", lap_no=1.0, t=90.0, s1=30.0, speed=300.0, compound="SOFT", acc=True, st="R"):
    return (2024, 1, st, "GP_1", driver, team, lap_no, t, s1, speed, compound, acc)


def test_lap_time_null_nan_zero_negative_are_dropped(spark):
    df = laps_frame(spark, [lap(t=None), lap(t=float("nan"), lap_no=2.0), lap(t=0.0, lap_no=3.0),
                            lap(t=-1.0, lap_no=4.0), lap(t=80.5, lap_no=5.0)])
    out = silver.transform_laps(df).collect()
    assert [r.lap_time_s for r in out] == [80.5]


def test_inaccurate_and_null_accuracy_and_null_driver_are_dropped(spark):
    df = laps_frame(spark, [lap(acc=False), lap(acc=None, lap_no=2.0), lap(driver=None, lap_no=3.0),
                            lap(lap_no=4.0)])
    assert [r.lap_number for r in silver.transform_laps(df).collect()] == [4.0]


def test_missing_position_becomes_typed_null(spark):
    df = laps_frame(spark, [lap()])
    out = silver.transform_laps(df)
    assert dict(out.dtypes)["position"] == "double"
    assert out.first().position is None


def test_present_position_is_kept(spark):
    df = laps_frame(spark, [lap() + (3.0,)], extra_cols=("Position",))
    assert silver.transform_laps(df).first().position == 3.0


def test_silver_schema_is_declared(spark):
    out = silver.transform_laps(laps_frame(spark, [lap()]))
    assert [(f.name, f.dataType) for f in out.schema.fields] == \
        [(f.name, f.dataType) for f in schemas.SILVER_LAPS.fields]


def test_speed_boundaries_are_inclusive(spark):
    rows = [(2024, 1, "R", "GP_1", "VER", None, s, 10000.0, 50.0, True) for s in (-0.1, 0.0, 400.0, 400.1)]
    df = spark.createDataFrame(rows, "year int, round int, session_type string, grand_prix string, driver string, "
                                     "Date timestamp_ntz, Speed double, RPM double, Throttle double, Brake boolean")
    df = df.withColumn("Date", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    assert sorted(r.speed_kmh for r in silver.transform_car_data(df).collect()) == [0.0, 400.0]


def test_air_temperature_boundaries(spark):
    rows = [(2024, 1, "R", "GP_1", float(i), t, 50.0) for i, t in enumerate((-10.0001, -10.0, 60.0, 60.0001))]
    df = spark.createDataFrame(rows, "year int, round int, session_type string, grand_prix string, Time double, "
                                     "AirTemp double, Humidity double")
    assert sorted(r.air_temp_c for r in silver.transform_weather(df).collect()) == [-10.0, 60.0]


def test_driver_column_case_insensitive(spark):
    # A car frame carrying lower-case ``driver`` must not be overwritten by a NULL ``Driver``.
    df = spark.createDataFrame([(2024, 1, "R", "GP_1", "VER", 100.0, 10000.0, 50.0)],
                               "year int, round int, session_type string, grand_prix string, driver string, "
                               "Speed double, RPM double, Throttle double")
    out = conform.require_columns(df, schemas.CAR_DATA_REQUIRED + ["Driver"])
    assert out.first()["driver"] == "VER"


def test_compound_counts_are_case_sensitive(spark):
    df = laps_frame(spark, [lap(compound="soft"), lap(compound="WET", lap_no=2.0), lap(compound="SOFT", lap_no=3.0),
                            lap(compound=None, lap_no=4.0), lap(compound="HARD", lap_no=5.0)])
    r = gold.gold_driver_performance(silver.transform_laps(df)).first()
    assert (r.soft_laps, r.medium_laps, r.hard_laps, r.total_laps) == (1, 0, 1, 5)


def test_rank_ties_on_rounded_best_lap_leave_a_gap(spark):
    df = laps_frame(spark, [lap(driver="A", t=80.0001), lap(driver="B", t=80.0004), lap(driver="C", t=81.0)])
    ranks = {r.driver: r.rank_in_race for r in gold.gold_driver_performance(silver.transform_laps(df)).collect()}
    assert ranks == {"A": 1, "B": 1, "C": 3}


def test_null_team_laps_are_rejected_before_ranking(spark):
    df = laps_frame(spark, [lap(driver="A", team=None, t=70.0), lap(driver="B", t=80.0)])
    out = gold.gold_driver_performance(silver.transform_laps(df)).collect()
    assert [(r.driver, r.rank_in_race) for r in out] == [("B", 1)]
    assert gold.gold_rejects(silver.transform_laps(df)).count() == 1


def test_average_is_exact_half_up(spark):
    # 0.0005 averages: a double sum would land either side of the tie.
    df = laps_frame(spark, [lap(t=90.0005, lap_no=1.0), lap(t=90.0005, lap_no=2.0)])
    r = gold.gold_driver_performance(silver.transform_laps(df)).first()
    assert r.avg_lap_time_s == 90.001 and r.best_lap_time_s == 90.001


def test_duplicate_key_with_different_payload(spark):
    df = laps_frame(spark, [lap(t=90.0), lap(t=85.0), lap(lap_no=2.0)])
    laps = silver.transform_laps(df)
    v = refresh.pk_violations(laps, schemas.SILVER_LAPS_KEY).collect()
    assert [(r.lap_number, r.duplicate_rows) for r in v] == [(1.0, 2)]
    d = refresh.dedup_by_key(laps, schemas.SILVER_LAPS_KEY).orderBy("lap_number").collect()
    assert [(r.lap_number, r.lap_time_s) for r in d] == [(1.0, 85.0), (2.0, 90.0)]


def test_quality_metrics(spark):
    df = laps_frame(spark, [lap(t=90.0), lap(t=250.0, lap_no=2.0), lap(st="S", lap_no=3.0)])
    laps = silver.transform_laps(df)
    g = gold.gold_driver_performance(laps)
    assert quality.completeness(g).first().value_pct == 100.0
    v = quality.session_validity(g).first()
    assert (v.value_pct, v.passed) == (50.0, False)
    c = quality.lap_consistency(laps).first()
    assert math.isclose(c.value_pct, 66.667) and c.passed is False


def test_not_null_report(spark):
    df = laps_frame(spark, [lap(team=None), lap(lap_no=2.0)])
    rep = {r.column_name: r.null_rows for r in
           refresh.not_null_violations(silver.transform_laps(df), schemas.GOLD_DRIVER_KEY).collect()}
    assert rep == {"year": 0, "grand_prix": 0, "session_type": 0, "driver": 0, "team": 1}


def test_numeric_and_boolean_physical_forms_conform(spark):
    # Brake / DRS / nGear / Rainfall may arrive as numbers or booleans; strings may be malformed.
    car = spark.createDataFrame(
        [(2024, 1, "R", "GP_1", "VER", "100.5", 9000, 50.0, 1, 8.0, "7"),
         (2024, 1, "R", "GP_1", "HAM", "oops", 9000, 50.0, 0, 0.0, "x")],
        "year int, round int, session_type string, grand_prix string, driver string, Speed string, RPM long, "
        "Throttle double, Brake int, DRS double, nGear string").withColumn(
        "Date", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    rows = silver.transform_car_data(car).collect()
    assert [(r.driver, r.speed_kmh, r.rpm, r.brake_on, r.drs_active, r.gear) for r in rows] == [
        ("VER", 100.5, 9000.0, True, 8, 7)]
    weather = spark.createDataFrame([(2024, 1, "R", "GP_1", 1.0, 20.0, 50.0, 1.0), (2024, 1, "R", "GP_1", 2.0, 21.0,
                                                                                   40.0, 0.0)],
                                    "year int, round int, session_type string, grand_prix string, Time double, "
                                    "AirTemp double, Humidity double, Rainfall double")
    assert sorted(r.is_raining for r in silver.transform_weather(weather).collect()) == [False, True]
