"""Plan properties: lazy construction, no Python in the hot path, pushdown, partial aggregation."""

import pytest

import __spark_entry__ as entry
from paddock.plans import registry

from .conftest import SF_SMALL

# Queries that write files while being built (sources/sinks) or read a one-row
# aggregate to decide the output schema.
ACTING = {"bronze_write_roundtrip", "bronze_scan", "discover_sessions", "silver_table_scan", "silver_all",
          "incremental_silver_laps", "incremental_gold_driver", "bronze_nanos_read", "bronze_duration_read",
          "drop_all_null_columns", "bronze_scan_mixed", "bronze_scan_many_sessions", "silver_rejects", "archive_legacy_read",
          "incremental_equals_full", "incremental_equals_full_team", "silver_all_values", "silver_rejects_cast", "slice_counts_of_write", "dq_gate",
          "evolve_stored_table", "sessions_changed"}
PURE = sorted(set(registry.QUERIES) - ACTING)  # the training-data queries write tables as they go


def _plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


def _jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None) or [])


def test_building_pure_queries_runs_no_job(spark):
    spark.sparkContext.setJobGroup("build", "build")
    qs = entry.queries()
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("build"))
    for name in PURE:
        qs[name](spark, SF_SMALL)
    after = len(spark.sparkContext.statusTracker().getJobIdsForGroup("build"))
    spark.sparkContext.setJobGroup("other", "other")
    assert after == before


@pytest.mark.parametrize("name", PURE)
def test_no_python_udf_or_cartesian_product(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_gold_aggregate_is_partial_before_shuffle(spark):
    plan = _plan(entry.queries()["gold_driver_performance"](spark, SF_SMALL))
    assert "partial_" in plan and "Exchange hashpartitioning" in plan


def test_silver_filters_reach_the_bronze_scan(spark, tmpdir_fresh):
    from paddock.operators import silver
    from paddock.plans import fixtures as fx
    from paddock.sources import bronze
    bronze.write_bronze(fx.car_raw(spark, SF_SMALL), tmpdir_fresh, "tel")
    plan = _plan(silver.transform_car_data(bronze.scan_bronze(spark, tmpdir_fresh, "tel")))
    pushed = plan[plan.index("PushedFilters"):].split("]")[0]
    for f in ("GreaterThanOrEqual(Speed,0.0)", "LessThanOrEqual(Speed,400.0)", "LessThanOrEqual(RPM,20000.0)",
              "GreaterThanOrEqual(Throttle,0.0)", "IsNotNull(driver)"):
        assert f in pushed, pushed
    wanted = spark.createDataFrame([(2024, 1, "R")], "year int, round int, session_type string")
    pruned = _plan(bronze.scan_bronze(spark, tmpdir_fresh, "tel", wanted))
    assert "PartitionFilters: [" in pruned and "Join" not in pruned and "Exchange" not in pruned


def test_lap_filters_reach_the_bronze_scan(spark, tmpdir_fresh):
    from paddock.operators import silver
    from paddock.plans import fixtures as fx
    from paddock.sources import bronze
    bronze.write_bronze(fx.laps_raw(spark, SF_SMALL), tmpdir_fresh, "laps")
    plan = _plan(silver.transform_laps(bronze.scan_bronze(spark, tmpdir_fresh, "laps")))
    pushed = plan[plan.index("PushedFilters"):].split("]")[0]
    for f in ("IsNotNull(LapTime)", "GreaterThan(LapTime,0.0)", "IsNotNull(Driver)", "EqualTo(IsAccurate,true)"):
        assert f in pushed, pushed


def test_silver_laps_scan_is_pruned(spark):
    plan = _plan(entry.queries()["silver_laps"](spark, SF_SMALL))
    # lineitem has 11 columns; the laps view needs 10 of them, never l_shipdate.
    assert "l_shipdate" not in plan


def test_top5_is_take_ordered(spark):
    plan = _plan(entry.queries()["top5_drivers"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan
