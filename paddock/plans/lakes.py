"""Registered queries over whole lakes: several deliveries, epochs, rejects, the contract gate, stored versions.

Each writes bronze derived from the given tables below the shared folder, runs the engine on it and reads what the
engine has published.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock import schemas
from paddock.operators import silver
from paddock.plans import fixtures as fx
from paddock.plans import medallion
from paddock.plans.registry import bronze_layout, query
from paddock.session import scratch_path
from paddock.sources import bronze, ledger
from paddock.sources.tables import SliceTable

# ---- query parameters (fixed so that Spark and the oracle agree) ----
SHARED_EVENT = ("GP_34", 3)             # rounds from this one on carry one event name
EMPTIED, CHANGED, CHANGED_BY = (1996, 4, "R"), (1997, 2, "R"), 5.0
JUNK_EVERY = 97                          # every so many lap numbers, the trap speed is no number
NEW_SEASON, GONE_SEASON = 1998, 1996
OLD_YEARS = 1995                         # sessions up to this season were written by an older schema


def _laps_of_shared_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, first = SHARED_EVENT
    return fx.laps_raw(spark, sf_dir).withColumn(
        "grand_prix", F.when(F.col("round") >= first, F.lit(name)).otherwise(F.col("grand_prix")))


def _in(session: tuple):
    return (F.col("year") == session[0]) & (F.col("round") == session[1]) & (F.col("session_type") == session[2])


def two_deliveries(spark: SparkSession, sf_dir: str) -> medallion.Layout:
    """A lake kept incrementally: all sessions, then one again without an accurate lap and one with other lap times."""
    from paddock.streaming.incremental import run_incremental

    layout = medallion.Layout(scratch_path(spark, "two-deliveries"))
    laps = _laps_of_shared_events(spark, sf_dir)
    bronze.write_bronze(laps, layout.bronze, "laps")
    run_incremental(spark, layout, tables=("silver_laps",))
    again = laps.where(_in(EMPTIED) | _in(CHANGED)).withColumns({
        "IsAccurate": F.col("IsAccurate") & ~_in(EMPTIED), "LapTime": F.when(_in(CHANGED), F.col("LapTime") + CHANGED_BY)})
    bronze.write_bronze(again, layout.bronze, "laps")
    run_incremental(spark, layout, tables=("silver_laps",))
    return layout


@query("incremental_equals_full")
def q_incremental_equals_full(spark, sf_dir):
    """Gold drivers after an emptied and a changed session, one of an event of two rounds: those of a full run."""
    return two_deliveries(spark, sf_dir).read(spark, "gold_driver_performance")


@query("incremental_equals_full_team")
def q_incremental_equals_full_team(spark, sf_dir):
    return two_deliveries(spark, sf_dir).read(spark, "gold_team_season_stats")


@query("silver_all_values")
def q_silver_all_values(spark, sf_dir):
    """R5 by value: the three silver tables of one epoch, key and measures of every row."""
    layout = bronze_layout(spark, sf_dir, kinds=("laps", "tel", "weather"))
    medallion.run_silver(spark, layout)
    medallion.publish_epoch(spark, layout)
    epoch_columns = {
        "silver_laps": ("driver", "lap_number", "lap_time_s", "speed_st"),
        "silver_car_data": ("driver", F.unix_micros(F.col("recorded_at").cast("timestamp")).cast("double"), "speed_kmh", "rpm"),
        "silver_weather": (F.lit(None).cast("string"), "session_time", "air_temp_c", "humidity_pct")}
    out = None
    for table, (driver, at, one, two) in epoch_columns.items():
        named = [c if not isinstance(c, str) else F.col(c) for c in (driver, at, one, two)]
        rows = layout.read(spark, table).select(
            F.lit(table).alias("table_name"), *schemas.SLICE_KEY, named[0].alias("driver"), named[1].alias("at"),
            named[2].alias("value_1"), named[3].alias("value_2"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("silver_rejects_cast")
def q_silver_rejects_cast(spark, sf_dir):
    """Laps whose trap speed is text, and every so often no number; rows per session and reason, accepted ones too."""
    layout = medallion.Layout(scratch_path(spark, "bronze-text"))
    laps = fx.laps_raw(spark, sf_dir)
    speed = F.when(F.col("LapNumber") % JUNK_EVERY == 0, F.lit("n/a")).otherwise(F.col("SpeedST").cast("string"))
    bronze.write_bronze(laps.withColumn("SpeedST", speed), layout.bronze, "laps")
    medallion.run_silver(spark, layout)
    kept = layout.silver("silver_laps").read(spark).select(*schemas.SLICE_KEY, F.lit("accepted").alias("reason"), "speed_st")
    left = layout.rejects("silver_laps").read(spark).select(*schemas.SLICE_KEY, "reason", "speed_st")
    return kept.unionByName(left).groupBy(*schemas.SLICE_KEY, "reason").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("speed_st").alias("with_speed"))


@query("slice_counts_of_write")
def q_slice_counts_of_write(spark, sf_dir):
    """A10 from a stored write: rows per session as the write counted them."""
    schema, key = schemas.TARGETS["silver_laps"]
    table = SliceTable(scratch_path(spark, "slice-counts"), schema, key)
    report = table.refresh(spark, silver.transform_laps(fx.laps_raw(spark, sf_dir)), check_key=False)
    return spark.createDataFrame(report["slice_rows"], "year int, round int, session_type string, row_count long")


@query("dq_gate")
def q_dq_gate(spark, sf_dir):
    """Write, audit, publish: a delivery that meets the contract becomes an epoch; the next, which doesn't, leaves it as it is."""
    low, high = 60, 200
    layout = medallion.Layout(scratch_path(spark, "gate"))
    laps = fx.laps_raw(spark, sf_dir)
    good = laps.where((F.col("LapTime") > low) & (F.col("LapTime") < high) & F.col("session_type").isin(*schemas.SESSION_TYPES))
    rows = []
    for delivery, bronze_rows in enumerate((good, laps), 1):
        bronze.write_bronze(bronze_rows, layout.bronze, "laps")
        medallion.run_silver(spark, layout)
        medallion.run_gold(spark, layout, mode="rebuild")
        report = medallion.publish_epoch(spark, layout, gate=True)
        visible = sum(n for _, n in layout.silver("silver_laps").slice_map(spark, layout.epoch(spark)["silver_laps"]).values())
        rows += [(delivery, m["metric"], m["value_pct"], m["rows_checked"], m["passed"], report["published"], visible)
                 for m in report["quality"]]
    return spark.createDataFrame(rows, "delivery int, metric string, value_pct double, rows_checked long, passed boolean, "
                                       "published boolean, visible_laps long")


@query("evolve_stored_table")
def q_evolve_stored_table(spark, sf_dir):
    """P14 over stored files: some sessions written before a column was added and while lap numbers were whole, others since."""
    schema, key = schemas.TARGETS["silver_laps"]
    rows = silver.transform_laps(fx.laps_raw(spark, sf_dir))
    before = T.StructType([T.StructField(f.name, T.LongType() if f.name == "lap_number" else f.dataType)
                           for f in schema.fields if f.name != "tyre_compound"])
    root = scratch_path(spark, "evolve")
    SliceTable(root, before, key).refresh(spark, rows.where(F.col("year") <= OLD_YEARS), check_key=False)
    table = SliceTable(root, schema, key)
    table.refresh(spark, rows.where(F.col("year") > OLD_YEARS), check_key=False)
    return table.read(spark)


@query("sessions_changed")
def q_sessions_changed(spark, sf_dir):
    """A listing against the ledger of an earlier one; lap counts stand for lengths.  Later, races have more bytes, one season
    is gone and another is new."""
    laps = fx.laps_raw(spark, sf_dir).groupBy(*schemas.SLICE_KEY).agg(F.count(F.lit(1)).alias("length"))
    files = fx.checkpoint_files(spark, sf_dir).join(laps, schemas.SLICE_KEY)
    files = files.withColumn("modified", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp"))
    first = ledger.entries(files.where(F.col("year") != NEW_SEASON))
    grown = F.col("length") + F.when((F.col("session_type") == "R") & (F.col("round") == 1), F.lit(1)).otherwise(F.lit(0))
    second = ledger.entries(files.where(F.col("year") != GONE_SEASON).withColumn("length", grown))
    book = ledger.IngestLedger(scratch_path(spark, "ledger"))
    book.record(spark, first)
    return book.compare(spark, second)
