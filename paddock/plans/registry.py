"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the given tables through the fixture views and runs one
operator (or the whole silver/gold chain) on all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock import schemas
from paddock.functions import scalars
from paddock.operators import analytics, conform, gold, quality, refresh, selection, silver
from paddock.plans import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


# ---- building blocks shared by many queries ----

def silver_laps_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.transform_laps(fx.laps_raw(spark, sf_dir))


def gold_driver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_driver_performance(silver_laps_of(spark, sf_dir))


def gold_team_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_team_season_stats(silver_laps_of(spark, sf_dir))


# ---- 2.2 projections / 2.5 aggregations / 2.6 windows: the minimum slice ----

@query("silver_laps")
def q_silver_laps(spark, sf_dir):
    return silver_laps_of(spark, sf_dir)


@query("gold_driver_performance")
def q_gold_driver(spark, sf_dir):
    return gold_driver_of(spark, sf_dir)


@query("gold_team_season_stats")
def q_gold_team(spark, sf_dir):
    return gold_team_of(spark, sf_dir)


# ---- query parameters (fixed so that Spark and the oracle agree) ----
EVENT = (1997, "GP_2", "R")             # T1
TREND_YEAR = 1997                       # T2
TOP_EVENT = ("GP_2", "R")               # T3
REFRESH_SLICE = (1997, 2, "R")          # R1
UPSERT_YEAR = 1999                      # R2: target <= year, stage >= year
SEASONS = [1995, 1996, 1998, 1999, 2000]  # F10 (1997 not listed)
RESUME_YEAR = 1996                      # F10
ROUNDS, SESSION_FILTER = [1, 2], ["R"]  # F11
DRIVER = "D3"                           # F14


def conformed_laps(spark, sf_dir):
    return conform.conform_bronze_types(fx.laps_raw(spark, sf_dir))


def accepted_laps(spark, sf_dir, key):
    return gold.split_null_keys(silver_laps_of(spark, sf_dir), key)[0]


# ---- 2.2 projections, schema and type operators ----

@query("bronze_rename")
def q_bronze_rename(spark, sf_dir):
    raw = fx.car_raw(spark, sf_dir).withColumnsRenamed(
        {"year": "Year", "round": "Round", "session_type": "SessionType", "grand_prix": "GrandPrix",
         "driver": "Driver"})
    return conform.rename_bronze_columns(raw, "bronze_car_data")


@query("require_columns")
def q_require_columns(spark, sf_dir):
    return conform.require_columns(fx.laps_raw(spark, sf_dir), schemas.LAPS_REQUIRED)


@query("column_or_null")
def q_column_or_null(spark, sf_dir):
    df = fx.laps_raw(spark, sf_dir)
    return df.select("Driver", "LapNumber", conform.column_or_null(df, "Team").alias("team"),
                     conform.column_or_null(df, "Position").alias("position"))


@query("silver_car_data")
def q_silver_car_data(spark, sf_dir):
    return silver.transform_car_data(fx.car_raw(spark, sf_dir))


@query("silver_weather")
def q_silver_weather(spark, sf_dir):
    return silver.transform_weather(fx.weather_raw(spark, sf_dir))


@query("align_to_target")
def q_align_to_target(spark, sf_dir):
    df = fx.laps_raw(spark, sf_dir).withColumnsRenamed({"Driver": "driver", "Team": "team"})
    return conform.align_to_target(df, "silver_laps")


@query("drop_all_null_columns")
def q_drop_all_null_columns(spark, sf_dir):
    return conform.drop_all_null_columns(conform.require_columns(fx.laps_raw(spark, sf_dir), schemas.LAPS_REQUIRED))


@query("duration_to_seconds")
def q_duration_to_seconds(spark, sf_dir):
    df = fx.laps_raw(spark, sf_dir).select(
        "LapNumber",
        F.make_dt_interval(secs=F.col("LapTime").cast("decimal(18,6)")).alias("as_interval"),
        F.round(F.col("LapTime") * 1e9).cast("long").alias("as_nanos"),
    )
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select("LapNumber",
                     scalars.duration_to_seconds("as_interval", types["as_interval"]).alias("from_interval"),
                     scalars.duration_to_seconds("as_nanos", types["as_nanos"]).alias("from_nanos"))


@query("timestamp_to_utc_us")
def q_timestamp_to_utc_us(spark, sf_dir):
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, F.col("Date"))
    df = fx.car_raw(spark, sf_dir).select(
        "Date",
        F.timestamp_micros(micros).alias("as_instant"),
        (micros * 1000 + 999).alias("as_nanos"),
    )
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select("Date",
                     scalars.timestamp_to_utc_us("as_instant", types["as_instant"]).alias("from_instant"),
                     scalars.timestamp_to_utc_us("as_nanos", types["as_nanos"]).alias("from_nanos"))


@query("conform_schema")
def q_conform_schema(spark, sf_dir):
    loose = silver_laps_of(spark, sf_dir).select(
        "*", F.col("year").cast("long").alias("y"), F.col("lap_number").cast("string").alias("ln"),
        F.col("is_accurate").cast("string").alias("acc")).drop("year", "lap_number", "is_accurate") \
        .withColumnsRenamed({"y": "year", "ln": "lap_number", "acc": "is_accurate"})
    return conform.conform_schema(loose, schemas.SILVER_LAPS)


@query("evolve_schema")
def q_evolve_schema(spark, sf_dir):
    old = silver_laps_of(spark, sf_dir).drop("session_type")
    return conform.evolve_schema(old, schemas.SILVER_LAPS)


# ---- 2.3 filters ----

def _laps_filter(pred):
    return lambda spark, sf_dir: conformed_laps(spark, sf_dir).filter(pred())


QUERIES["filter_lap_time_not_null"] = _laps_filter(silver.lap_time_not_null)
QUERIES["filter_lap_time_positive"] = _laps_filter(silver.lap_time_positive)
NO_DRIVER = "7"                          # F3: laps of this driver number come without a driver


@query("filter_driver_not_null")
def q_filter_driver_not_null(spark, sf_dir):
    nameless = F.when(F.col("DriverNumber") != NO_DRIVER, F.col("Driver"))
    return conformed_laps(spark, sf_dir).withColumn("Driver", nameless).filter(silver.driver_not_null())


QUERIES["filter_accurate"] = _laps_filter(silver.is_accurate)


def _raw_filter(view, pred):
    return lambda spark, sf_dir: conform.conform_bronze_types(view(spark, sf_dir)).filter(pred())


QUERIES["filter_speed_range"] = _raw_filter(fx.car_raw, silver.speed_in_range)
QUERIES["filter_rpm_range"] = _raw_filter(fx.car_raw, silver.rpm_in_range)
QUERIES["filter_throttle_range"] = _raw_filter(fx.car_raw, silver.throttle_in_range)
QUERIES["filter_air_temp_range"] = _raw_filter(fx.weather_raw, silver.air_temp_in_range)
QUERIES["filter_humidity_range"] = _raw_filter(fx.weather_raw, silver.humidity_in_range)


@query("select_seasons")
def q_select_seasons(spark, sf_dir):
    return selection.select_seasons(fx.schedule(spark, sf_dir), SEASONS, RESUME_YEAR)


@query("select_rounds_sessions")
def q_select_rounds_sessions(spark, sf_dir):
    return selection.select_rounds_sessions(silver_laps_of(spark, sf_dir), ROUNDS, SESSION_FILTER)


@query("events_until")
def q_events_until(spark, sf_dir):
    return selection.events_until(fx.schedule(spark, sf_dir), fx.AS_OF)


@query("driver_laps")
def q_driver_laps(spark, sf_dir):
    return selection.driver_laps(silver_laps_of(spark, sf_dir), DRIVER)


# ---- 2.4 joins and session sets ----

def upsert_inputs(spark, sf_dir, grain: str):
    """Target = gold of years <= UPSERT_YEAR; stage = gold of years >= UPSERT_YEAR
    recomputed from even lap numbers without one driver (or team)."""
    laps = silver_laps_of(spark, sf_dir)
    even = laps.filter(F.col("lap_number").cast("long") % 2 == 0)
    if grain == "driver":
        target = gold.gold_driver_performance(laps).filter(F.col("year") <= UPSERT_YEAR)
        stage = gold.gold_driver_performance(even.filter(F.col("driver") != "D0"))
    else:
        target = gold.gold_team_season_stats(laps).filter(F.col("year") <= UPSERT_YEAR)
        stage = gold.gold_team_season_stats(even.filter(F.col("team") != "T0"))
    return target, stage.filter(F.col("year") >= UPSERT_YEAR)


@query("anti_join_keys")
def q_anti_join_keys(spark, sf_dir):
    target, stage = upsert_inputs(spark, sf_dir, "driver")
    return refresh.anti_join_keys(target, stage, schemas.GOLD_DRIVER_KEY)


def wanted_sessions(spark, sf_dir):
    return selection.expand_session_types(
        selection.events_until(fx.schedule(spark, sf_dir), fx.AS_OF).select("year", "round"))


@query("sessions_to_ingest")
def q_sessions_to_ingest(spark, sf_dir):
    return selection.sessions_to_ingest(wanted_sessions(spark, sf_dir), fx.checkpoint_files(spark, sf_dir))


@query("selected_sessions_semi")
def q_selected_sessions_semi(spark, sf_dir):
    discovered = selection.distinct_sessions(fx.checkpoint_files(spark, sf_dir))
    return selection.selected_sessions(discovered, wanted_sessions(spark, sf_dir))


@query("missing_sessions")
def q_missing_sessions(spark, sf_dir):
    requested = wanted_sessions(spark, sf_dir).select(
        "*", F.explode(F.array(*[F.lit(k) for k in schemas.KINDS])).alias("kind"))
    return selection.missing_files(requested, fx.checkpoint_files(spark, sf_dir))


# ---- 2.5 aggregations ----

@query("agg_distinct_laps")
def q_agg_distinct_laps(spark, sf_dir):
    key = schemas.GOLD_TEAM_KEY
    states = gold.lap_states(accepted_laps(spark, sf_dir, key), key)
    return gold.laps_of(states, key).select(*key, "total_laps")


@query("agg_distinct_drivers")
def q_agg_distinct_drivers(spark, sf_dir):
    return (accepted_laps(spark, sf_dir, schemas.GOLD_TEAM_KEY).groupBy(*schemas.GOLD_TEAM_KEY)
            .agg(F.count_distinct("driver").alias("drivers_count")))


def _driver_agg(cols):
    def run(spark, sf_dir):
        return accepted_laps(spark, sf_dir, schemas.GOLD_DRIVER_KEY).groupBy(*schemas.GOLD_DRIVER_KEY).agg(*cols())
    return run


QUERIES["agg_avg_times"] = _driver_agg(lambda: [
    scalars.round_avg("lap_time_s", 3).alias("avg_lap_time_s"),
    scalars.round_avg("sector1_s", 3).alias("avg_sector1_s"),
    scalars.round_avg("sector2_s", 3).alias("avg_sector2_s"),
    scalars.round_avg("sector3_s", 3).alias("avg_sector3_s")])
QUERIES["agg_avg_speed"] = _driver_agg(lambda: [scalars.round_avg("speed_st", 1).alias("avg_speed_trap_kmh")])
QUERIES["agg_best_lap"] = _driver_agg(lambda: [scalars.round_min("lap_time_s", 3).alias("best_lap_time_s")])
QUERIES["agg_max_speed"] = _driver_agg(lambda: [scalars.round_max("speed_st", 1).alias("max_speed_trap_kmh")])
QUERIES["agg_compound_laps"] = _driver_agg(lambda: [
    scalars.count_equal("tyre_compound", v).alias(n) for n, v in gold.COMPOUNDS.items()])


@query("slice_row_counts")
def q_slice_row_counts(spark, sf_dir):
    return refresh.slice_row_counts(silver_laps_of(spark, sf_dir))


@query("lap_time_distribution")
def q_lap_time_distribution(spark, sf_dir):
    return analytics.lap_time_distribution(silver_laps_of(spark, sf_dir))


# ---- 2.6 windows ----

@query("rank_in_race")
def q_rank_in_race(spark, sf_dir):
    return gold_driver_of(spark, sf_dir).select(*schemas.GOLD_DRIVER_KEY, "best_lap_time_s", "rank_in_race")


@query("team_rank_in_season")
def q_team_rank_in_season(spark, sf_dir):
    return gold_team_of(spark, sf_dir).select(*schemas.GOLD_TEAM_KEY, "avg_lap_time_s", "team_rank_in_season")


# ---- 2.7 sorts, limits, top-k ----

@query("driver_performance_one_event")
def q_driver_performance_one_event(spark, sf_dir):
    return analytics.driver_performance_one_event(gold_driver_of(spark, sf_dir), *EVENT)


@query("team_season_trends")
def q_team_season_trends(spark, sf_dir):
    return analytics.team_season_trends(gold_team_of(spark, sf_dir), TREND_YEAR)


@query("top5_drivers")
def q_top5_drivers(spark, sf_dir):
    return analytics.top_drivers(gold_driver_of(spark, sf_dir), *TOP_EVENT, k=5)


@query("silver_row_count")
def q_silver_row_count(spark, sf_dir):
    return analytics.row_count(silver_laps_of(spark, sf_dir))


# ---- 2.8 set operations ----

@query("union_session_frames")
def q_union_session_frames(spark, sf_dir):
    car = fx.car_raw(spark, sf_dir)
    from paddock.sources import bronze
    first = car.filter(F.substring("driver", 2, 2).cast("int") < 10)
    rest = car.filter(F.substring("driver", 2, 2).cast("int") >= 10).drop("Brake")
    return bronze.union_frames([first, rest])


@query("distinct_sessions")
def q_distinct_sessions(spark, sf_dir):
    return selection.distinct_sessions(fx.checkpoint_files(spark, sf_dir))


# ---- 2.9 scalar functions ----

@query("scalar_round")
def q_scalar_round(spark, sf_dir):
    return silver_laps_of(spark, sf_dir).select(
        *schemas.SILVER_LAPS_KEY,
        scalars.round_half_up("lap_time_s", 3).alias("lap_time_3"),
        scalars.round_half_up("sector1_s", 1).alias("sector1_1"),
        scalars.round_half_up("speed_st", 1).alias("speed_st_1"))


@query("parse_checkpoint_name")
def q_parse_checkpoint_name(spark, sf_dir):
    files = fx.checkpoint_files(spark, sf_dir)
    return files.select("file_name",
                        scalars.checkpoint_kind("file_name").alias("kind"),
                        scalars.checkpoint_year("file_name").alias("year"),
                        scalars.checkpoint_round("file_name").alias("round"),
                        scalars.checkpoint_session_raw("file_name").alias("session_suffix"))


@query("checkpoint_tag")
def q_checkpoint_tag(spark, sf_dir):
    return selection.distinct_sessions(fx.checkpoint_files(spark, sf_dir)).select(
        *schemas.SLICE_KEY, scalars.checkpoint_tag("year", "round", "session_type").alias("tag"))


# ---- 2.10 refresh ----

@query("refresh_session_slice")
def q_refresh_session_slice(spark, sf_dir):
    target = silver_laps_of(spark, sf_dir)
    y, r, s = REFRESH_SLICE
    stage = target.filter((F.col("year") == y) & (F.col("round") == r) & (F.col("session_type") == s)) \
        .withColumn("lap_time_s", F.col("lap_time_s") + 1)
    return refresh.replace_slices(target, stage, [REFRESH_SLICE])


@query("refresh_empty_slice")
def q_refresh_empty_slice(spark, sf_dir):
    target = silver_laps_of(spark, sf_dir)
    empty_stage = spark.createDataFrame([], schemas.SILVER_LAPS)
    return refresh.replace_slices(target, empty_stage, [REFRESH_SLICE])


@query("upsert_gold_driver")
def q_upsert_gold_driver(spark, sf_dir):
    target, stage = upsert_inputs(spark, sf_dir, "driver")
    return refresh.upsert_by_key(target, stage, schemas.GOLD_DRIVER_KEY)


@query("upsert_gold_team")
def q_upsert_gold_team(spark, sf_dir):
    target, stage = upsert_inputs(spark, sf_dir, "team")
    return refresh.upsert_by_key(target, stage, schemas.GOLD_TEAM_KEY)


@query("pk_violations")
def q_pk_violations(spark, sf_dir):
    return refresh.pk_violations(silver_laps_of(spark, sf_dir), schemas.SILVER_LAPS_KEY)


@query("dedup_laps")
def q_dedup_laps(spark, sf_dir):
    return refresh.dedup_by_key(silver_laps_of(spark, sf_dir), schemas.SILVER_LAPS_KEY)


@query("not_null_violations")
def q_not_null_violations(spark, sf_dir):
    return refresh.not_null_violations(silver_laps_of(spark, sf_dir), schemas.GOLD_DRIVER_KEY)


# ---- 2.11 data quality ----

@query("dq_completeness")
def q_dq_completeness(spark, sf_dir):
    return quality.completeness(gold_driver_of(spark, sf_dir))


@query("dq_session_validity")
def q_dq_session_validity(spark, sf_dir):
    return quality.session_validity(gold_driver_of(spark, sf_dir))


@query("dq_lap_consistency")
def q_dq_lap_consistency(spark, sf_dir):
    return quality.lap_consistency(silver_laps_of(spark, sf_dir))


@query("dq_report")
def q_dq_report(spark, sf_dir):
    laps = silver_laps_of(spark, sf_dir)
    return quality.quality_report(gold.gold_driver_performance(laps), laps)


@query("contract_view")
def q_contract_view(spark, sf_dir):
    return quality.contract_view(gold_driver_of(spark, sf_dir))


# ---- 2.1 sources and sinks: real files below the shared checkpoint folder ----

def bronze_layout(spark, sf_dir, kinds=("laps",)):
    """Write the fixture views as bronze session files (S7) in a fresh folder."""
    from paddock.plans.medallion import Layout
    from paddock.session import scratch_path
    from paddock.sources import bronze
    from paddock.plans.medallion import concurrently
    layout = Layout(scratch_path(spark, "bronze-run"))
    views = {"laps": fx.laps_raw, "tel": fx.car_raw, "weather": fx.weather_raw}
    concurrently({kind: (lambda kind=kind: bronze.write_bronze(views[kind](spark, sf_dir), layout.bronze, kind))
                  for kind in kinds})
    return layout


@query("bronze_write_roundtrip")
def q_bronze_write_roundtrip(spark, sf_dir):
    from paddock.sources import bronze
    layout = bronze_layout(spark, sf_dir)
    return bronze.scan_bronze(spark, layout.bronze, "laps").select(*fx.laps_raw(spark, sf_dir).columns)


@query("bronze_scan")
def q_bronze_scan(spark, sf_dir):
    from paddock.sources import bronze
    layout = bronze_layout(spark, sf_dir)
    wanted = selection.expand_session_types(fx.schedule(spark, sf_dir).select("year", "round"))
    return bronze.scan_bronze(spark, layout.bronze, "laps", sessions=wanted).select(
        *fx.laps_raw(spark, sf_dir).columns)


MIXED_POSITION_ROUND = 1    # sessions of this round have a Position column, and BIGINT speeds


def mixed_bronze(spark, sf_dir):
    """Bronze laps written by two writers whose columns and physical types differ."""
    from paddock.plans.medallion import Layout
    from paddock.session import scratch_path
    from paddock.sources import bronze
    layout = Layout(scratch_path(spark, "bronze-mixed"))
    laps = fx.laps_raw(spark, sf_dir)
    with_position = (laps.where(F.col("round") == MIXED_POSITION_ROUND)
                     .withColumn("Position", (F.col("LapNumber") % 20).cast("bigint"))
                     .withColumn("SpeedST", F.floor("SpeedST").cast("bigint")))
    bronze.write_bronze(laps.where(F.col("round") != MIXED_POSITION_ROUND), layout.bronze, "laps")
    bronze.write_bronze(with_position, layout.bronze, "laps")
    return layout


@query("bronze_scan_mixed")
def q_bronze_scan_mixed(spark, sf_dir):
    from paddock.sources import bronze
    scan = bronze.scan_bronze(spark, mixed_bronze(spark, sf_dir).bronze, "laps")
    return scan.groupBy("year", "round", "session_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("Position").alias("with_position"),
        F.max("Position").alias("max_position"), scalars.round_max("SpeedST", 1).alias("max_speed"))


@query("bronze_scan_many_sessions")
def q_bronze_scan_many_sessions(spark, sf_dir):
    """Every session of the view among thousands that have no files."""
    from paddock.sources import bronze
    layout = bronze_layout(spark, sf_dir)
    wanted = [(y, r, s) for y in range(1800, 2100) for r in range(1, 13) for s in schemas.SESSION_TYPES]
    return bronze.scan_bronze(spark, layout.bronze, "laps", sessions=wanted).select(
        *fx.laps_raw(spark, sf_dir).columns)


@query("silver_rejects")
def q_silver_rejects(spark, sf_dir):
    """R4 end to end: what a silver run leaves out for its key, read back with the reasons."""
    from paddock.plans import medallion
    layout = bronze_layout(spark, sf_dir)
    medallion.run_silver(spark, layout)
    stored = layout.rejects("silver_laps").read(spark)
    return stored.groupBy("year", "round", "session_type", "reason").agg(F.count(F.lit(1)).alias("row_count"))


@query("discover_sessions")
def q_discover_sessions(spark, sf_dir):
    from paddock.sources import bronze
    layout = bronze_layout(spark, sf_dir)
    return bronze.discover_partition_sessions(spark, layout.bronze, "laps")


def _names_as_listing(files):
    return files.select(F.concat(F.lit("file:/archive/"), F.col("file_name")).alias("path"))


@query("legacy_session_default")
def q_legacy_session_default(spark, sf_dir):
    """Archive listing where 1995 races exist under both names; the suffixed file wins."""
    from paddock.sources import bronze
    files = fx.checkpoint_files(spark, sf_dir)
    both = files.filter((F.col("year") == fx.LEGACY_YEAR) & (F.col("session_type") == "R")).select(
        scalars.checkpoint_file_name("kind", "year", "round", "session_type").alias("file_name"))
    listing = _names_as_listing(files).unionByName(_names_as_listing(both))
    parsed = bronze.parse_checkpoint_listing(listing)
    return bronze.prefer_suffixed(parsed)


@query("session_labels")
def q_session_labels(spark, sf_dir):
    from paddock.sources import bronze
    return bronze.session_labels(fx.checkpoint_files(spark, sf_dir), fx.schedule(spark, sf_dir))


@query("silver_table_scan")
def q_silver_table_scan(spark, sf_dir):
    from paddock.plans.medallion import Layout
    from paddock.session import scratch_path
    table = Layout(scratch_path(spark, "silver-scan")).silver("silver_laps")
    table.refresh(spark, silver_laps_of(spark, sf_dir), check_key=False)
    return table.read(spark)


@query("silver_all")
def q_silver_all(spark, sf_dir):
    """Bronze of all three kinds -> the three silver tables, deduplicated on their keys;
    the result is the written row count of every slice."""
    from paddock.plans import medallion
    layout = bronze_layout(spark, sf_dir, kinds=("laps", "tel", "weather"))
    medallion.run_silver(spark, layout)
    return medallion.silver_slice_counts(spark, layout)


# ---- incremental refresh (Structured Streaming over bronze files) ----

def _incremental_layout(spark, sf_dir):
    from paddock.streaming.incremental import run_incremental
    layout = bronze_layout(spark, sf_dir, kinds=("laps",))
    run_incremental(spark, layout, tables=("silver_laps",), with_gold=True)
    return layout


@query("incremental_silver_laps")
def q_incremental_silver_laps(spark, sf_dir):
    """Bronze laps files -> streamed refresh -> the silver table (deduplicated on its key)."""
    return _incremental_layout(spark, sf_dir).silver("silver_laps").read(spark)


@query("incremental_gold_driver")
def q_incremental_gold_driver(spark, sf_dir):
    """The versioned gold driver table after the streamed refresh (R2 with real writes)."""
    return _incremental_layout(spark, sf_dir).gold("gold_driver_performance").read(spark)


# ---- S5: archives in the original file format (nanosecond types) ----

RAW_HEADERS = {"year": "Year", "round": "Round", "session_type": "SessionType", "grand_prix": "GrandPrix"}


def _archive_roundtrip(spark, raw, kind, durations=()):
    from paddock.session import scratch_path
    from paddock.sources import bronze
    root = scratch_path(spark, "archive")
    raw = raw.withColumnsRenamed(RAW_HEADERS)
    bronze.write_checkpoint_archive(raw, root, kind, labels=("Year", "Round", "SessionType"),
                                    durations=durations).write.format("noop").mode("overwrite").save()
    listing = bronze.parse_checkpoint_listing(bronze.list_files(spark, root, recursive=True))
    entries = [r.entry for r in listing.select("entry").distinct().collect()]   # one per session
    accepted, _ = bronze.label_from_file(bronze.read_checkpoint_files(spark, entries))
    return accepted


@query("archive_legacy_read")
def q_archive_legacy_read(spark, sf_dir):
    """S4 over real files: races of one season under legacy names, the first round of them under a suffixed
    name as well (which wins; its legacy twin lacks every other lap), all else suffixed."""
    from paddock.plans import medallion
    from paddock.session import scratch_path
    from paddock.sources import bronze
    root = scratch_path(spark, "archive-legacy")
    laps = fx.laps_raw(spark, sf_dir).where(F.col("session_type").isin(*schemas.SESSION_TYPES))
    old = (F.col("year") == fx.LEGACY_YEAR) & (F.col("session_type") == schemas.SESSION_TYPES[0])
    twin = old & (F.col("round") == 1)
    for rows, legacy in ((laps.where(~old | twin), False), (laps.where(old & (~twin | (F.col("LapNumber") % 2 == 0))), True)):
        bronze.write_checkpoint_archive(rows.withColumnsRenamed(RAW_HEADERS), root, "laps", labels=("Year", "Round", "SessionType"),
                                        legacy=legacy).write.format("noop").mode("overwrite").save()
    layout = medallion.Layout(scratch_path(spark, "archive-lake"))
    medallion.import_archive(spark, root, layout)
    return bronze.scan_bronze(spark, layout.bronze, "laps").groupBy(*schemas.SLICE_KEY).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("LapTime").alias("timed"), scalars.round_max("LapTime", 3).alias("slowest"))


@query("bronze_nanos_read")
def q_bronze_nanos_read(spark, sf_dir):
    """Telemetry archived with TIMESTAMP(NANOS) -> read, conformed to microseconds -> silver."""
    car = fx.car_raw(spark, sf_dir).withColumnRenamed("driver", "Driver")
    return silver.transform_car_data(_archive_roundtrip(spark, car, "tel"))


@query("bronze_duration_read")
def q_bronze_duration_read(spark, sf_dir):
    """Weather archived with BIGINT-nanosecond session times -> read as seconds -> silver."""
    return silver.transform_weather(_archive_roundtrip(spark, fx.weather_raw(spark, sf_dir), "weather",
                                                       durations=("Time",)))
