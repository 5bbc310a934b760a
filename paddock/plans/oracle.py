"""Independent DuckDB SQL for every registered query (the correctness oracle).

The fixture views are inlined as CTEs over the raw tables, written from the
definitions in FIXTURES.md §3 rather than from the Spark code.  Result column
names and types are aliased/cast to match the Spark side exactly.
"""

from __future__ import annotations


def AVG(x: str, n: int) -> str:
    """Exact decimal average rounded half-up, as DOUBLE."""
    return f"CAST(round(CAST(sum(CAST({x} AS DECIMAL(18,6))) / count({x}) AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def MIN(x: str, n: int) -> str:
    return f"CAST(round(CAST(min({x}) AS DECIMAL(18,6)), {n}) AS DOUBLE)"


def MAX(x: str, n: int) -> str:
    return f"CAST(round(CAST(max({x}) AS DECIMAL(18,6)), {n}) AS DOUBLE)"


def PCT(cond: str) -> str:
    """100 * share of rows meeting ``cond``, half-up to 3 decimals, in exact integer arithmetic."""
    a, b = f"count_if({cond})", "count(*)"
    return f"(CAST((200000 * {a} + {b}) // (2 * {b}) AS DOUBLE) / 1000)"


CTE = {}

CTE["laps_raw"] = """laps_raw AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(quarter(o.o_orderdate) AS INTEGER) AS round,
         CASE o.o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'Q' WHEN 'P' THEN 'S' END AS session_type,
         concat('GP_', CAST(quarter(o.o_orderdate) AS INTEGER)) AS grand_prix,
         concat('D', l.l_suppkey % 20) AS Driver,
         CAST(l.l_suppkey % 20 AS VARCHAR) AS DriverNumber,
         CASE WHEN l.l_discount = 0.10 THEN NULL
              ELSE concat('T', CAST(floor((l.l_suppkey % 20) / 2) AS INTEGER)) END AS Team,
         CAST(l.l_orderkey AS DOUBLE) AS LapNumber,
         CASE WHEN l.l_tax = 0.08 THEN NULL WHEN l.l_tax = 0.07 THEN -l.l_extendedprice / 1000
              ELSE l.l_extendedprice / 1000 END AS LapTime,
         CASE WHEN l.l_quantity = 50 THEN NULL ELSE l.l_quantity + l.l_discount END AS Sector1Time,
         p.p_retailprice / 3 AS SpeedST,
         CASE WHEN l.l_returnflag = 'R' THEN 'SOFT' WHEN l.l_returnflag = 'A' THEN 'MEDIUM'
              WHEN l.l_returnflag = 'N' AND l.l_linenumber <> 7 THEN 'HARD' END AS Compound,
         l.l_linestatus = 'F' AS IsAccurate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
)"""

SILVER_LAPS_SELECT = """year, round, session_type, grand_prix, Driver AS driver, DriverNumber AS driver_number,
         Team AS team, LapNumber AS lap_number, LapTime AS lap_time_s, Sector1Time AS sector1_s,
         CAST(NULL AS DOUBLE) AS sector2_s, CAST(NULL AS DOUBLE) AS sector3_s,
         CAST(NULL AS DOUBLE) AS speed_i1, CAST(NULL AS DOUBLE) AS speed_i2, CAST(NULL AS DOUBLE) AS speed_fl,
         SpeedST AS speed_st, Compound AS tyre_compound, CAST(NULL AS DOUBLE) AS tyre_life_laps,
         CAST(NULL AS BOOLEAN) AS fresh_tyre, IsAccurate AS is_accurate, CAST(NULL AS VARCHAR) AS track_status,
         CAST(NULL AS DOUBLE) AS position, CAST(NULL AS DOUBLE) AS stint"""

LAPS_CLEAN = "LapTime IS NOT NULL AND LapTime > 0 AND Driver IS NOT NULL AND IsAccurate"

CTE["silver_laps"] = f"""silver_laps AS (
  SELECT {SILVER_LAPS_SELECT}
  FROM laps_raw WHERE {LAPS_CLEAN}
)"""

DRIVER_KEY = "year, grand_prix, session_type, driver, team"
DRIVER_KEY_NOT_NULL = " AND ".join(f"{k} IS NOT NULL" for k in DRIVER_KEY.split(", "))
TEAM_KEY = "year, session_type, team"
TEAM_KEY_NOT_NULL = " AND ".join(f"{k} IS NOT NULL" for k in TEAM_KEY.split(", "))


def driver_agg(src: str) -> str:
    return f"""SELECT {DRIVER_KEY},
      count(DISTINCT lap_number) AS total_laps,
      {AVG('lap_time_s', 3)} AS avg_lap_time_s,
      {MIN('lap_time_s', 3)} AS best_lap_time_s,
      {AVG('sector1_s', 3)} AS avg_sector1_s,
      {AVG('sector2_s', 3)} AS avg_sector2_s,
      {AVG('sector3_s', 3)} AS avg_sector3_s,
      {AVG('speed_st', 1)} AS avg_speed_trap_kmh,
      {MAX('speed_st', 1)} AS max_speed_trap_kmh,
      count(CASE WHEN tyre_compound = 'SOFT' THEN 1 END) AS soft_laps,
      count(CASE WHEN tyre_compound = 'MEDIUM' THEN 1 END) AS medium_laps,
      count(CASE WHEN tyre_compound = 'HARD' THEN 1 END) AS hard_laps
    FROM {src} WHERE {DRIVER_KEY_NOT_NULL}
    GROUP BY {DRIVER_KEY}"""


def team_agg(src: str) -> str:
    return f"""SELECT {TEAM_KEY},
      {AVG('lap_time_s', 3)} AS avg_lap_time_s,
      {MIN('lap_time_s', 3)} AS best_lap_time_s,
      count(DISTINCT lap_number) AS total_laps,
      count(DISTINCT driver) AS drivers_count,
      {AVG('speed_st', 1)} AS avg_speed_trap_kmh
    FROM {src} WHERE {TEAM_KEY_NOT_NULL}
    GROUP BY {TEAM_KEY}"""


RANK_IN_RACE = ("CAST(rank() OVER (PARTITION BY year, grand_prix, session_type "
                "ORDER BY best_lap_time_s ASC NULLS FIRST) AS INTEGER) AS rank_in_race")
TEAM_RANK = ("CAST(rank() OVER (PARTITION BY year, session_type "
             "ORDER BY avg_lap_time_s ASC NULLS FIRST) AS INTEGER) AS team_rank_in_season")

CTE["gold_driver"] = f"""gold_driver AS (
  SELECT *, {RANK_IN_RACE} FROM ({driver_agg('silver_laps')}) a
)"""

CTE["gold_team"] = f"""gold_team AS (
  SELECT *, {TEAM_RANK} FROM ({team_agg('silver_laps')}) a
)"""

CTE_DEPS = {
    "laps_raw": [],
    "silver_laps": ["laps_raw"],
    "gold_driver": ["silver_laps"],
    "gold_team": ["silver_laps"],
}


def with_ctes(names: list[str], body: str) -> str:
    """``WITH`` the named CTEs (and their dependencies, in order) followed by ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in CTE_DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(CTE[n] for n in order) + "\n" + body


ORACLE: dict[str, str] = {}

ORACLE["silver_laps"] = with_ctes(["silver_laps"], "SELECT * FROM silver_laps")
ORACLE["gold_driver_performance"] = with_ctes(["gold_driver"], "SELECT * FROM gold_driver")
ORACLE["gold_team_season_stats"] = with_ctes(["gold_team"], "SELECT * FROM gold_team")

# ---- more fixture views ----

EVENT_LABELS = """CAST(year(ts) AS INTEGER) AS year, CAST(day(ts) AS INTEGER) AS round, 'R' AS session_type,
         concat('GP_', CAST(day(ts) AS INTEGER)) AS grand_prix"""
JSON_K = "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)"

CTE["car_raw"] = f"""car_raw AS (
  SELECT {EVENT_LABELS},
         concat('D', user_id % 20) AS driver, ts AS Date,
         CASE WHEN event_type = 'signup' AND value < 5 THEN NULL ELSE value END AS Speed,
         value * 50 AS RPM, {JSON_K} * 1.05 AS Throttle, event_type = 'click' AS Brake
  FROM events
)"""

CTE["weather_raw"] = f"""weather_raw AS (
  SELECT {EVENT_LABELS},
         CAST(event_id AS DOUBLE) AS Time, value / 4 - 15 AS AirTemp, {JSON_K} * 1.02 AS Humidity,
         event_type = 'error' AS Rainfall
  FROM events
)"""

CTE["silver_car"] = """silver_car AS (
  SELECT year, round, session_type, grand_prix, driver, Date AS recorded_at, Speed AS speed_kmh, RPM AS rpm,
         Throttle AS throttle_pct, Brake AS brake_on, CAST(NULL AS INTEGER) AS drs_active, CAST(NULL AS INTEGER) AS gear
  FROM car_raw
  WHERE Speed BETWEEN 0 AND 400 AND RPM BETWEEN 0 AND 20000 AND Throttle BETWEEN 0 AND 100 AND driver IS NOT NULL
)"""

CTE["silver_weather"] = """silver_weather AS (
  SELECT year, round, session_type, grand_prix, Time AS session_time, AirTemp AS air_temp_c,
         CAST(NULL AS DOUBLE) AS track_temp_c, Humidity AS humidity_pct, CAST(NULL AS DOUBLE) AS wind_speed_ms,
         CAST(NULL AS INTEGER) AS wind_direction_deg, CAST(NULL AS DOUBLE) AS pressure_hpa, Rainfall AS is_raining
  FROM weather_raw
  WHERE AirTemp BETWEEN -10 AND 60 AND Humidity BETWEEN 0 AND 100
)"""

CTE["schedule"] = """schedule AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS round,
         concat('GP_', CAST(quarter(o_orderdate) AS INTEGER)) AS grand_prix, max(o_orderdate) AS event_date
  FROM orders GROUP BY 1, 2, 3
)"""

CTE["sessions"] = """sessions AS (
  SELECT DISTINCT year, round, session_type FROM laps_raw WHERE session_type IN ('R', 'Q')
)"""

CTE["checkpoint_files"] = """checkpoint_files AS (
  SELECT CASE WHEN s.year = 1995 AND s.session_type = 'R'
              THEN k.kind || '_checkpoint_' || s.year || '_r' || s.round || '.parquet'
              ELSE k.kind || '_checkpoint_' || s.year || '_r' || s.round || '_' || s.session_type || '.parquet'
         END AS file_name,
         k.kind, s.year, s.round, s.session_type
  FROM sessions s CROSS JOIN (VALUES ('laps'), ('tel'), ('weather')) k(kind)
  WHERE NOT (k.kind = 'tel' AND s.round = 4) AND NOT (k.kind = 'weather' AND s.year = 1997)
)"""

CTE["wanted"] = """wanted AS (
  SELECT year, round, t.session_type
  FROM schedule CROSS JOIN (VALUES ('R'), ('Q')) t(session_type)
  WHERE CAST(event_date AS DATE) <= DATE '1999-06-30'
)"""

CTE["laps_even_d"] = """laps_even_d AS (
  SELECT * FROM silver_laps WHERE CAST(lap_number AS BIGINT) % 2 = 0 AND driver <> 'D0'
)"""
CTE["laps_even_t"] = """laps_even_t AS (
  SELECT * FROM silver_laps WHERE CAST(lap_number AS BIGINT) % 2 = 0 AND team <> 'T0'
)"""
CTE["target_d"] = "target_d AS (SELECT * FROM gold_driver WHERE year <= 1999)"
CTE["stage_d"] = f"""stage_d AS (
  SELECT * FROM (SELECT *, {RANK_IN_RACE} FROM ({driver_agg('laps_even_d')}) a) b WHERE year >= 1999
)"""
CTE["target_t"] = "target_t AS (SELECT * FROM gold_team WHERE year <= 1999)"
CTE["stage_t"] = f"""stage_t AS (
  SELECT * FROM (SELECT *, {TEAM_RANK} FROM ({team_agg('laps_even_t')}) a) b WHERE year >= 1999
)"""

CTE_DEPS.update({
    "car_raw": [], "weather_raw": [], "schedule": [],
    "silver_car": ["car_raw"], "silver_weather": ["weather_raw"],
    "sessions": ["laps_raw"], "checkpoint_files": ["sessions"], "wanted": ["schedule"],
    "laps_even_d": ["silver_laps"], "laps_even_t": ["silver_laps"],
    "target_d": ["gold_driver"], "stage_d": ["laps_even_d"],
    "target_t": ["gold_team"], "stage_t": ["laps_even_t"],
})


def keys_match(a: str, b: str, key: str) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in key.split(", "))


SLICE = "year = 1997 AND round = 2 AND session_type = 'R'"
NAME_RE = r"^(laps|tel|weather)_checkpoint_(\d+)_r(\d+)(?:_([RQ]))?\.parquet$"
SILVER_KEY = "year, round, session_type, driver, lap_number"
SILVER_OTHERS = ("grand_prix, driver_number, team, lap_time_s, sector1_s, sector2_s, sector3_s, speed_i1, speed_i2, "
                 "speed_fl, speed_st, tyre_compound, tyre_life_laps, fresh_tyre, is_accurate, track_status, "
                 "position, stint")

# 2.2 projections, schema and type operators
ORACLE["bronze_rename"] = with_ctes(["car_raw"], "SELECT * FROM car_raw")
ORACLE["require_columns"] = with_ctes(["laps_raw"], """SELECT *, CAST(NULL AS DOUBLE) AS Sector2Time,
  CAST(NULL AS DOUBLE) AS Sector3Time, CAST(NULL AS DOUBLE) AS SpeedI1, CAST(NULL AS DOUBLE) AS SpeedI2,
  CAST(NULL AS DOUBLE) AS SpeedFL, CAST(NULL AS DOUBLE) AS TyreLife, CAST(NULL AS BOOLEAN) AS FreshTyre,
  CAST(NULL AS VARCHAR) AS TrackStatus, CAST(NULL AS DOUBLE) AS Stint FROM laps_raw""")
ORACLE["column_or_null"] = with_ctes(["laps_raw"],
                                     "SELECT Driver, LapNumber, Team AS team, CAST(NULL AS DOUBLE) AS position FROM laps_raw")
ORACLE["silver_car_data"] = with_ctes(["silver_car"], "SELECT * FROM silver_car")
ORACLE["silver_weather"] = with_ctes(["silver_weather"], "SELECT * FROM silver_weather")
ORACLE["align_to_target"] = with_ctes(["laps_raw"], """SELECT year, round, session_type, grand_prix,
  Driver AS driver, Team AS team FROM laps_raw""")
ORACLE["drop_all_null_columns"] = with_ctes(["laps_raw"], "SELECT * FROM laps_raw")
ORACLE["duration_to_seconds"] = with_ctes(["laps_raw"], """SELECT LapNumber,
  CAST(CAST(LapTime AS DECIMAL(18,6)) AS DOUBLE) AS from_interval,
  CAST(CAST(round(LapTime * 1e9) AS BIGINT) AS DOUBLE) / 1e9 AS from_nanos FROM laps_raw""")
ORACLE["timestamp_to_utc_us"] = with_ctes(["car_raw"],
                                          "SELECT Date, Date AS from_instant, Date AS from_nanos FROM car_raw")
ORACLE["conform_schema"] = with_ctes(["silver_laps"], "SELECT * FROM silver_laps")
ORACLE["evolve_schema"] = with_ctes(["silver_laps"],
                                    "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS session_type) FROM silver_laps")

# 2.3 filters
ORACLE["filter_lap_time_not_null"] = with_ctes(["laps_raw"], "SELECT * FROM laps_raw WHERE LapTime IS NOT NULL")
ORACLE["filter_lap_time_positive"] = with_ctes(["laps_raw"], "SELECT * FROM laps_raw WHERE LapTime > 0")
ORACLE["filter_driver_not_null"] = with_ctes(["laps_raw"], "SELECT * FROM laps_raw WHERE CASE WHEN DriverNumber <> '7' THEN Driver END IS NOT NULL")
ORACLE["filter_accurate"] = with_ctes(["laps_raw"], "SELECT * FROM laps_raw WHERE IsAccurate")
ORACLE["filter_speed_range"] = with_ctes(["car_raw"], "SELECT * FROM car_raw WHERE Speed BETWEEN 0 AND 400")
ORACLE["filter_rpm_range"] = with_ctes(["car_raw"], "SELECT * FROM car_raw WHERE RPM BETWEEN 0 AND 20000")
ORACLE["filter_throttle_range"] = with_ctes(["car_raw"], "SELECT * FROM car_raw WHERE Throttle BETWEEN 0 AND 100")
ORACLE["filter_air_temp_range"] = with_ctes(["weather_raw"],
                                            "SELECT * FROM weather_raw WHERE AirTemp BETWEEN -10 AND 60")
ORACLE["filter_humidity_range"] = with_ctes(["weather_raw"],
                                            "SELECT * FROM weather_raw WHERE Humidity BETWEEN 0 AND 100")
ORACLE["select_seasons"] = with_ctes(["schedule"], """SELECT * FROM schedule
  WHERE year IN (1995, 1996, 1998, 1999, 2000) AND year >= 1996""")
ORACLE["select_rounds_sessions"] = with_ctes(["silver_laps"], """SELECT * FROM silver_laps
  WHERE round IN (1, 2) AND session_type IN ('R')""")
ORACLE["events_until"] = with_ctes(["schedule"],
                                   "SELECT * FROM schedule WHERE CAST(event_date AS DATE) <= DATE '1999-06-30'")
ORACLE["driver_laps"] = with_ctes(["silver_laps"], "SELECT * FROM silver_laps WHERE driver = 'D3'")

# 2.4 joins and session sets
ORACLE["anti_join_keys"] = with_ctes(["target_d", "stage_d"], f"""SELECT * FROM target_d t
  WHERE NOT EXISTS (SELECT 1 FROM stage_d s WHERE {keys_match('s', 't', DRIVER_KEY)})""")
ORACLE["sessions_to_ingest"] = with_ctes(["wanted", "checkpoint_files"], f"""SELECT w.* FROM wanted w
  WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT year, round, session_type FROM checkpoint_files GROUP BY ALL
                   HAVING count(DISTINCT kind) = 3) c
    WHERE {keys_match('c', 'w', 'year, round, session_type')})""")
ORACLE["selected_sessions_semi"] = with_ctes(["wanted", "checkpoint_files"], f"""SELECT DISTINCT
  d.year, d.round, d.session_type FROM checkpoint_files d
  WHERE EXISTS (SELECT 1 FROM wanted w WHERE {keys_match('w', 'd', 'year, round, session_type')})""")
ORACLE["missing_sessions"] = with_ctes(["wanted", "checkpoint_files"], f"""SELECT k.kind, w.year, w.round,
  w.session_type FROM wanted w CROSS JOIN (VALUES ('laps'), ('tel'), ('weather')) k(kind)
  WHERE NOT EXISTS (SELECT 1 FROM checkpoint_files f
                    WHERE f.kind = k.kind AND {keys_match('f', 'w', 'year, round, session_type')})""")

# 2.5 aggregations
ORACLE["agg_distinct_laps"] = with_ctes(["silver_laps"], f"""SELECT {TEAM_KEY},
  count(DISTINCT lap_number) AS total_laps FROM silver_laps WHERE {TEAM_KEY_NOT_NULL} GROUP BY {TEAM_KEY}""")
ORACLE["agg_distinct_drivers"] = with_ctes(["silver_laps"], f"""SELECT {TEAM_KEY},
  count(DISTINCT driver) AS drivers_count FROM silver_laps WHERE {TEAM_KEY_NOT_NULL} GROUP BY {TEAM_KEY}""")


def _driver_grain(cols: str) -> str:
    return with_ctes(["silver_laps"], f"""SELECT {DRIVER_KEY}, {cols} FROM silver_laps
  WHERE {DRIVER_KEY_NOT_NULL} GROUP BY {DRIVER_KEY}""")


ORACLE["agg_avg_times"] = _driver_grain(
    f"{AVG('lap_time_s', 3)} AS avg_lap_time_s, {AVG('sector1_s', 3)} AS avg_sector1_s, "
    f"{AVG('sector2_s', 3)} AS avg_sector2_s, {AVG('sector3_s', 3)} AS avg_sector3_s")
ORACLE["agg_avg_speed"] = _driver_grain(f"{AVG('speed_st', 1)} AS avg_speed_trap_kmh")
ORACLE["agg_best_lap"] = _driver_grain(f"{MIN('lap_time_s', 3)} AS best_lap_time_s")
ORACLE["agg_max_speed"] = _driver_grain(f"{MAX('speed_st', 1)} AS max_speed_trap_kmh")
ORACLE["agg_compound_laps"] = _driver_grain(
    "count(CASE WHEN tyre_compound = 'SOFT' THEN 1 END) AS soft_laps, "
    "count(CASE WHEN tyre_compound = 'MEDIUM' THEN 1 END) AS medium_laps, "
    "count(CASE WHEN tyre_compound = 'HARD' THEN 1 END) AS hard_laps")
ORACLE["slice_row_counts"] = with_ctes(["silver_laps"], """SELECT year, round, session_type,
  count(*) AS row_count FROM silver_laps GROUP BY year, round, session_type""")
ORACLE["lap_time_distribution"] = with_ctes(["silver_laps"], f"""SELECT year, round, session_type,
  {AVG('lap_time_s', 6)} AS avg_lap_time, {MIN('lap_time_s', 6)} AS fastest, {MAX('lap_time_s', 6)} AS slowest
  FROM silver_laps GROUP BY year, round, session_type""")

# 2.6 windows
ORACLE["rank_in_race"] = with_ctes(["gold_driver"],
                                   f"SELECT {DRIVER_KEY}, best_lap_time_s, rank_in_race FROM gold_driver")
ORACLE["team_rank_in_season"] = with_ctes(["gold_team"],
                                          f"SELECT {TEAM_KEY}, avg_lap_time_s, team_rank_in_season FROM gold_team")

# 2.7 sorts, limits, top-k
ORACLE["driver_performance_one_event"] = with_ctes(["gold_driver"], """SELECT driver, team, avg_lap_time_s,
  best_lap_time_s, rank_in_race FROM gold_driver
  WHERE year = 1997 AND grand_prix = 'GP_2' AND session_type = 'R'
  ORDER BY rank_in_race ASC NULLS FIRST, driver, team""")
ORACLE["team_season_trends"] = with_ctes(["gold_team"], """SELECT session_type, team, avg_lap_time_s,
  best_lap_time_s, drivers_count, team_rank_in_season FROM gold_team WHERE year = 1997
  ORDER BY session_type, avg_lap_time_s ASC NULLS FIRST, team""")
ORACLE["top5_drivers"] = with_ctes(["gold_driver"], """SELECT driver, avg_lap_time_s FROM gold_driver
  WHERE grand_prix = 'GP_2' AND session_type = 'R'
  ORDER BY rank_in_race ASC NULLS FIRST, year, driver, team LIMIT 5""")
ORACLE["silver_row_count"] = with_ctes(["silver_laps"], "SELECT count(*) AS record_count FROM silver_laps")

# 2.8 set operations
ORACLE["union_session_frames"] = with_ctes(["car_raw"], """SELECT * FROM car_raw
  WHERE CAST(substring(driver, 2, 2) AS INTEGER) < 10
  UNION ALL
  SELECT * REPLACE (CAST(NULL AS BOOLEAN) AS Brake) FROM car_raw
  WHERE CAST(substring(driver, 2, 2) AS INTEGER) >= 10""")
ORACLE["distinct_sessions"] = with_ctes(["checkpoint_files"],
                                        "SELECT DISTINCT year, round, session_type FROM checkpoint_files")

# 2.9 scalar functions
ORACLE["scalar_round"] = with_ctes(["silver_laps"], f"""SELECT {SILVER_KEY},
  CAST(round(CAST(lap_time_s AS DECIMAL(18,6)), 3) AS DOUBLE) AS lap_time_3,
  CAST(round(CAST(sector1_s AS DECIMAL(18,6)), 1) AS DOUBLE) AS sector1_1,
  CAST(round(CAST(speed_st AS DECIMAL(18,6)), 1) AS DOUBLE) AS speed_st_1 FROM silver_laps""")
ORACLE["parse_checkpoint_name"] = with_ctes(["checkpoint_files"], f"""SELECT file_name,
  regexp_extract(file_name, '{NAME_RE}', 1) AS kind,
  CAST(regexp_extract(file_name, '{NAME_RE}', 2) AS INTEGER) AS year,
  CAST(regexp_extract(file_name, '{NAME_RE}', 3) AS INTEGER) AS round,
  regexp_extract(file_name, '{NAME_RE}', 4) AS session_suffix FROM checkpoint_files""")
ORACLE["checkpoint_tag"] = with_ctes(["checkpoint_files"], """SELECT DISTINCT year, round, session_type,
  'checkpoint_' || year || '_r' || round || '_' || session_type AS tag FROM checkpoint_files""")

# 2.10 refresh
ORACLE["refresh_session_slice"] = with_ctes(["silver_laps"], f"""SELECT * FROM silver_laps WHERE NOT ({SLICE})
  UNION ALL
  SELECT * REPLACE (lap_time_s + 1 AS lap_time_s) FROM silver_laps WHERE {SLICE}""")
ORACLE["refresh_empty_slice"] = with_ctes(["silver_laps"], f"SELECT * FROM silver_laps WHERE NOT ({SLICE})")
ORACLE["upsert_gold_driver"] = with_ctes(["target_d", "stage_d"], f"""SELECT * FROM target_d t
  WHERE NOT EXISTS (SELECT 1 FROM stage_d s WHERE {keys_match('s', 't', DRIVER_KEY)})
  UNION ALL SELECT * FROM stage_d""")
ORACLE["upsert_gold_team"] = with_ctes(["target_t", "stage_t"], f"""SELECT * FROM target_t t
  WHERE NOT EXISTS (SELECT 1 FROM stage_t s WHERE {keys_match('s', 't', TEAM_KEY)})
  UNION ALL SELECT * FROM stage_t""")
ORACLE["pk_violations"] = with_ctes(["silver_laps"], f"""SELECT {SILVER_KEY}, count(*) AS duplicate_rows
  FROM silver_laps GROUP BY {SILVER_KEY} HAVING count(*) > 1""")
ORACLE["dedup_laps"] = with_ctes(["silver_laps"], f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {SILVER_KEY}
    ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in SILVER_OTHERS.split(', '))}) AS rn
  FROM silver_laps) d WHERE rn = 1""")
_KEY_NULL = " OR ".join(f"{k} IS NULL" for k in SILVER_KEY.split(", "))
ORACLE["silver_rejects"] = with_ctes(["silver_laps"], f"""
  SELECT year, round, session_type, 'null key' AS reason, count(*) AS row_count
  FROM silver_laps WHERE {_KEY_NULL} GROUP BY year, round, session_type
  UNION ALL
  SELECT year, round, session_type, 'duplicate key', CAST(sum(n - 1) AS BIGINT)
  FROM (SELECT {SILVER_KEY}, count(*) AS n FROM silver_laps WHERE NOT ({_KEY_NULL}) GROUP BY {SILVER_KEY}) k
  WHERE n > 1 GROUP BY year, round, session_type""")
ORACLE["not_null_violations"] = with_ctes(["silver_laps"], "\n  UNION ALL ".join(
    f"SELECT '{k}' AS column_name, CAST(count_if({k} IS NULL) AS BIGINT) AS null_rows FROM silver_laps"
    for k in DRIVER_KEY.split(", ")))

# 2.11 data quality


def _metric(name: str, cond: str, src: str, passed: str) -> str:
    return f"""SELECT '{name}' AS metric, v AS value_pct, n AS rows_checked, {passed} AS passed
  FROM (SELECT {PCT(cond)} AS v, count(*) AS n FROM {src}) m"""


ORACLE["dq_completeness"] = with_ctes(["gold_driver"], _metric(
    "completeness_avg_lap_time_s", "avg_lap_time_s IS NOT NULL", "gold_driver", "v > 99.0"))
ORACLE["dq_session_validity"] = with_ctes(["gold_driver"], _metric(
    "validity_session_type", "session_type IN ('Q', 'R')", "gold_driver", "v >= 100.0"))
ORACLE["dq_lap_consistency"] = with_ctes(["silver_laps"], _metric(
    "consistency_lap_time", "lap_time_s > 60 AND lap_time_s < 200", "silver_laps", "v > 98.0"))
ORACLE["dq_report"] = with_ctes(["gold_driver"], "\nUNION ALL\n".join([
    _metric("completeness_avg_lap_time_s", "avg_lap_time_s IS NOT NULL", "gold_driver", "v > 99.0"),
    _metric("validity_session_type", "session_type IN ('Q', 'R')", "gold_driver", "v >= 100.0"),
    _metric("consistency_lap_time", "lap_time_s > 60 AND lap_time_s < 200", "silver_laps", "v > 98.0")]))
ORACLE["contract_view"] = with_ctes(["gold_driver"], """SELECT year, grand_prix, session_type, driver, team,
  avg_lap_time_s, CAST(soft_laps AS INTEGER) AS soft_laps, rank_in_race FROM gold_driver""")

# 2.1 sources and sinks
ORACLE["bronze_write_roundtrip"] = with_ctes(["laps_raw"], "SELECT * FROM laps_raw")
ORACLE["bronze_scan"] = with_ctes(["laps_raw"], "SELECT * FROM laps_raw WHERE session_type IN ('R', 'Q')")
_SPEED = "CASE WHEN round = 1 THEN floor(SpeedST) ELSE SpeedST END"
ORACLE["bronze_scan_mixed"] = with_ctes(["laps_raw"], f"""SELECT year, round, session_type, count(*) AS row_count,
  count(CASE WHEN round = 1 THEN 1 END) AS with_position,
  max(CASE WHEN round = 1 THEN CAST(CAST(LapNumber AS BIGINT) % 20 AS DOUBLE) END) AS max_position,
  {MAX(_SPEED, 1)} AS max_speed
  FROM laps_raw GROUP BY year, round, session_type""")
ORACLE["bronze_scan_many_sessions"] = with_ctes(["laps_raw"], "SELECT * FROM laps_raw WHERE session_type IN ('R', 'Q')")
ORACLE["archive_legacy_read"] = with_ctes(["laps_raw"], f"""SELECT year, round, session_type, count(*) AS row_count,
  count(LapTime) AS timed, {MAX('LapTime', 3)} AS slowest
  FROM laps_raw WHERE session_type IN ('R', 'Q') GROUP BY year, round, session_type""")
ORACLE["discover_sessions"] = with_ctes(["laps_raw"], "SELECT DISTINCT year, round, session_type FROM laps_raw")
ORACLE["legacy_session_default"] = with_ctes(["checkpoint_files"], f"""SELECT kind, year, round, session_type,
  file_name, is_legacy FROM (
    SELECT *, row_number() OVER (PARTITION BY kind, year, round, session_type
                                 ORDER BY is_legacy, file_name) AS rn
    FROM (SELECT file_name, regexp_extract(file_name, '{NAME_RE}', 1) AS kind,
                 CAST(regexp_extract(file_name, '{NAME_RE}', 2) AS INTEGER) AS year,
                 CAST(regexp_extract(file_name, '{NAME_RE}', 3) AS INTEGER) AS round,
                 coalesce(nullif(regexp_extract(file_name, '{NAME_RE}', 4), ''), 'R') AS session_type,
                 regexp_extract(file_name, '{NAME_RE}', 4) = '' AS is_legacy
          FROM (SELECT file_name FROM checkpoint_files
                UNION ALL
                SELECT kind || '_checkpoint_' || year || '_r' || round || '_R.parquet' FROM checkpoint_files
                WHERE year = 1995 AND session_type = 'R') f) p) r
  WHERE rn = 1""")
ORACLE["session_labels"] = with_ctes(["checkpoint_files", "schedule"], """SELECT f.file_name, f.year AS Year,
  f.round AS Round, f.session_type AS SessionType, s.grand_prix AS GrandPrix
  FROM checkpoint_files f LEFT JOIN schedule s ON f.year = s.year AND f.round = s.round""")
ORACLE["silver_table_scan"] = with_ctes(["silver_laps"], "SELECT * FROM silver_laps")
ORACLE["silver_all"] = with_ctes(["silver_laps", "silver_car", "silver_weather"], """
  SELECT 'silver_laps' AS table_name, year, round, session_type, count(*) AS row_count
  FROM (SELECT DISTINCT year, round, session_type, driver, lap_number FROM silver_laps) a
  GROUP BY year, round, session_type
  UNION ALL
  SELECT 'silver_car_data', year, round, session_type, count(*)
  FROM (SELECT DISTINCT year, round, session_type, driver, recorded_at FROM silver_car) b
  GROUP BY year, round, session_type
  UNION ALL
  SELECT 'silver_weather', year, round, session_type, count(*)
  FROM (SELECT DISTINCT year, round, session_type, session_time FROM silver_weather) c
  GROUP BY year, round, session_type""")

# incremental refresh: silver deduplicated on its key (least row by the other columns)
CTE["silver_dedup"] = f"""silver_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {SILVER_KEY}
      ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in SILVER_OTHERS.split(', '))}) AS rn
    FROM silver_laps) d
  WHERE rn = 1
)"""
CTE["gold_driver_dedup"] = f"""gold_driver_dedup AS (
  SELECT *, {RANK_IN_RACE} FROM ({driver_agg('silver_dedup')}) a
)"""
CTE_DEPS.update({"silver_dedup": ["silver_laps"], "gold_driver_dedup": ["silver_dedup"]})
ORACLE["incremental_silver_laps"] = with_ctes(["silver_dedup"], "SELECT * FROM silver_dedup")
ORACLE["incremental_gold_driver"] = with_ctes(["gold_driver_dedup"], "SELECT * FROM gold_driver_dedup")
ORACLE["bronze_nanos_read"] = with_ctes(["silver_car"], "SELECT * FROM silver_car")
ORACLE["bronze_duration_read"] = with_ctes(["silver_weather"], "SELECT * FROM silver_weather")

# whole lakes (plans.lakes)


def dedup_of(src: str, key: str, others: str) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in others.split(", "))
    return f"""SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {src}) d WHERE rn = 1"""


CAR_KEY, CAR_OTHERS = "year, round, session_type, driver, recorded_at", "grand_prix, speed_kmh, rpm, throttle_pct, brake_on"
WEATHER_KEY, WEATHER_OTHERS = "year, round, session_type, session_time", "grand_prix, air_temp_c, humidity_pct, is_raining"
ORACLE["silver_all_values"] = with_ctes(["silver_dedup", "silver_car", "silver_weather"], f"""
  SELECT 'silver_laps' AS table_name, year, round, session_type, driver, lap_number AS at, lap_time_s AS value_1, speed_st AS value_2
  FROM silver_dedup
  UNION ALL
  SELECT 'silver_car_data', year, round, session_type, driver, CAST(epoch_us(recorded_at) AS DOUBLE), speed_kmh, rpm
  FROM ({dedup_of('silver_car', CAR_KEY, CAR_OTHERS)}) c
  UNION ALL
  SELECT 'silver_weather', year, round, session_type, NULL, session_time, air_temp_c, humidity_pct
  FROM ({dedup_of('silver_weather', WEATHER_KEY, WEATHER_OTHERS)}) w""")

# the second of two deliveries: one session emptied, one changed, rounds 3 and 4 under one event name
CTE["laps_twice"] = """laps_twice AS (
  SELECT * REPLACE (CASE WHEN round >= 3 THEN 'GP_34' ELSE grand_prix END AS grand_prix,
    CASE WHEN year = 1997 AND round = 2 AND session_type = 'R' THEN LapTime + 5.0 ELSE LapTime END AS LapTime,
    IsAccurate AND NOT coalesce(year = 1996 AND round = 4 AND session_type = 'R', false) AS IsAccurate)
  FROM laps_raw
)"""
CTE["silver_twice"] = f"""silver_twice AS (
  {dedup_of(f"(SELECT {SILVER_LAPS_SELECT} FROM laps_twice WHERE {LAPS_CLEAN})", SILVER_KEY, SILVER_OTHERS)}
)"""
CTE_DEPS.update({"laps_twice": ["laps_raw"], "silver_twice": ["laps_twice"]})
ORACLE["incremental_equals_full"] = with_ctes(["silver_twice"], f"SELECT *, {RANK_IN_RACE} FROM ({driver_agg('silver_twice')}) a")
ORACLE["incremental_equals_full_team"] = with_ctes(["silver_twice"], f"SELECT *, {TEAM_RANK} FROM ({team_agg('silver_twice')}) a")

_JUNK = "CAST(LapNumber AS BIGINT) % 97 = 0"
ORACLE["silver_rejects_cast"] = with_ctes(["laps_raw"], f"""
  , sound AS (SELECT {SILVER_LAPS_SELECT} FROM laps_raw WHERE {LAPS_CLEAN} AND NOT ({_JUNK})),
  keyed AS (SELECT * FROM sound WHERE NOT ({_KEY_NULL})),
  kept AS ({dedup_of('keyed', SILVER_KEY, SILVER_OTHERS)}),
  sizes AS (SELECT year, round, session_type, count(*) AS n, count(speed_st) AS s FROM keyed GROUP BY ALL),
  kept_sizes AS (SELECT year, round, session_type, count(*) AS n, count(speed_st) AS s FROM kept GROUP BY ALL)
  SELECT year, round, session_type, 'accepted' AS reason, n AS row_count, s AS with_speed FROM kept_sizes
  UNION ALL
  SELECT year, round, session_type, 'duplicate key', a.n - k.n, a.s - k.s
  FROM sizes a JOIN kept_sizes k USING (year, round, session_type) WHERE a.n > k.n
  UNION ALL
  SELECT year, round, session_type, 'null key', count(*), count(speed_st) FROM sound WHERE {_KEY_NULL} GROUP BY ALL
  UNION ALL
  SELECT year, round, session_type, 'failed cast: SpeedST', count(*), 0 FROM laps_raw WHERE {_JUNK} GROUP BY ALL""")
ORACLE["slice_counts_of_write"] = ORACLE["slice_row_counts"]


def _gate(delivery: int, laps: str, gold: str, published: str) -> str:
    metrics = [("completeness_avg_lap_time_s", "avg_lap_time_s IS NOT NULL", gold, "v > 99.0"),
               ("validity_session_type", "session_type IN ('Q', 'R')", gold, "v >= 100.0"),
               ("consistency_lap_time", "lap_time_s > 60 AND lap_time_s < 200", laps, "v > 98.0")]
    return "\n  UNION ALL\n  ".join(
        f"SELECT {delivery} AS delivery, *, {published} AS published, (SELECT count(*) FROM good) AS visible_laps "
        f"FROM ({_metric(*m)}) q{delivery}" for m in metrics)


ORACLE["dq_gate"] = with_ctes(["silver_dedup"], f""", good AS (
    SELECT * FROM ({dedup_of("(SELECT * FROM silver_laps WHERE lap_time_s > 60 AND lap_time_s < 200 AND session_type IN ('R', 'Q'))",
                             SILVER_KEY, SILVER_OTHERS)}) g),
  gold_good AS ({driver_agg('good')}), gold_all AS ({driver_agg('silver_dedup')})
  {_gate(1, "good", "gold_good", "true")}
  UNION ALL
  {_gate(2, "silver_dedup", "gold_all", "false")}""")

ORACLE["evolve_stored_table"] = with_ctes(["silver_laps"], """SELECT * REPLACE (CASE WHEN year > 1995 THEN tyre_compound END AS tyre_compound)
  FROM silver_laps""")
ORACLE["sessions_changed"] = with_ctes(["checkpoint_files"], """SELECT kind, year, round, session_type, file_name,
  CASE WHEN year = 1998 THEN 'new' WHEN year = 1996 THEN 'vanished'
       WHEN session_type = 'R' AND round = 1 THEN 'changed' ELSE 'unchanged' END AS status
  FROM checkpoint_files""")
