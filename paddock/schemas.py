"""Declared table schemas, keys and bronze column vocabularies.

Silver and gold tables have a fixed schema; bronze files are inferred and
conformed to these on the way in.  Parquet has no constraints, so the
primary keys below are checked by the operators in ``operators.refresh``.
"""

from __future__ import annotations

from pyspark.sql import types as T

I, L, D, S, B = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
TS = T.TimestampNTZType()


def _struct(fields, not_null=()):
    return T.StructType([T.StructField(n, t, n not in not_null) for n, t in fields])


# --- fixed values: target tables, names and types as declared by the reference DDL ---
SILVER_LAPS_KEY = ["year", "round", "session_type", "driver", "lap_number"]
SILVER_LAPS = _struct([
    ("year", I), ("round", I), ("session_type", S), ("grand_prix", S), ("driver", S),
    ("driver_number", S), ("team", S), ("lap_number", D), ("lap_time_s", D), ("sector1_s", D),
    ("sector2_s", D), ("sector3_s", D), ("speed_i1", D), ("speed_i2", D), ("speed_fl", D),
    ("speed_st", D), ("tyre_compound", S), ("tyre_life_laps", D), ("fresh_tyre", B),
    ("is_accurate", B), ("track_status", S), ("position", D), ("stint", D),
], not_null=SILVER_LAPS_KEY)

SILVER_CAR_DATA_KEY = ["year", "round", "session_type", "driver", "recorded_at"]
SILVER_CAR_DATA = _struct([
    ("year", I), ("round", I), ("session_type", S), ("grand_prix", S), ("driver", S),
    ("recorded_at", TS), ("speed_kmh", D), ("rpm", D), ("throttle_pct", D), ("brake_on", B),
    ("drs_active", I), ("gear", I),
], not_null=SILVER_CAR_DATA_KEY)

SILVER_WEATHER_KEY = ["year", "round", "session_type", "session_time"]
SILVER_WEATHER = _struct([
    ("year", I), ("round", I), ("session_type", S), ("grand_prix", S), ("session_time", D),
    ("air_temp_c", D), ("track_temp_c", D), ("humidity_pct", D), ("wind_speed_ms", D),
    ("wind_direction_deg", I), ("pressure_hpa", D), ("is_raining", B),
], not_null=SILVER_WEATHER_KEY)

GOLD_DRIVER_KEY = ["year", "grand_prix", "session_type", "driver", "team"]
GOLD_DRIVER = _struct([
    ("year", I), ("grand_prix", S), ("session_type", S), ("driver", S), ("team", S),
    ("total_laps", L), ("avg_lap_time_s", D), ("best_lap_time_s", D), ("avg_sector1_s", D),
    ("avg_sector2_s", D), ("avg_sector3_s", D), ("avg_speed_trap_kmh", D),
    ("max_speed_trap_kmh", D), ("soft_laps", L), ("medium_laps", L), ("hard_laps", L),
    ("rank_in_race", I),
], not_null=GOLD_DRIVER_KEY)

GOLD_TEAM_KEY = ["year", "session_type", "team"]
GOLD_TEAM = _struct([
    ("year", I), ("session_type", S), ("team", S), ("avg_lap_time_s", D), ("best_lap_time_s", D),
    ("total_laps", L), ("drivers_count", L), ("avg_speed_trap_kmh", D), ("team_rank_in_season", I),
], not_null=GOLD_TEAM_KEY)

# Slice = one session; silver tables are replaced one slice at a time.
SLICE_KEY = ["year", "round", "session_type"]
SESSION_TYPES = ["R", "Q"]
KINDS = ["laps", "tel", "weather"]

# --- fixed values: bronze kind -> file prefix, and bronze header renames ---
BRONZE_PREFIX = {"bronze_laps": "laps", "bronze_car_data": "tel", "bronze_weather": "weather"}
LABEL_RENAMES = {"Year": "year", "Round": "round", "SessionType": "session_type", "GrandPrix": "grand_prix"}
CAR_DATA_RENAMES = {"Driver": "driver"}

# --- fixed values: bronze columns each silver transform asks for ---
LAPS_REQUIRED = [
    "year", "round", "grand_prix", "Driver", "DriverNumber",
    "Team", "LapNumber", "LapTime", "Sector1Time", "Sector2Time", "Sector3Time",
    "SpeedI1", "SpeedI2", "SpeedFL", "SpeedST", "Compound", "TyreLife",
    "FreshTyre", "IsAccurate", "TrackStatus", "Stint",
]
CAR_DATA_REQUIRED = [
    "year", "round", "grand_prix", "driver", "Date",
    "Speed", "RPM", "Throttle", "Brake", "DRS", "nGear",
]
WEATHER_REQUIRED = [
    "year", "round", "grand_prix", "Time", "AirTemp",
    "TrackTemp", "Humidity", "WindSpeed", "WindDirection", "Pressure", "Rainfall",
]

# Types bronze columns are conformed to before the silver filters run, so a
# column that is missing (typed NULL) or arrives in another physical type
# behaves like the declared one.
BRONZE_TYPES = {
    "year": I, "round": I, "session_type": S, "grand_prix": S,
    # laps
    "Driver": S, "DriverNumber": S, "Team": S, "LapNumber": D, "LapTime": D,
    "Sector1Time": D, "Sector2Time": D, "Sector3Time": D, "SpeedI1": D, "SpeedI2": D,
    "SpeedFL": D, "SpeedST": D, "Compound": S, "TyreLife": D, "FreshTyre": B,
    "IsAccurate": B, "TrackStatus": S, "Stint": D, "Position": D,
    # car data
    "driver": S, "Date": TS, "Speed": D, "RPM": D, "Throttle": D, "Brake": B, "DRS": I,
    "nGear": I,
    # weather
    "Time": D, "AirTemp": D, "TrackTemp": D, "Humidity": D, "WindSpeed": D,
    "WindDirection": I, "Pressure": D, "Rainfall": B,
}

# Bronze column naming the raw columns of a row whose value did not fit the declared type (NULL: all did).
CAST_FAILED = "cast_failed"


def bronze_schema(kind: str) -> T.StructType:
    """Declared columns of a kind's bronze files; a column that a file lacks reads as NULL."""
    columns = {"laps": [*LAPS_REQUIRED, "Position"], "tel": CAR_DATA_REQUIRED, "weather": WEATHER_REQUIRED}[kind]
    labels = [c for c in columns if c in SLICE_KEY]
    rest = [c for c in columns if c not in SLICE_KEY]
    return T.StructType([*[T.StructField(c, BRONZE_TYPES[c]) for c in rest], T.StructField(CAST_FAILED, S),
                         *[T.StructField(c, BRONZE_TYPES[c]) for c in [*labels, "session_type"]]])


# Bronze columns holding durations (seconds once conformed).
DURATION_COLUMNS = {"LapTime", "Sector1Time", "Sector2Time", "Sector3Time", "Time"}

TARGETS = {
    "silver_laps": (SILVER_LAPS, SILVER_LAPS_KEY),
    "silver_car_data": (SILVER_CAR_DATA, SILVER_CAR_DATA_KEY),
    "silver_weather": (SILVER_WEATHER, SILVER_WEATHER_KEY),
    "gold_driver_performance": (GOLD_DRIVER, GOLD_DRIVER_KEY),
    "gold_team_season_stats": (GOLD_TEAM, GOLD_TEAM_KEY),
}


def schema_of(table: str) -> T.StructType:
    return TARGETS[table][0]


def key_of(table: str) -> list[str]:
    return TARGETS[table][1]
