"""Bronze -> silver cleaning: range/NULL filters and typed projections.

Each transform is a narrow, shuffle-free chain (scan -> filter -> project) that
Catalyst fuses into one codegen stage; the filters on raw columns are pushed
into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock import schemas
from paddock.operators import conform

# --- fixed values: cleaning bounds (inclusive) ---
SPEED_RANGE = (0, 400)
RPM_RANGE = (0, 20000)
THROTTLE_RANGE = (0, 100)
AIR_TEMP_RANGE = (-10, 60)
HUMIDITY_RANGE = (0, 100)


# F1-F9 as predicates, so single-filter queries and the transforms share them.
def lap_time_not_null() -> Column:          # F1
    return F.col("LapTime").isNotNull()


def lap_time_positive() -> Column:          # F2: NaN > 0 is true in Spark, so exclude it
    return (F.col("LapTime") > 0) & ~F.isnan(F.col("LapTime"))


def driver_not_null(name: str = "Driver") -> Column:   # F3
    return F.col(name).isNotNull()


def is_accurate() -> Column:                # F4: NULL counts as false
    return F.col("IsAccurate") == F.lit(True)


def speed_in_range() -> Column:             # F5
    return F.col("Speed").between(*SPEED_RANGE)


def rpm_in_range() -> Column:               # F6
    return F.col("RPM").between(*RPM_RANGE)


def throttle_in_range() -> Column:          # F7
    return F.col("Throttle").between(*THROTTLE_RANGE)


def air_temp_in_range() -> Column:          # F8
    return F.col("AirTemp").between(*AIR_TEMP_RANGE)


def humidity_in_range() -> Column:          # F9
    return F.col("Humidity").between(*HUMIDITY_RANGE)


# --- fixed values: bronze column -> silver column, in silver order ---
LAPS_PROJECTION = [
    ("year", "year"), ("round", "round"), ("session_type", "session_type"), ("grand_prix", "grand_prix"),
    ("Driver", "driver"), ("DriverNumber", "driver_number"), ("Team", "team"), ("LapNumber", "lap_number"),
    ("LapTime", "lap_time_s"), ("Sector1Time", "sector1_s"), ("Sector2Time", "sector2_s"),
    ("Sector3Time", "sector3_s"), ("SpeedI1", "speed_i1"), ("SpeedI2", "speed_i2"), ("SpeedFL", "speed_fl"),
    ("SpeedST", "speed_st"), ("Compound", "tyre_compound"), ("TyreLife", "tyre_life_laps"),
    ("FreshTyre", "fresh_tyre"), ("IsAccurate", "is_accurate"), ("TrackStatus", "track_status"),
    ("Position", "position"), ("Stint", "stint"),
]
CAR_DATA_PROJECTION = [
    ("year", "year"), ("round", "round"), ("session_type", "session_type"), ("grand_prix", "grand_prix"),
    ("driver", "driver"), ("Date", "recorded_at"), ("Speed", "speed_kmh"), ("RPM", "rpm"),
    ("Throttle", "throttle_pct"), ("Brake", "brake_on"), ("DRS", "drs_active"), ("nGear", "gear"),
]
WEATHER_PROJECTION = [
    ("year", "year"), ("round", "round"), ("session_type", "session_type"), ("grand_prix", "grand_prix"),
    ("Time", "session_time"), ("AirTemp", "air_temp_c"), ("TrackTemp", "track_temp_c"),
    ("Humidity", "humidity_pct"), ("WindSpeed", "wind_speed_ms"), ("WindDirection", "wind_direction_deg"),
    ("Pressure", "pressure_hpa"), ("Rainfall", "is_raining"),
]


def _project(pairs, session_type: str | None, position: str | None = None) -> list[str]:
    """SQL select list for a projection.  The session type is the slice column
    the source derived from the path (the original took it from the file
    name), or an explicit literal."""
    out = []
    for src, dst in pairs:
        if dst == "session_type" and session_type:
            if not session_type.isalnum():
                raise ValueError(f"bad session type {session_type!r}")
            out.append(f"'{session_type}' AS session_type")
        elif dst == "position" and position is not None:
            out.append(f"{position} AS position")
        else:
            out.append(f"`{src}` AS `{dst}`")
    return out


def _prepare(bronze: DataFrame, bronze_table: str, required: list[str]) -> DataFrame:
    df = conform.rename_bronze_columns(bronze, bronze_table)
    df = conform.require_columns(df, required + ["session_type"])
    failed = conform.cast_failures(df)
    known = conform.has_column(df, schemas.CAST_FAILED)
    return conform.conform_bronze_types(df.withColumn(schemas.CAST_FAILED, F.coalesce(schemas.CAST_FAILED, failed) if known else failed))


def _cleaned(df: DataFrame, fits: Column, projection: list[str], schema: T.StructType, with_failed: bool) -> DataFrame:
    """Rows that ``fits`` lets through, in the table's columns; ``with_failed`` lets rows with a failed cast through as
    well and keeps the column that names it."""
    if with_failed:
        fits = fits | F.col(schemas.CAST_FAILED).isNotNull()
        projection = [*projection, f"`{schemas.CAST_FAILED}`"]
        schema = T.StructType([*schema.fields, T.StructField(schemas.CAST_FAILED, T.StringType())])
    return conform.conform_schema(conform.nan_to_null_columns(df.filter(fits).selectExpr(*projection)), schema)


def transform_laps(bronze: DataFrame, session_type: str | None = None, with_failed: bool = False) -> DataFrame:
    """P5 + F1-F4: bronze laps -> ``silver_laps`` (23 columns, declared types)."""
    df = _prepare(bronze, "bronze_laps", schemas.LAPS_REQUIRED)
    position = None if conform.has_column(df, "Position") else "CAST(NULL AS double)"   # P3
    fits = lap_time_not_null() & lap_time_positive() & driver_not_null() & is_accurate()
    return _cleaned(df, fits, _project(LAPS_PROJECTION, session_type, position), schemas.SILVER_LAPS, with_failed)


def transform_car_data(bronze: DataFrame, session_type: str | None = None, with_failed: bool = False) -> DataFrame:
    """P6 + F3, F5-F7: bronze car data -> ``silver_car_data`` (12 columns)."""
    df = _prepare(bronze, "bronze_car_data", schemas.CAR_DATA_REQUIRED)
    fits = speed_in_range() & rpm_in_range() & throttle_in_range() & driver_not_null("driver")
    return _cleaned(df, fits, _project(CAR_DATA_PROJECTION, session_type), schemas.SILVER_CAR_DATA, with_failed)


def transform_weather(bronze: DataFrame, session_type: str | None = None, with_failed: bool = False) -> DataFrame:
    """P7 + F8, F9: bronze weather -> ``silver_weather`` (12 columns)."""
    df = _prepare(bronze, "bronze_weather", schemas.WEATHER_REQUIRED)
    return _cleaned(df, air_temp_in_range() & humidity_in_range(), _project(WEATHER_PROJECTION, session_type), schemas.SILVER_WEATHER, with_failed)


TRANSFORMS = {
    "silver_laps": ("bronze_laps", transform_laps),
    "silver_car_data": ("bronze_car_data", transform_car_data),
    "silver_weather": ("bronze_weather", transform_weather),
}
