"""Session-shaped views derived from the driver's tables (FIXTURES.md §3).

These stand in for raw session files so that every operator can be checked
against an independent SQL oracle on the same inputs.  They are plain lazy
plans over the given Parquet tables: the work grows with the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock import schemas
from paddock.functions import scalars
from paddock.session import table_path

# --- fixed values: the derivation parameters of the fixture views ---
DRIVERS_MOD = 20
STATUS_TO_SESSION = {"F": "R", "O": "Q", "P": "S"}
RETURNFLAG_TO_COMPOUND = {"R": "SOFT", "A": "MEDIUM", "N": "HARD"}
NO_TEAM_DISCOUNT = 0.10
NULL_LAP_TAX = 0.08
NEGATIVE_LAP_TAX = 0.07
NULL_SECTOR_QUANTITY = 50
NULL_COMPOUND_LINE = 7
NO_TEL_ROUND = 4
NO_WEATHER_YEAR = 1997
LEGACY_YEAR = 1995
AS_OF = dt.date(1999, 6, 30)


# Declared schemas of the input tables this module reads: a known schema means
# no footer-inference job per query (at scale, footers of thousands of files).
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


# A caller whose tables are single files of one row group (which Spark reads in one task) may ask for more tasks behind every
# scan by this session setting.  Unset, a scan is a scan: tables of many files are read in parallel as they are.
INPUT_PARTITIONS = "paddock.input.partitions"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    df = reader.parquet(table_path(sf_dir, name))
    wanted = spark.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(wanted)) if wanted else df


def _case(column: str, mapping: dict) -> str:
    """``CASE column WHEN k THEN v ... END`` (NULL for anything else)."""
    return "CASE " + " ".join(f"WHEN {column} = '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def laps_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ part as bronze laps; columns not derived are absent."""
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    p = read_table(spark, sf_dir, "part")
    # Plain equi-joins: Catalyst/AQE pick broadcast only when a side's measured
    # size is under the threshold, otherwise a shuffle join.
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    rnd = "CAST(quarter(o_orderdate) AS INT)"
    drv = f"(l_suppkey % {DRIVERS_MOD})"
    return j.selectExpr(
        "CAST(year(o_orderdate) AS INT) AS year",
        f"{rnd} AS round",
        f"{_case('o_orderstatus', STATUS_TO_SESSION)} AS session_type",
        f"concat('GP_', CAST({rnd} AS STRING)) AS grand_prix",
        f"concat('D', CAST({drv} AS STRING)) AS Driver",
        f"CAST({drv} AS STRING) AS DriverNumber",
        f"CASE WHEN l_discount = CAST({NO_TEAM_DISCOUNT} AS DOUBLE) THEN CAST(NULL AS STRING) "
        f"ELSE concat('T', CAST(CAST(floor({drv} / 2) AS INT) AS STRING)) END AS Team",
        "CAST(l_orderkey AS DOUBLE) AS LapNumber",
        f"CASE WHEN l_tax = CAST({NULL_LAP_TAX} AS DOUBLE) THEN CAST(NULL AS DOUBLE) "
        f"WHEN l_tax = CAST({NEGATIVE_LAP_TAX} AS DOUBLE) THEN -l_extendedprice / 1000 "
        "ELSE l_extendedprice / 1000 END AS LapTime",
        f"CASE WHEN l_quantity = {NULL_SECTOR_QUANTITY} THEN CAST(NULL AS DOUBLE) "
        "ELSE l_quantity + l_discount END AS Sector1Time",
        "p_retailprice / 3 AS SpeedST",
        f"CASE WHEN l_returnflag = 'N' AND l_linenumber = {NULL_COMPOUND_LINE} THEN CAST(NULL AS STRING) "
        f"ELSE {_case('l_returnflag', RETURNFLAG_TO_COMPOUND)} END AS Compound",
        "l_linestatus = 'F' AS IsAccurate",
    )


EVENT_LABELS = [
    "CAST(year(ts) AS INT) AS year",
    "CAST(dayofmonth(ts) AS INT) AS round",
    "'R' AS session_type",
    "concat('GP_', CAST(CAST(dayofmonth(ts) AS INT) AS STRING)) AS grand_prix",
]
JSON_K = "TRY_CAST(get_json_object(props, '$.k') AS DOUBLE)"


def car_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as bronze car data (one row per telemetry sample)."""
    return read_table(spark, sf_dir, "events").selectExpr(
        *EVENT_LABELS,
        f"concat('D', CAST(user_id % {DRIVERS_MOD} AS STRING)) AS driver",
        "ts AS Date",
        "CASE WHEN event_type = 'signup' AND value < 5 THEN CAST(NULL AS DOUBLE) ELSE value END AS Speed",
        "value * 50 AS RPM",
        f"{JSON_K} * CAST(1.05 AS DOUBLE) AS Throttle",
        "event_type = 'click' AS Brake",
    )


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as bronze weather samples."""
    return read_table(spark, sf_dir, "events").selectExpr(
        *EVENT_LABELS,
        "CAST(event_id AS DOUBLE) AS Time",
        "value / 4 - 15 AS AirTemp",
        f"{JSON_K} * CAST(1.02 AS DOUBLE) AS Humidity",
        "event_type = 'error' AS Rainfall",
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (year, round, session_type) of the laps view with a real session type."""
    return (laps_raw(spark, sf_dir)
            .filter(F.col("session_type").isin(*schemas.SESSION_TYPES))
            .select(*schemas.SLICE_KEY).distinct())


def checkpoint_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bronze file listing: one file per (kind, session), with gaps and legacy names."""
    kinds = F.array(*[F.lit(k) for k in schemas.KINDS])
    files = sessions(spark, sf_dir).select("*", F.explode(kinds).alias("kind"))
    files = files.filter(~(((F.col("kind") == "tel") & (F.col("round") == NO_TEL_ROUND))
                           | ((F.col("kind") == "weather") & (F.col("year") == NO_WEATHER_YEAR))))
    legacy = (F.col("year") == LEGACY_YEAR) & (F.col("session_type") == "R")
    return files.select(
        scalars.checkpoint_file_name("kind", "year", "round", "session_type", legacy).alias("file_name"),
        "kind", "year", "round", "session_type",
    )


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event calendar: one row per (year, round) with its date."""
    o = read_table(spark, sf_dir, "orders")
    rnd = F.quarter("o_orderdate").cast("int")
    return (o.groupBy(F.year("o_orderdate").cast("int").alias("year"), rnd.alias("round"))
            .agg(F.max("o_orderdate").alias("event_date"))
            .select("year", "round", F.concat(F.lit("GP_"), F.col("round").cast("string")).alias("grand_prix"),
                    "event_date"))
