"""Data-product contract: quality metrics and the published view.

Each metric is a single global aggregate (partial per task, one row merged),
so it costs one pass and ships a handful of numbers, never rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions.scalars import pct

# --- fixed values: contract thresholds and allowed categories ---
COMPLETENESS_MIN_PCT = 99.0      # > 99 %
VALIDITY_MIN_PCT = 100.0         # = 100 %
CONSISTENCY_MIN_PCT = 98.0       # > 98 %
VALID_SESSION_TYPES = ["Q", "R"]
LAP_TIME_LOW_S, LAP_TIME_HIGH_S = 60, 200   # exclusive bounds

# Published columns and their contract types.
CONTRACT_COLUMNS = [
    ("year", "int"), ("grand_prix", "string"), ("session_type", "string"), ("driver", "string"),
    ("team", "string"), ("avg_lap_time_s", "double"), ("soft_laps", "int"), ("rank_in_race", "int"),
]


def _metric(df: DataFrame, name: str, condition, passed) -> DataFrame:
    return (df.agg(pct(condition).alias("value_pct"), F.count(F.lit(1)).alias("rows_checked"))
            .select(F.lit(name).alias("metric"), "value_pct", "rows_checked",
                    passed(F.col("value_pct")).alias("passed")))


def completeness(gold_driver: DataFrame) -> DataFrame:
    """% rows with ``avg_lap_time_s`` not NULL; passes above 99 %."""
    return _metric(gold_driver, "completeness_avg_lap_time_s", F.col("avg_lap_time_s").isNotNull(),
                   lambda v: v > COMPLETENESS_MIN_PCT)


def session_validity(gold_driver: DataFrame) -> DataFrame:
    """% rows with ``session_type`` in (Q, R); passes only at 100 %."""
    return _metric(gold_driver, "validity_session_type", F.col("session_type").isin(*VALID_SESSION_TYPES),
                   lambda v: v >= VALIDITY_MIN_PCT)


def lap_consistency(silver_laps: DataFrame) -> DataFrame:
    """D3: % laps with 60 s < lap time < 200 s; passes above 98 %."""
    cond = (F.col("lap_time_s") > LAP_TIME_LOW_S) & (F.col("lap_time_s") < LAP_TIME_HIGH_S)
    return _metric(silver_laps, "consistency_lap_time", cond, lambda v: v > CONSISTENCY_MIN_PCT)


def quality_report(gold_driver: DataFrame, silver_laps: DataFrame) -> DataFrame:
    """D1-D3 as one three-row frame."""
    return (completeness(gold_driver).unionByName(session_validity(gold_driver))
            .unionByName(lap_consistency(silver_laps)))


def contract_view(gold_driver: DataFrame) -> DataFrame:
    """The eight published columns with their contract types."""
    return gold_driver.select(*[F.col(c).cast(t).alias(c) for c, t in CONTRACT_COLUMNS])
