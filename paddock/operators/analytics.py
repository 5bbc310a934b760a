"""Published read queries over the gold and silver tables.

Filters on ``year``/``grand_prix``/``session_type`` hit partition columns of the
stored tables, so they prune files instead of scanning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions.scalars import round_avg, round_max, round_min


def driver_performance_one_event(gold_driver: DataFrame, year: int, grand_prix: str,
                                 session_type: str) -> DataFrame:
    """One event's drivers, best first (the published query ordered by a
    non-existent ``points``; the rank is the measure that exists)."""
    return (gold_driver
            .filter((F.col("year") == year) & (F.col("grand_prix") == grand_prix)
                    & (F.col("session_type") == session_type))
            .select("driver", "team", "avg_lap_time_s", "best_lap_time_s", "rank_in_race")
            .orderBy(F.col("rank_in_race").asc_nulls_first(), "driver", "team"))


def team_season_trends(gold_team: DataFrame, year: int) -> DataFrame:
    """A season's teams by average pace, with their driver counts."""
    return (gold_team.filter(F.col("year") == year)
            .select("session_type", "team", "avg_lap_time_s", "best_lap_time_s", "drivers_count",
                    "team_rank_in_season")
            .orderBy("session_type", F.col("avg_lap_time_s").asc_nulls_first(), "team"))


def top_drivers(gold_driver: DataFrame, grand_prix: str, session_type: str, k: int = 5) -> DataFrame:
    """``ORDER BY rank_in_race LIMIT k`` with a deterministic tie-break.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top k, so only k rows per task reach the final merge.
    """
    return (gold_driver
            .filter((F.col("grand_prix") == grand_prix) & (F.col("session_type") == session_type))
            .orderBy(F.col("rank_in_race").asc_nulls_first(), "year", "driver", "team")
            .limit(k)
            .select("driver", "avg_lap_time_s"))


def row_count(df: DataFrame) -> DataFrame:
    """T4: total rows of a table, as a one-row frame (no driver action)."""
    return df.agg(F.count(F.lit(1)).alias("record_count"))


def lap_time_distribution(silver_laps: DataFrame, by=("year", "round", "session_type")) -> DataFrame:
    """Average / fastest / slowest lap per session type (per event by default)."""
    return (silver_laps.groupBy(*by)
            .agg(round_avg("lap_time_s", 6).alias("avg_lap_time"),
                 round_min("lap_time_s", 6).alias("fastest"),
                 round_max("lap_time_s", 6).alias("slowest")))
