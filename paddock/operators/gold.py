"""Silver laps -> ranked gold aggregates (A1-A9, W1, W2), by way of mergeable states.

A state row stands for the laps of one group that fall into one block of 64 lap numbers: counts, exact sums, extremes, tyre
counts and a 64-bit map of the lap numbers seen.  Everything in it merges (sums, ``bit_or``, min, max), so

* ``count(DISTINCT lap_number)`` is a sum of ``bit_count`` over blocks: both gold tables aggregate with fixed-size
  buffers in hash aggregates, map-side combined, and no plan needs an ``Expand`` for two distinct counts;
* states can be stored per session: a refreshed session replaces its own, and gold of the affected events and seasons is
  merged from states without reading laps again (``plans.medallion``).  Stored, measures and lap maps are rows of their own:
  measures combine to a few rows a session wherever they are read, and only maps (two numbers and a key) are shuffled.

Plan shape: partial hash aggregate -> exchange on (group key, block) -> merge -> exchange on the group key -> exchange on
the rank partition, each moving fewer rows than the one before; no single session lands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock import schemas
from paddock.functions.scalars import avg_of_state, avg_state, count_equal, merge_avg_states, round_exact

# --- fixed values: tyre compounds counted by the driver aggregate (case-sensitive) ---
COMPOUNDS = {"soft_laps": "SOFT", "medium_laps": "MEDIUM", "hard_laps": "HARD"}


def null_key_filter(key: list[str]) -> Column:
    cond = F.lit(True)
    for k in key:
        cond = cond & F.col(k).isNotNull()
    return cond


def split_null_keys(df: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): gold keys are NOT NULL, so such laps never enter a group."""
    ok = null_key_filter(key)
    return df.filter(ok), df.filter(~ok)


# A lap number is a whole number in a block of 64; any other value (fractions, beyond whole doubles) is a block of its own.
BLOCK = ["lap_block", "odd_lap"]
WHOLE_LIMIT = float(1 << 53)
AVERAGED = ["lap_time_s", "sector1_s", "sector2_s", "sector3_s", "speed_st"]


def with_lap_block(laps: DataFrame) -> DataFrame:
    """Adds ``lap_block`` and ``odd_lap`` (where a lap number belongs) and ``lap_bit`` (its place there; 0 for none)."""
    lap = F.col("lap_number")
    whole = (F.abs(lap) < WHOLE_LIMIT) & (lap == F.floor(lap))
    number = F.when(whole, lap.cast("long"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(64)).cast("int"))
    return laps.withColumns({
        "lap_block": F.floor(number / 64).cast("long"),
        "odd_lap": F.when(~whole, lap),
        "lap_bit": F.when(whole, bit).when(lap.isNotNull(), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))})


def _measured() -> list[Column]:
    """Aggregates of laps that become a state, all but the lap map."""
    return [*[avg_state(c).alias(c) for c in AVERAGED], F.min("lap_time_s").alias("best_lap"), F.max("speed_st").alias("max_speed"),
            *[count_equal("tyre_compound", v).alias(name) for name, v in COMPOUNDS.items()]]


def lap_states(laps: DataFrame, by: list[str]) -> DataFrame:
    """One state row per group ``by`` and block of lap numbers (A3, A5-A9 before rounding)."""
    return with_lap_block(laps).groupBy(*by, *BLOCK).agg(F.bit_or("lap_bit").alias("lap_bits"), *_measured())


def stored_states(laps: DataFrame, by: list[str]) -> DataFrame:
    """The states of laps that can be read twice, as two kinds of rows: one per group with its measures and no lap, and one per
    group and block with its lap map and no measures.  However sparse the lap numbers, only the narrow maps are shuffled."""
    measures = laps.groupBy(*by).agg(*_measured()).withColumn("lap_bits", F.lit(0).cast("long"))
    maps = with_lap_block(laps).where("lap_bit <> 0").groupBy(*by, *BLOCK).agg(F.bit_or("lap_bit").alias("lap_bits"))
    return measures.unionByName(maps, allowMissingColumns=True)


def _merged(also: list[str] = ()) -> list[Column]:
    """Aggregates that merge states, all but the lap map; columns in ``also`` are added up."""
    return [*[merge_avg_states(c).alias(c) for c in AVERAGED], F.min("best_lap").alias("best_lap"), F.max("max_speed").alias("max_speed"),
            *[F.sum(name).alias(name) for name in (*COMPOUNDS, *also)]]


def merge_states(states: DataFrame, by: list[str], also: list[str] = ()) -> DataFrame:
    """States of coarser groups: one row per ``by`` and block."""
    return states.groupBy(*by, *BLOCK).agg(F.bit_or("lap_bits").alias("lap_bits"), *_merged(also))


def laps_of(states: DataFrame, by: list[str], also: list[str] = ()) -> DataFrame:
    """One row per group, its blocks merged: ``total_laps`` (A3) and the merged states."""
    return states.groupBy(*by).agg(F.sum(F.bit_count("lap_bits")).cast("long").alias("total_laps"), *_merged(also))


def with_laps(merged: DataFrame, states: DataFrame, by: list[str]) -> DataFrame:
    """``merged`` (one row per ``by``) with ``total_laps``: the lap maps of the states are merged by themselves."""
    maps = states.where("lap_bits <> 0").groupBy(*by, *BLOCK).agg(F.bit_or("lap_bits").alias("lap_bits"))
    laps = maps.groupBy(*by).agg(F.sum(F.bit_count("lap_bits")).cast("long").alias("total_laps"))
    return merged.join(laps, by, "left").withColumn("total_laps", F.coalesce("total_laps", F.lit(0).cast("long")))


def stored_driver_rows(states: DataFrame) -> DataFrame:
    """:func:`driver_rows` of states that can be read twice (:func:`stored_states`, or rows that hold both)."""
    key = schemas.GOLD_DRIVER_KEY
    return _driver_rows(with_laps(states.groupBy(*key).agg(*_merged()), states, key))


def stored_team_rows(states: DataFrame) -> DataFrame:
    """:func:`team_rows` of states that can be read twice: measures are merged by driver, then by team."""
    key = schemas.GOLD_TEAM_KEY
    each = states.groupBy(*key, "driver").agg(*_merged()).withColumn("drivers_count", F.col("driver").isNotNull().cast("long"))
    return _team_rows(with_laps(each.groupBy(*key).agg(*_merged(["drivers_count"])), states, key))


def driver_rows(states: DataFrame) -> DataFrame:
    """A1 + W1 from states of (at least) the driver grain."""
    key = schemas.GOLD_DRIVER_KEY
    return _driver_rows(laps_of(merge_states(states, key), key))


def _driver_rows(merged: DataFrame) -> DataFrame:
    key = schemas.GOLD_DRIVER_KEY
    rows = merged.select(
        *key, "total_laps",
        avg_of_state("lap_time_s", 3).alias("avg_lap_time_s"), round_exact("best_lap", 3).alias("best_lap_time_s"),
        *[avg_of_state(f"sector{k}_s", 3).alias(f"avg_sector{k}_s") for k in (1, 2, 3)],
        avg_of_state("speed_st", 1).alias("avg_speed_trap_kmh"), round_exact("max_speed", 1).alias("max_speed_trap_kmh"), *COMPOUNDS)
    return rank_in_race(rows).select(*schemas.GOLD_DRIVER.fieldNames())


def team_rows(states: DataFrame) -> DataFrame:
    """A2 + W2 from states that tell drivers apart: one state of each driver of a team counts for them (A4)."""
    key = schemas.GOLD_TEAM_KEY
    each = Window.partitionBy(*key, "driver").orderBy(*BLOCK, "lap_bits")
    one = F.row_number().over(each) == 1
    counted = states.withColumn("drivers_count", (one & F.col("driver").isNotNull()).cast("long"))
    return _team_rows(laps_of(merge_states(counted, key, ["drivers_count"]), key, ["drivers_count"]))


def _team_rows(merged: DataFrame) -> DataFrame:
    key = schemas.GOLD_TEAM_KEY
    rows = merged.select(
        *key, avg_of_state("lap_time_s", 3).alias("avg_lap_time_s"), round_exact("best_lap", 3).alias("best_lap_time_s"),
        "total_laps", "drivers_count", avg_of_state("speed_st", 1).alias("avg_speed_trap_kmh"))
    return team_rank_in_season(rows).select(*schemas.GOLD_TEAM.fieldNames())


def rank_in_race(df: DataFrame) -> DataFrame:
    """Rank by rounded best lap within (year, grand_prix, session_type); gaps after ties."""
    w = Window.partitionBy("year", "grand_prix", "session_type").orderBy(F.col("best_lap_time_s").asc_nulls_first())
    return df.withColumn("rank_in_race", F.rank().over(w).cast("int"))


def team_rank_in_season(df: DataFrame) -> DataFrame:
    """Rank by rounded average lap within (year, session_type)."""
    w = Window.partitionBy("year", "session_type").orderBy(F.col("avg_lap_time_s").asc_nulls_first())
    return df.withColumn("team_rank_in_season", F.rank().over(w).cast("int"))


def gold_driver_performance(silver_laps: DataFrame) -> DataFrame:
    """A1 + W1: one row per (year, grand_prix, session_type, driver, team)."""
    keyed, _ = split_null_keys(silver_laps, schemas.GOLD_DRIVER_KEY)
    return driver_rows(lap_states(keyed, schemas.GOLD_DRIVER_KEY))


def gold_team_season_stats(silver_laps: DataFrame) -> DataFrame:
    """A2 + W2: one row per (year, session_type, team)."""
    keyed, _ = split_null_keys(silver_laps, schemas.GOLD_TEAM_KEY)
    return team_rows(lap_states(keyed, [*schemas.GOLD_TEAM_KEY, "driver"]))


def gold_rejects(silver_laps: DataFrame) -> DataFrame:
    """Laps that cannot enter either gold table (NULL in a gold key column)."""
    key = sorted(set(schemas.GOLD_DRIVER_KEY) | set(schemas.GOLD_TEAM_KEY))
    return silver_laps.filter(~null_key_filter(key))
