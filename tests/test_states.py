"""Stored states of sparse laps: measures apart from lap maps, gold the same."""

import itertools

from pyspark.sql import functions as F

from paddock.operators import gold, silver
from paddock.plans import medallion

from .test_edges import lap, laps_frame
from .test_lakes import rows_of


def _sparse(spark):
    """Laps whose numbers hardly ever share a block of 64, two drivers a team, one lap without a number, one driver unknown."""
    cells = [lap(driver=d, team=t, lap_no=64.0 * n, t=90 + n / 7) for (d, t), n in itertools.product((("A", "X"), ("B", "X"), ("B", "Y")), range(50))]
    laps = laps_frame(spark, [*cells, lap(driver="C", team="Z", lap_no=1.0, t=95.0)])
    df = silver.transform_laps(laps)
    unnumbered = F.when(F.col("lap_number") != 128.0, F.col("lap_number"))
    return df.withColumns({"lap_number": unnumbered, "driver": F.when(F.col("team") != "Z", F.col("driver"))})


def test_stored_states_keep_measures_apart_from_lap_maps(spark):
    states = gold.stored_states(_sparse(spark), medallion.STATE_GRAIN).cache()
    assert states.where("lap_bits = 0").count() == 4                        # one row of measures a group
    maps = states.where("lap_bits <> 0")
    assert maps.count() == 3 * 49 + 1 and maps.where("lap_time_s is not null or soft_laps is not null").count() == 0


def test_gold_of_stored_states_is_that_of_laps(spark):
    df = _sparse(spark)
    apart = [gold.stored_states(df.where(F.col("lap_time_s") % 2 < 1), medallion.STATE_GRAIN),
             gold.stored_states(df.where(F.col("lap_time_s") % 2 >= 1), medallion.STATE_GRAIN)]
    whole = [gold.lap_states(df, medallion.STATE_GRAIN)]                     # as lakes hold them that were written before
    for parts in (apart, whole, [apart[0], gold.lap_states(df.where(F.col("lap_time_s") % 2 >= 1), medallion.STATE_GRAIN)]):
        states = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        assert rows_of(gold.stored_driver_rows(states.where("driver is not null"))) == rows_of(gold.gold_driver_performance(df))
        assert rows_of(gold.stored_team_rows(states)) == rows_of(gold.gold_team_season_stats(df))


def test_gold_of_stored_states_sorts_no_state(spark):
    states = gold.lap_states(_sparse(spark), medallion.STATE_GRAIN)
    plan = gold.stored_team_rows(states)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and plan.count("Window") == 1            # the rank of the few teams
