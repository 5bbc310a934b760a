"""Random small lap frames: Spark operators against a brute-force exact computation in Python."""

import math
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from paddock import schemas
from paddock.operators import gold, refresh, silver

from .test_edges import laps_frame

SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

lap_times = st.one_of(st.none(), st.just(float("nan")), st.just(-1.0),
                      st.integers(500_000, 1_500_000).map(lambda n: n / 10_000))   # 4 decimals: ties at 3
speeds = st.integers(29_000, 33_000).map(lambda n: n / 100)
rows = st.lists(st.tuples(
    st.sampled_from(["A", "B", "C"]),              # driver
    st.sampled_from(["X", "Y", None]),             # team
    st.integers(1, 4).map(float),                  # lap number
    lap_times,
    st.one_of(st.none(), st.integers(200_000, 400_000).map(lambda n: n / 10_000)),  # sector 1
    speeds,
    st.sampled_from(["SOFT", "MEDIUM", "HARD", "soft", None]),
    st.sampled_from(["R", "Q"]),
), min_size=1, max_size=25)


def _micro(x):
    return Decimal(repr(x)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)


def _round(q: Fraction, n: int) -> float:
    """Half-up rounding of a non-negative fraction to n decimals, as the nearest double."""
    return float(Fraction(math.floor(q * 10 ** n + Fraction(1, 2)), 10 ** n))


def _avg(values, n):
    vals = [Fraction(_micro(v)) for v in values if v is not None]
    return None if not vals else _round(sum(vals) / len(vals), n)


def _ext(values, n, fn):
    vals = [v for v in values if v is not None]
    return None if not vals else float(_micro(fn(vals)).quantize(Decimal(10) ** -n, rounding=ROUND_HALF_UP))


def _frame(spark, data):
    return laps_frame(spark, [(2024, 1, s, "GP_1", d, t, ln, lt, s1, sp, c, True)
                              for d, t, ln, lt, s1, sp, c, s in data])


def _clean(data):
    out = []
    for d, t, ln, lt, s1, sp, c, s in data:
        if lt is None or lt != lt or lt <= 0:
            continue
        out.append((d, t, ln, lt, s1, sp, c, s))
    return out


def _ranks(values):
    order = sorted(values, key=lambda v: (v is not None, v if v is not None else 0))
    return {v: order.index(v) + 1 for v in set(values)}


@SETTINGS
@given(rows)
def test_gold_driver_matches_brute_force(spark, data):
    out = {(r.session_type, r.driver, r.team): r for r in
           gold.gold_driver_performance(silver.transform_laps(_frame(spark, data))).collect()}
    groups = defaultdict(list)
    for d, t, ln, lt, s1, sp, c, s in _clean(data):
        if t is not None:
            groups[(s, d, t)].append((ln, lt, s1, sp, c))
    assert set(out) == set(groups)
    best = {k: _ext([g[1] for g in v], 3, min) for k, v in groups.items()}
    for k, v in groups.items():
        r = out[k]
        assert r.total_laps == len({g[0] for g in v})
        assert r.avg_lap_time_s == _avg([g[1] for g in v], 3)
        assert r.best_lap_time_s == best[k]
        assert r.avg_sector1_s == _avg([g[2] for g in v], 3)
        assert r.avg_speed_trap_kmh == _avg([g[3] for g in v], 1)
        assert r.max_speed_trap_kmh == _ext([g[3] for g in v], 1, max)
        assert (r.soft_laps, r.medium_laps, r.hard_laps) == tuple(
            sum(1 for g in v if g[4] == name) for name in ("SOFT", "MEDIUM", "HARD"))
        ranks = _ranks([b for kk, b in best.items() if kk[0] == k[0]])
        assert r.rank_in_race == ranks[best[k]]


@SETTINGS
@given(rows)
def test_gold_team_matches_brute_force(spark, data):
    out = {(r.session_type, r.team): r for r in
           gold.gold_team_season_stats(silver.transform_laps(_frame(spark, data))).collect()}
    groups = defaultdict(list)
    for d, t, ln, lt, s1, sp, c, s in _clean(data):
        if t is not None:
            groups[(s, t)].append((d, ln, lt, sp))
    assert set(out) == set(groups)
    for k, v in groups.items():
        r = out[k]
        assert (r.total_laps, r.drivers_count) == (len({g[1] for g in v}), len({g[0] for g in v}))
        assert r.avg_lap_time_s == _avg([g[2] for g in v], 3)
        assert r.avg_speed_trap_kmh == _avg([g[3] for g in v], 1)


@SETTINGS
@given(rows)
def test_dedup_keeps_least_row_per_key(spark, data):
    laps = silver.transform_laps(_frame(spark, data))
    got = sorted((tuple(r) for r in refresh.dedup_by_key(laps, schemas.SILVER_LAPS_KEY).collect()), key=repr)
    key_idx = [laps.columns.index(k) for k in schemas.SILVER_LAPS_KEY]
    other_idx = [i for i in range(len(laps.columns)) if i not in key_idx]

    def order(row):      # ascending, NULL first, field by field
        return tuple((row[i] is not None, row[i] if row[i] is not None else 0) for i in other_idx)

    best = {}
    for row in (tuple(r) for r in laps.collect()):
        k = tuple(row[i] for i in key_idx)
        if k not in best or order(row) < order(best[k]):
            best[k] = row
    assert got == sorted(best.values(), key=repr)
    dups = {tuple(r)[:5]: r.duplicate_rows for r in refresh.pk_violations(laps, schemas.SILVER_LAPS_KEY).collect()}
    counts = defaultdict(int)
    for row in (tuple(r) for r in laps.collect()):
        counts[tuple(row[i] for i in key_idx)] += 1
    assert dups == {k: n for k, n in counts.items() if n > 1}


slice_rows = st.lists(st.tuples(st.integers(2023, 2024), st.integers(1, 3), st.sampled_from(["R", "Q"]),
                                st.integers(0, 9)), max_size=15)
SLICE_SCHEMA = "year int, round int, session_type string, v int"


@SETTINGS
@given(slice_rows, slice_rows, st.lists(st.tuples(st.integers(2023, 2024), st.integers(1, 3),
                                                  st.sampled_from(["R", "Q"])), max_size=4))
def test_replace_slices_matches_brute_force(spark, target, stage, requested):
    t = spark.createDataFrame(target, SLICE_SCHEMA)
    s = spark.createDataFrame(stage, SLICE_SCHEMA)
    got = sorted(tuple(r) for r in refresh.replace_slices(t, s, requested).collect())
    req = set(requested)
    want = sorted([r for r in target if r[:3] not in req] + [r for r in stage if r[:3] in req])
    assert got == want


@SETTINGS
@given(st.dictionaries(st.tuples(st.integers(1, 4), st.sampled_from(["A", "B"])), st.integers(0, 9), max_size=8),
       st.dictionaries(st.tuples(st.integers(1, 4), st.sampled_from(["A", "B"])), st.integers(0, 9), max_size=8))
def test_upsert_matches_brute_force(spark, target, stage):
    schema = "k int, d string, v int"
    t = spark.createDataFrame([(*k, v) for k, v in target.items()], schema)
    s = spark.createDataFrame([(*k, v) for k, v in stage.items()], schema)
    got = sorted(tuple(r) for r in refresh.upsert_by_key(t, s, ["k", "d"]).collect())
    assert got == sorted((*k, v) for k, v in {**target, **stage}.items())
    again = refresh.upsert_by_key(refresh.upsert_by_key(t, s, ["k", "d"]), s, ["k", "d"])
    assert sorted(tuple(r) for r in again.collect()) == got        # R2 twice = once
