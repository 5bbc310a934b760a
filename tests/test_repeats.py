"""Silver of rows whose key may repeat: only they are aggregated, whatever the bit filter holds."""

import pytest

from paddock import schemas
from paddock.operators import refresh, silver
from paddock.plans import medallion
from paddock.plans.medallion import Layout
from paddock.sources import bronze

from .test_edges import lap, laps_frame
from .test_lakes import rows_of


def _delivered(spark, folder):
    rows = [lap(lap_no=float(n), t=90 + n / 7) for n in range(200)]
    rows += [lap(lap_no=7.0, t=80.0), lap(lap_no=7.0, t=80.0), lap(lap_no=-0.0, t=70.0), lap(lap_no=None)]
    lake = Layout(f"{folder}/lake")
    bronze.write_bronze(laps_frame(spark, rows), lake.bronze, "laps")
    return lake


def test_only_rows_whose_key_may_repeat_are_aggregated(spark, tmpdir_fresh, monkeypatch):
    lake, met = _delivered(spark, tmpdir_fresh), {}
    for name in ("one_per_key", "duplicates"):
        def counting(df, key, name=name, real=getattr(refresh, name)):
            met[name] = df.count()
            return real(df, key)
        monkeypatch.setattr(refresh, name, counting)
    report = medallion.run_silver(spark, lake)["silver_laps"]
    assert report["rows"] == 200 and report["rejected_rows"] == 4
    assert all(5 <= n <= 10 for n in met.values()) and len(met) == 2   # three of one key, two of another


@pytest.mark.parametrize("words", [1, 1 << 19])
def test_a_crowded_filter_changes_no_row(spark, tmpdir_fresh, monkeypatch, words):
    monkeypatch.setattr(refresh, "FILTER_WORDS", words)
    lake, key = _delivered(spark, tmpdir_fresh), schemas.SILVER_LAPS_KEY
    medallion.run_silver(spark, lake)
    rows = silver.transform_laps(bronze.scan_bronze(spark, lake.bronze, "laps"))
    whole = refresh.dedup_by_key(rows.where("lap_number is not null"), key)
    assert rows_of(lake.silver("silver_laps").read(spark)) == rows_of(whole)
    assert rows_of(lake.rejects("silver_laps").read(spark)) == rows_of(refresh.rejects(rows, key))


def test_equal_keys_have_one_hash(spark):
    df = spark.createDataFrame([(1, 0.0), (1, -0.0), (2, 0.0), (2, float("nan")), (2, float("nan"))], "a int, b double")
    hashed = df.withColumn(refresh.KEY_HASH, refresh.key_hash(df, ["a", "b"]))
    marked = refresh.with_repeats(hashed, refresh.repeated_filter(hashed))
    assert sorted(r._repeats for r in marked.collect()) == [False, True, True, True, True]
    assert refresh.repeated_filter(hashed.limit(0)).count() == 0
