"""Dropping columns without a value: what makes the frame runs once."""

from pyspark.sql import functions as F

from paddock.operators import conform
from paddock.plans import registry

from .conftest import SF_SMALL
from .test_lakes import rows_of


def test_dropping_null_columns_makes_its_input_once(spark):
    plan = registry.QUERIES["drop_all_null_columns"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    df = spark.range(10).selectExpr("id", "CAST(NULL AS string) AS none", "if(id = 3, 1, NULL) AS one").mapInArrow(seen, "id long, none string, one int")
    kept = conform.drop_all_null_columns(df.withColumn("nothing", F.lit(None)))
    assert kept.columns == ["id", "one"] and rows_of(kept) == rows_of(spark.range(10).selectExpr("id", "if(id = 3, 1, NULL)"))
    assert calls.value == 10
    assert conform.drop_all_null_columns(df.where("id < 0")).columns == []
    assert conform.drop_all_null_columns(spark.range(3).select(F.lit(None).alias("n"))).columns == []
