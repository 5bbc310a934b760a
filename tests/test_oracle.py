"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from paddock.plans import registry
from scripts.check_oracle import TABLES, canon, digest

from .conftest import SF_SMALL

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()
SPARK_TO_DUCKDB = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                   "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    missing = sorted(set(registry.QUERIES) - set(ORACLES))
    assert missing == [], missing


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.sql(ORACLES[name])
    want = canon(res.columns, res.fetchall())
    assert sorted(df.columns) == sorted(res.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)
    duck_types = {r[0]: r[1] for r in con.sql("DESCRIBE " + ORACLES[name]).fetchall()}
    assert {c: SPARK_TO_DUCKDB.get(t, t) for c, t in df.dtypes} == duck_types


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:5] == ["year", "grand_prix", "session_type", "driver", "team"]
    assert df.count() > 0
