import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from paddock.session import DEFAULT_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def tmpdir_fresh():
    # A fresh folder per test; never reused, never cleared.
    return tempfile.mkdtemp(prefix="paddock-test-")
