from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paths import SF_ORACLE, SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ontime.session import LOCAL_CONF

    scratch = tempfile.mkdtemp(prefix="ontime-tests-")
    builder = SparkSession.builder.master("local[4]").appName("ontime-tests")
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
               .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints")))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck_small():
    from oracle_compare import duck

    return duck(SF_SMALL)


@pytest.fixture(scope="session")
def duck_oracle():
    from oracle_compare import duck

    return duck(SF_ORACLE)


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
