from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from remitlens.session import get_spark
    extra = {}
    from pyspark import SparkConf
    if not SparkConf().get("spark.checkpoint.dir", None):
        # Tests only: a private checkpoint folder when the environment names none.
        extra["spark.checkpoint.dir"] = str(tmp_path_factory.mktemp("ckpt"))
    s = get_spark(cpus=4, shuffle_partitions=4, app="remitlens-tests", extra=extra)
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from remitlens.sources.model import TABLE_NAMES
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
