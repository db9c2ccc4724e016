"""Every query against its SQL at the smallest scale, and the driver's contract."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_twins import TABLES, compare  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from docsift.workload.spark_queries import QUERIES  # noqa: E402
from docsift.workload.twins import TWINS  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def test_contract(spark):
    assert set(QUERIES) == set(TWINS)
    assert set(QUERIES) <= set(queries()) and set(TWINS) <= set(oracle_sql()) <= set(queries())
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    rows = df.collect()
    assert rows
    got = con.execute(TWINS[name])
    cols = [d[0] for d in got.description]
    assert compare(rows, df.columns, got.fetchall(), cols) is None
