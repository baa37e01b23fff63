"""Every named query against the SQL that must agree with it."""

import duckdb
import pytest

from __spark_entry__ import entry
from compare import TABLES, _sorted
from ledgerlark.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, engine, name):
    df = QUERIES[name](spark, FOLDER)
    ours = _sorted(df.columns, [tuple(r) for r in df.collect()])
    cursor = engine.execute(ORACLES[name])
    theirs = _sorted([d[0] for d in cursor.description], cursor.fetchall())
    assert ours == theirs
    assert ours[1], "an empty result checks nothing"


def test_entry(spark):
    assert entry(spark).count() == 20
