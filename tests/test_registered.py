"""Every registered query beside its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import TABLES, _plain, same
from tidelog.plans import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.fixture(scope="module")
def connection():
    found = duckdb.connect()
    for name in TABLES:
        found.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return found


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = [tuple(_plain(v) for v in row) for row in frame.select(*[f"`{c}`" for c in columns]).collect()]
    if name not in oracle_sql():
        assert got
        return
    result = connection.execute(oracle_sql()[name])
    found = [d[0] for d in result.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]
    want = [tuple(_plain(r[i]) for i in order) for r in result.fetchall()]
    assert same(got, want) is None
