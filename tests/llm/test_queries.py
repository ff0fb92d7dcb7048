"""The registered queries of the text operators on the smallest tables: beside their SQL, or whole."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from check_oracles import TABLES, _plain, same
from tidelog.llm.registry import QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    found = duckdb.connect()
    for name in TABLES:
        found.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DIR}/{name}.parquet'")
    return found


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    frame = queries()[name](spark, DIR)
    columns = sorted(frame.columns)
    got = [tuple(_plain(v) for v in row) for row in frame.select(*columns).collect()]
    if name not in ("op12_hard_negatives", "op13_ranked_search"):  # those have a row for each
        table = "pages" if name == "op3_warc" else "documents"
        assert len(got) == connection.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
    if name in oracle_sql():
        result = connection.execute(oracle_sql()[name])
        found = [d[0] for d in result.description]
        assert sorted(found) == columns
        order = [found.index(c) for c in columns]
        assert same(got, [tuple(_plain(r[i]) for i in order) for r in result.fetchall()]) is None
