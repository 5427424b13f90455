import math

import duckdb
import pytest

import __spark_entry__ as entry
from trackmill.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in ("events", "customer", "orders", "documents"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return str(v) if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(ORACLES[name])
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    have = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert have == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())
