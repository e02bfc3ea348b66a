"""Every registered query against its DuckDB oracle (sf0.001)."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from starloom.sources.fixtures import TABLES

from conftest import SF_SMALL

ORACLES = entry.oracle_sql()
# the training-data queries have tests of their own
QUERIES = {name: fn for name, fn in entry.queries().items() if not name.startswith("op") and name != "pipeline"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    return v


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)
    assert len(QUERIES) >= 45


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(df.columns, rows) == _canon(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "month", "day", "time_of_day", "product_name", "gender", "is_active",
                          "room_name", "kroner_sales", "unit_sales"]
