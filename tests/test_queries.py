"""Every registered query against its DuckDB oracle at sf0.001 (the driver's gate
runs the same comparison at sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from contrail.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "embeddings", "pages", "customer"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    rows = df.collect()
    cur = con.execute(oracle.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert want, "the oracle has no rows to compare with"
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, rows) == canon(dcols, want)


def test_the_report_comes_in_its_order(spark, con):
    """The sequence of rows, which the comparison above leaves out."""
    df = catalog.queries()["report_legs"](spark, SF)
    cols = ", ".join(df.columns)
    ordered = f"SELECT {cols} FROM ({oracle.oracle_sql()['report_legs']}) ORDER BY entity, flight_num"
    want = con.execute(ordered).fetchall()
    assert [tuple(map(norm, r)) for r in df.collect()] == [tuple(map(norm, r)) for r in want] and len(want) > 50


def test_every_query_is_registered_with_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 72 and "flight_num" in df.columns
