"""Every registered query against DuckDB on the smallest tables."""

import glob
from pathlib import Path

import duckdb
import pytest

from quillon.plans import registry

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {Path(p).stem} as select * from '{p}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(map(tuple, frame.astype(object).where(frame.notna(), None).values.tolist()), key=lambda r: tuple(map(repr, r)))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_without_sql(spark, name):
    assert QUERIES[name](spark, DATA).limit(1).count() == 1
