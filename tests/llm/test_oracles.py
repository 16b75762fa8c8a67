"""The SQL of the opN_ queries gives their rows, and says the contracts by itself."""

import glob
from pathlib import Path

import duckdb
import pytest

from quillon.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {Path(p).stem} as select * from '{p}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(map(tuple, frame.astype(object).where(frame.notna(), None).values.tolist()), key=lambda r: tuple(map(repr, r)))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows(spark, duck, name):
    got, want = queries.queries()[name](spark, DATA).toPandas(), duck.sql(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
