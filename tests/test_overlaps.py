"""Merged intervals against the SQL and against a plain loop."""

import random

import duckdb

from quillon.plans import registry


def merged(spark, rows, path):
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double").write.parquet(f"{path}/lineitem.parquet")
    return sorted((tuple(r) for r in registry.queries()["overlap_merge"](spark, str(path)).select("k", "w", "s", "e", "n").collect()), key=repr)


def test_nulls_are_where_the_sql_has_them(spark, tmp_path):
    """No two items of an order are alike, so that the SQL has one result."""
    rng = random.Random(3)
    rows = sorted({(k, rng.choice((1, 2, 3, 5, 7, None)), rng.choice((5.0, 30.0, 50.0, None))) for k in range(300) for _ in range(rng.randrange(1, 7))}, key=repr)
    rows = list({(k, s, None if s is None else q): (k, s, q) for k, s, q in rows}.values())
    got = merged(spark, rows, tmp_path)
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    assert got == sorted((tuple(r) for r in con.execute(registry.oracle_sql()["overlap_merge"]).fetchall()), key=repr)


def test_alike_items_are_of_one_interval(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, rng.randrange(1, 8), 20.0 * rng.randrange(3)) for k in range(200) for _ in range(6)]
    want = []
    for k in range(200):
        found = []
        for s, e in sorted((s, s + int(q // 20)) for o, s, q in rows if o == k):
            if not found or s > found[-1][1]:
                found.append([s, e, 0])
            found[-1][1:] = max(found[-1][1], e), found[-1][2] + 1
        want += [(k, w, *x) for w, x in enumerate(found, 1)]
    assert merged(spark, rows, tmp_path) == sorted(want, key=repr)
