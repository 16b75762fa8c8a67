"""Products, balancing, walks and four-dimensional maps against dense numpy versions."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.operators import contacts, hits, jobs, matrix, models
from quillon.sources.tables import stored


def frame(spark, dense, upper=False, whole=False):
    kind = int if whole else float
    rows = [(i, j, kind(v)) for (i, j), v in np.ndenumerate(dense) if v != 0 and (not upper or i <= j)]
    return spark.createDataFrame(rows, f"i long, j long, v {'long' if whole else 'double'}")


def dense_of(df, n, m=None):
    out = np.zeros((n, m or n))
    for r in df.collect():
        out[r.i, r.j] += r.v
    return out


def test_product_with_a_hub(spark, monkeypatch):
    """One inner index has most entries of both sides: it is cut, and no group holds it whole."""
    rng = np.random.default_rng(1)
    a, b = (rng.integers(-3, 4, (60, 60)) * (rng.random((60, 60)) < 0.06) for _ in range(2))
    a[:, 7], b[7, :] = rng.integers(1, 5, 60), rng.integers(1, 5, 60)
    monkeypatch.setattr(matrix, "PIECE", 16)
    monkeypatch.setattr(matrix, "GROUP", 100)
    got = matrix.product(frame(spark, a, whole=True), frame(spark, b, whole=True))
    assert dict(got.dtypes)["v"] == "bigint"
    rows = {(r.i, r.j): r.v for r in got.collect()}
    met = (a != 0).astype(int) @ (b != 0).astype(int) > 0  # sums that are zero stay
    assert rows == {(i, j): int(v) for (i, j), v in np.ndenumerate(a @ b) if met[i, j]}
    assert matrix.product(frame(spark, a[:1] * 0, whole=True), frame(spark, b, whole=True)).count() == 0


@pytest.mark.parametrize("summed", [50, 10**6])
def test_sparse_products_in_parts(monkeypatch, summed):
    import pyarrow as pa

    rng = np.random.default_rng(2)
    monkeypatch.setattr(matrix, "SUMMED", summed)
    k, o, v = rng.integers(0, 4000, 900), rng.integers(0, 5000, 900), rng.normal(size=900)
    sides = [[pa.array(k[s]), pa.array(o[s]), pa.array(v[s])] for s in (slice(0, 450), slice(450, 900))]
    left, right = (x[1].unique().to_pylist() for x in sides)
    got = {}
    for i, j, w in matrix._products(*sides):
        for x, y, z in zip(i, j, w, strict=True):
            got[left[x], right[y]] = got.get((left[x], right[y]), 0) + z
    want = {}
    for x in range(450):
        for y in range(450, 900):
            if k[x] == k[y]:
                want[o[x], o[y]] = want.get((o[x], o[y]), 0) + v[x] * v[y]
    assert got.keys() == want.keys() and all(got[e] == pytest.approx(want[e]) for e in want)


def test_sums_of_a_group_are_whole(monkeypatch):
    """A row's products are summed before they leave the group: each cell comes once, however few are summed at once."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    monkeypatch.setattr(matrix, "SUMMED", 3000)
    x, y = (np.flatnonzero(rng.random(300 * 3000) < 0.01) for _ in range(2))
    cells = [z.tolist() for z in ((x % 3000), (x // 3000), (y % 3000), (y // 3000))]
    sides = [[pa.array(cells[0]), pa.array(cells[1]), pa.array(np.ones(len(x)))], [pa.array(cells[2]), pa.array(cells[3]), pa.array(np.ones(len(y)))]]
    got = matrix._products(*sides)
    keys = np.concatenate([i * 3000 + j for i, j, _ in got])
    assert len(got) > 3 and len(np.unique(keys)) == len(keys)


def test_a_row_of_more_products_than_are_summed_at_once(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(matrix, "SUMMED", 500)
    k, j = np.divmod(np.arange(4000 * 500), 500)
    some = (k + 7 * j) % 100 == 0
    sides = [[pa.array(np.arange(4000)), pa.array(np.zeros(4000, int)), pa.array(np.ones(4000))], [pa.array(k[some]), pa.array(j[some]), pa.array(np.ones(some.sum()))]]
    got = matrix._products(*sides)
    assert len(np.unique(np.concatenate([y for _, y, _ in got]))) == sum(len(y) for _, y, _ in got) == 500
    assert sum(v.sum() for *_, v in got) == some.sum()


def test_products_are_not_shuffled_where_rows_are_whole(spark):
    a = frame(spark, np.ones((6, 6)))
    plan = matrix.product(a, a)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("FlatMapCoGroups")[0]


def test_product_with_a_long_row_and_many_columns(spark, monkeypatch):
    rng = np.random.default_rng(4)
    a, b = (rng.integers(1, 4, (40, 40)) * (rng.random((40, 40)) < 0.1) for _ in range(2))
    a[3, :], b[:, 5], b[9, :] = 2, 1, 3
    monkeypatch.setattr(matrix, "PIECE", 20)
    monkeypatch.setattr(matrix, "GROUP", 15)
    rows = {(r.i, r.j): r.v for r in matrix.product(frame(spark, a, whole=True), frame(spark, b, whole=True)).collect()}
    met = (a != 0).astype(int) @ (b != 0).astype(int) > 0
    assert rows == {(i, j): int(v) for (i, j), v in np.ndenumerate(a @ b) if met[i, j]}


def test_a_walk_leaves_no_tables_of_its_products(spark, monkeypatch):
    from quillon.sources import tables

    p = tables.stored(spark.createDataFrame([(i, (i + d) % 6, 0.5) for i in range(6) for d in (1, 2)], "i long, j long, v double"))
    held, real = [], matrix.product
    monkeypatch.setattr(matrix, "product", lambda a, b, h: (real(a, b, h), held.extend(x for y in h for x in y.inputFiles()))[0])
    assert matrix.walked(p, spark.createDataFrame([(0,), (3,)], "contig long"), 0.5, 2, tolerance=0.0).count() == 10
    assert held and not any(os.path.exists(x.removeprefix("file:").replace("//", "/")) for x in held)


def test_newton_steps_need_fewer_products(spark):
    """A chain with weights over four decades, which the iteration by roots balances slowly."""
    n = 10
    a = np.diag(np.full(n, 1e-3)) + np.diag(10.0 ** np.linspace(-2, 2, n - 1), 1)
    a[0, 0] = 0.0  # a one stands there for the scaling only
    x, scaled, products = matrix.newton_balanced(frame(spark, a, upper=True), 1e-6)
    full = a + np.triu(a, 1).T
    work = full + np.diag((np.diag(full) == 0).astype(float))
    f = np.array([r.x for r in x.orderBy("contig").collect()])
    assert np.abs(f * (work @ f) - 1).max() < 1e-6
    assert dense_of(scaled, n) == pytest.approx(np.triu(f[:, None] * full * f), rel=1e-9)
    y, rounds = np.ones(n), 0
    while np.linalg.norm(1 - y * (work @ y)) > 1e-6 and rounds < 5000:
        y, rounds = np.sqrt(y / (work @ y)), rounds + 1
    assert products < rounds
    none = matrix.newton_balanced(spark.createDataFrame([], "i long, j long, v double"))
    assert none[0].count() == 0 and none[1].count() == 0


def dense_walk(p, starts, r, steps, percent, tolerance, steady=5):
    """The walk as dense matrices: the change before the cut, the cut before the next step, a count of small changes."""
    unit = np.zeros((len(starts), len(p)))
    unit[np.arange(len(starts)), starts] = 1
    q, before, still = unit, 0.0, 0
    for step in range(steps):
        new = np.round((1 - r) * q @ p + r * unit, 12)
        gap, q = np.linalg.norm(q - new), new
        if percent is not None and step:
            cut = np.percentile(q[q != 0], percent)
            q = np.where(q > cut, q, 0.0) if cut > 0 else q
        if tolerance and step < steps - 1:
            still += abs(gap - before) < 1e-3
            if gap < tolerance or still == steady:
                break
            before = gap
    return q, step + 1


@pytest.mark.parametrize(("percent", "tolerance", "steps"), [(70.0, 0.01, 60), (None, 1e-4, 60), (50.0, 0.0, 3)])
def test_walk_in_full(spark, percent, tolerance, steps):
    rng = np.random.default_rng(8)
    n, starts = 16, [0, 3, 9]
    a = np.triu(rng.integers(1, 9, (n, n)) * (rng.random((n, n)) < 0.4), 1)
    a[:, 5] = a[5, :] = 0
    full = (a + a.T).astype(float)
    b = full + np.diag((full.sum(0) == 0).astype(float))
    p = b / b.sum(1, keepdims=True)
    vertices = spark.createDataFrame([(k,) for k in range(n)], "contig long")
    own = spark.createDataFrame([(k,) for k in starts], "contig long")
    stochastic = matrix.row_stochastic(frame(spark, full), vertices)
    assert dense_of(stochastic, n) == pytest.approx(p)
    got = dense_of(matrix.walked(stochastic, own, 0.5, steps, percent, tolerance), n)[starts]
    want, _ = dense_walk(p, starts, 0.5, steps, percent, tolerance)
    assert got == pytest.approx(want, abs=1e-9) and (got > 0).sum() == (want > 0).sum()


def test_imputed_contacts_of_start_contigs(spark):
    rng = np.random.default_rng(9)
    a = np.triu(rng.integers(1, 9, (10, 10)), 0).astype(float)
    full = a + np.triu(a, 1).T
    off = full - np.diag(np.diag(full))
    vertices = spark.createDataFrame([(k,) for k in range(10)], "contig long")
    got = dense_of(jobs.imputed(frame(spark, a, upper=True), vertices, vertices.where("contig < 4"), 0.5, 60.0, 0.01), 10)
    q, _ = dense_walk(off / off.sum(1, keepdims=True), [0, 1, 2, 3], 0.5, 500, 60.0, 0.01)
    e = q[:, :4] + q[:, :4].T
    d = np.where(e.sum(0) == 0, 1, e.sum(0))
    assert got[:4, :4] == pytest.approx(e / np.sqrt(d[:, None] * d), abs=1e-9) and got[4:].sum() == got[:, 4:].sum() == 0


def test_tips_and_tensors(spark):
    df = spark.createDataFrame([(p, n) for n in (10, 7, 3) for p in range(n)], "p int, n int")
    got = {(r.n, r.p): r.t for r in df.select("p", "n", matrix.tip(F.col("p"), F.col("n"), 4).alias("t")).collect()}
    assert [got[10, p] for p in range(10)] == [0] * 4 + [None] * 2 + [1] * 4
    assert [got[7, p] for p in range(7)] == [0] * 3 + [None] + [1] * 3 and [got[3, p] for p in range(3)] == [0, None, 1]
    pairs = [(1, 2, 0, 1), (2, 1, 1, 0), (1, 1, 1, 0), (1, 1, 0, 1), (2, 2, 1, 1), (1, 2, None, 0), (2, 1, 0, 0)]
    t = matrix.tip_counts(spark.createDataFrame(pairs, "a long, b long, tip_a int, tip_b int"))
    rows = sorted(map(tuple, t.collect()))
    assert rows == [(1, 1, 0, 1, 2), (1, 2, 0, 0, 1), (1, 2, 0, 1, 2), (2, 2, 1, 1, 1)]
    full = sorted(map(tuple, matrix.tensor_symmetric(t).collect()))
    assert full == sorted([*rows, (2, 1, 0, 0, 1), (2, 1, 1, 0, 2)])
    x, scaled = matrix.tensor_balanced(t, 1e-9)
    f = {r.contig: r.x for r in x.collect()}
    assert scaled.columns == ["i", "j", "k", "l", "v"]
    m = np.array([[2.0, 3.0], [3.0, 1.0]])
    assert np.array([f[1], f[2]]) * (m @ [f[1], f[2]]) == pytest.approx([1, 1], abs=1e-8)
    assert {tuple(r)[:4]: r.v for r in scaled.collect()} == pytest.approx({(i, j, k, l): f[i] * v * f[j] for i, j, k, l, v in rows})


def test_twins_keep_their_columns(spark):
    rows = spark.createDataFrame([("t", 1, 10, "a"), ("t", 2, 11, "b"), ("t", 100, 110, "c")], "target string, start int, end int, hit string")
    got = hits.without_twins(rows)
    assert got.columns == rows.columns and [r.hit for r in got.orderBy("start").collect()] == ["a", "c"]


def test_mixture_starts_as_the_data_lie(spark):
    """No step: means, sample deviations of at least one and shares of the lower and the upper values; large values keep digits."""
    x = [10.0, 11.0, 12.0, 13.0, 14.0, 15.0, 16.0, 17.0, 40.0, 50.0]
    got = models.gaussian_mixture(spark.createDataFrame([(v + 1e9,) for v in x], "x double"), "x", steps=0)
    assert (got["mean_n"] - 1e9, got["std_n"], got["mean_c"] - 1e9, got["std_c"], got["share_c"]) == pytest.approx((13.5, np.std(x[:8], ddof=1), 45.0, np.std(x[8:], ddof=1), 0.2), rel=1e-6)
    one = models.gaussian_mixture(spark.createDataFrame([(v + 1e9,) for v in x], "x double"), "x", steps=30, tolerance=0.0)
    assert one["std_n"] == pytest.approx(np.std(x[:8]), rel=1e-3) and one["std_c"] > 1
    same = models.gaussian_mixture(spark.createDataFrame([(5.0,)] * 9, "x double"), "x")
    assert same["mean_n"] == 5.0 and same["share_c"] == 0.0


@pytest.mark.parametrize(("percent", "tolerance", "small"), [(80.0, 0.0, False), (80.0, 1e-4, True), (50.0, 0.01, True)])
def test_walk_by_whole_rows_is_the_walk_by_products(spark, monkeypatch, percent, tolerance, small):
    """Groups of few rows and few columns, with tables of sums and without, give the rows that products of entries give."""
    rng = np.random.default_rng(3)
    rows = {(int(min(i, j)), int(max(i, j))): float(v) for i, j, v in zip(*rng.integers(0, 30, (2, 160)), rng.integers(1, 9, 160), strict=True)}
    e = spark.createDataFrame([(7 * i, 7 * j, v) for (i, j), v in rows.items()], "i long, j long, v double")
    p = stored(matrix.row_stochastic(contacts.symmetric(e), spark.createDataFrame([(7 * i,) for i in range(31)], "contig long")))
    starts = spark.createDataFrame([(7 * i,) for i in (0, 4, 9, 13, 30)], "contig long")
    if small:
        for name, n in (("WALKED", 20), ("MET", 40), ("CELLS", 12)):
            monkeypatch.setattr(matrix, name, n)
    one = {(r.i, r.j): r.v for r in matrix.walked(p, starts, 0.5, 5, percent, tolerance).collect()}
    other = {(r.i, r.j): r.v for r in matrix.walked(p, starts, 0.5, 5, percent, tolerance, longest=0).collect()}
    assert one == pytest.approx(other, abs=1e-11) and one


def test_percentile_from_bucket_counts(spark):
    from quillon.operators.quantiles import bucket_of, percentile_of_buckets

    x = np.round(np.random.default_rng(5).lognormal(-6, 1, 3000), 6)
    seen = [(int(b), int(n)) for b, n in zip(*np.unique(bucket_of(x), return_counts=True), strict=True)]
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    for share in (0.0, 0.333, 0.8, 1.0):
        assert percentile_of_buckets(df, seen, share) == pytest.approx(np.quantile(x, share), rel=1e-15)
    cut = float(np.quantile(x, 0.8))
    # with the low values left out it is the same, unless it may be one of them
    assert percentile_of_buckets(df.where(f"v > {cut * 0.9}"), seen, 0.8, cut * 0.9) == pytest.approx(cut, rel=1e-15)
    assert percentile_of_buckets(df.where(f"v > {cut}"), seen, 0.8, cut) is None
    assert percentile_of_buckets(df, [], 0.5) is None
    negative = [(int(b), int(n)) for b, n in zip(*np.unique(bucket_of(-x), return_counts=True), strict=True)]
    assert negative == sorted(negative) and percentile_of_buckets(df, negative, 0.5) is None


def test_sides_of_a_product_are_sent_as_lists(spark):
    """What goes to many groups is a row of lists, not a row for each entry."""
    a, held = frame(spark, np.arange(1.0, 37.0).reshape(6, 6)), []
    rows = {(r.i, r.j): r.v for r in matrix.product(a, a, held).collect()}
    want = np.arange(1.0, 37.0).reshape(6, 6) @ np.arange(1.0, 37.0).reshape(6, 6)
    assert rows == {e: pytest.approx(v) for e, v in np.ndenumerate(want)}
    assert [dict(d.dtypes)["v"] for d in held[:2]] == ["array<double>", "array<double>"]
