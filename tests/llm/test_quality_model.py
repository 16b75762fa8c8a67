"""The quality classifier: held-out accuracy, and each step of the fit against a plain version."""

import math
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from quillon.llm import op11_quality
from quillon.llm.op11_quality import NAMES, Cosines, equations, held_out, isotonic, measured, scored, solved, statistics

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in scored(docs, labels).collect()}
    assert len(got) == docs.count()
    known = {r.doc_id: r.quality for r in labels.collect()}
    own = [(known[i], r.score, r.predicted) for i, r in got.items() if r.held_out and i in known]
    y, s, p = map(np.array, zip(*own, strict=True))
    rank = s.argsort().argsort()
    assert (rank[y == 1].mean() - rank[y == 0].mean()) / len(y) + 0.5 > 0.9
    assert (p[y == 1] == 0).mean() < 0.06 and (p[y == 0] == 0).mean() > 0.6
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())


def test_held_out_labels_are_not_learned(spark):
    """Turning the labels of all rows that are held out changes no score."""
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - quality else quality end quality")
    score = lambda y: [r.score for r in scored(docs, y).orderBy("doc_id").collect()]
    assert score(labels) == pytest.approx(score(turned), abs=1e-9)


def test_equations_are_sums_over_partitions(spark):
    rng = np.random.default_rng(1)
    x, y, half = rng.normal(size=(500, len(NAMES))), rng.integers(0, 2, 500).astype(float), rng.integers(0, 2, 500)
    train = spark.createDataFrame([(a.tolist(), float(b), int(c)) for a, b, c in zip(x, y, half, strict=True)], "x array<double>, y double, half int").repartition(7)
    cosines = Cosines(x.mean(0), x.std(0), 32)
    sums = equations(train, cosines)
    for k in (0, 1):
        z = cosines.of(x[half == k])
        assert np.allclose(sums[k, :, :-1], z.T @ z) and np.allclose(sums[k, :, -1], z.T @ y[half == k])
    z = cosines.of(x)
    assert np.allclose(solved(sums.sum(0), 1e-3), np.linalg.solve(z.T @ z + np.diag([0.5] * 32 + [1e-9]), z.T @ y))


def test_cosines_approximate_the_kernel():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, len(NAMES)))
    z = Cosines(np.zeros(len(NAMES)), np.ones(len(NAMES)), 20_000).of(x)[:, :-1]
    width = op11_quality.WIDTH * math.sqrt(len(NAMES))
    held = np.clip(x, -op11_quality.HELD, op11_quality.HELD)
    kernel = np.exp(-((held[:, None] - held[None]) ** 2).sum(-1) / (2 * width**2))
    assert np.abs(z @ z.T - kernel).max() < 0.05


def test_isotonic_is_the_closest_rising_curve():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = rng.integers(1, 30)
        count = rng.integers(1, 9, n).astype(float)
        total = rng.binomial(count.astype(int), rng.random(n)).astype(float)
        knots, means = isotonic(np.arange(n, dtype=float), total, count)
        assert (np.diff(means) > 0).all() and (np.diff(knots) > 0).all()
        # the min-max formula of isotonic regression
        mean = lambda a, b: total[a : b + 1].sum() / count[a : b + 1].sum()
        want = sorted({round(max(min(mean(a, b) for b in range(k, n)) for a in range(k + 1)), 12) for k in range(n)})
        assert np.allclose(sorted({round(m, 12) for m in means}), want)


def test_statistics():
    own = dict(zip(NAMES, statistics("Ab ab ab ##\nAb ab ab ##\n\n9 X!"), strict=True))
    assert own["log_words"] == math.log1p(10) and own["equal_neighbours"] == pytest.approx(0.2) and own["equal_lines"] == pytest.approx(1 / 3)
    assert own["symbols"] == pytest.approx(0.4) and own["calls"] == pytest.approx(0.1) and own["commonest_word"] == pytest.approx(0.4)
    assert own["upper"] == pytest.approx(3 / 13) and own["longest_repeat"] == pytest.approx(math.log1p(2))
    assert statistics(None) == statistics("") == [0.0] * len(NAMES) and statistics(" \n")[1:] == [0.0] * (len(NAMES) - 1)
    assert all(math.isfinite(v) for t in ("a", "é" * 3000, "w " * 100_000, "\x00", "#" * 5000) for v in statistics(t))


def test_odd_rows(spark):
    rows = [(None, "a b c"), (1, None), (2, ""), (3, " \n"), (4, "some words"), (4, "some words"), (4, "other"), (5, "long text " * 50_000)]
    docs = spark.createDataFrame([(i, t, 0.5, 1, [1.0], 2) for i, t in rows], "doc_id long, text string, score double, y int, x array<double>, half int")
    labels = spark.createDataFrame([(4, 1, 3), (4, 0, 3), (5, 1, 3), (None, 1, 3), (3, None, 3), (2, 7, 3), (2, 0, 3)], "doc_id long, quality int, x int")
    got = scored(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and math.isfinite(r.score) for r in got)
    assert all(r.score == 0.5 and r.predicted == 1 for r in scored(docs, labels.where("doc_id > 100")).collect())
    assert scored(docs.limit(0), labels).count() == 0
    alone = scored(docs, labels.where("quality = 1 and doc_id = 5")).collect()  # one kind of label only
    assert all(0 <= r.score <= 1 for r in alone)
    assert [r.held_out for r in measured(docs.where("doc_id = 4")).collect()] == [zlib.crc32(b"4") % 3 == 1] * 3
    assert docs.select(held_out(docs.doc_id).alias("h")).where("h is null").count() == 0
