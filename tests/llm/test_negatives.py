"""Hard negatives against all pairs."""

import math
import random

import numpy as np
import pytest

from quillon.llm import op12_negatives
from quillon.llm.op12_negatives import LEAST, Tree, mined


def plain(rows, every=50, positives=5, negatives=3, low=50, high=95):
    """rows: id, label, components."""
    own = sorted({(i, y, tuple(min(max(math.floor(256 * x), -(1 << 26)), 1 << 26) for x in v)) for i, y, v in rows if None not in (i, y, v) and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, y, v in own:
        if i % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j, z) for j, z, w in own if j != i)
        for s, j, _ in [x for x in scores if x[2] == y][:positives]:
            far = [(-t, k) for t, k, z in scores if z != y and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(i, j, rank, k, -s, t) for rank, (t, k) in enumerate(far, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, y, v, 1, "x", 2) for i, y, v in rows], "vec_id long, label int, embedding array<float>, score long, rank string, block int")


def found(spark, rows, **more):
    return sorted(map(tuple, mined(frame(spark, rows), **more).collect()))


def rounded(rows):
    return [(i, y, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, y, v in rows]


def test_against_all_pairs(spark, monkeypatch):
    """Several blocks and chunks, clustered vectors (balls are left out) and many ties."""
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (6, 8))
    rows = [(i, int(rng.integers(4)), (centres[i % 6] + rng.normal(0, 0.3, 8)).tolist()) for i in range(700)]
    rows += [(700 + i, i % 3, [0.5] * 8) for i in range(300)]
    rows = rounded(rows)
    monkeypatch.setattr(op12_negatives, "ROWS", 180)
    monkeypatch.setattr(op12_negatives, "ANCHORS", 7)
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows, every=100, positives=2, negatives=4, low=10, high=80) == plain(rows, 100, 2, 4, 10, 80)


def test_balls_are_left_out():
    """In clustered data most leaves are never looked at, and the result is that of all rows."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 4000, (40, 16))
    whole = np.round(np.repeat(centres, 100, axis=0) + rng.normal(0, 30, (4000, 16))).astype(np.int32)
    ids, labels = np.arange(4000), rng.integers(0, 3, 4000)
    tree = Tree.grown(ids, labels, whole)
    q = whole[:20]
    best, who = tree.search(ids[:20], labels[:20], q, np.full((20, 1), LEAST + 1), np.full((20, 1), 1 << 62), 5, True)
    assert 0 < tree.looked < 0.35 * 4000 * 20
    scores = q.astype(np.int64) @ whole.T.astype(np.int64)
    for a in range(20):
        want = sorted((-scores[a, b], b) for b in range(4000) if b != a and labels[b] == labels[a])[:5]
        assert [(-s, i) for s, i in zip(best[a, 0], who[a, 0], strict=True)] == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (None, 1, [1.0, 0.0]), (0, None, [1.0, 0.0]), (0, 1, None), (50, 1, [nan, 1.0]), (50, 1, [inf, 1.0]), (50, 1, [None, 1.0]),
        (100, 1, [1.0, 0.5]), (100, 1, [1.0, 0.5]), (100, 1, [0.9, 0.5]), (101, 1, [1.0, 0.25]), (101, 1, [1.0, 0.25]), (102, 2, [0.6, 0.5]),
        (103, 2, [0.6, 0.5]), (104, 2, [0.7]), (105, 2, []), (150, 3, [1.0, 1.0]), (200, 4, [-1.0, 0.0]), (201, 4, [1.0, 0.0]), (202, 5, [-0.6, 0.0]),
        (250, 6, [1e30, 1.0]), (251, 6, [1e30, 1.0]), (252, 7, [6e29, -1e30]), (300, 8, []), (301, 8, []),
    ]
    rows = rounded(rows)
    got = found(spark, rows)
    assert got == plain(rows) and any(r[0] == 100 for r in got) and not any(r[0] in (150, 200) for r in got)
    assert found(spark, []) == []
    assert found(spark, [(i, None, [1.0]) for i in range(9)]) == []


@pytest.mark.parametrize("share", [1, 50, 95, 100])
def test_window_ends(spark, share):
    rng = random.Random(share)
    scores = [rng.randrange(-10_000, 10_000) for _ in range(60)] + [0, 1, -1, 99, 100, 101]
    df = spark.createDataFrame([(s,) for s in scores], "score long")
    for up in (True, False):
        got = [r[0] for r in df.selectExpr(op12_negatives.ends(share, up)).collect()]
        assert got == [-(-s * share // 100) if up else s * share // 100 for s in scores]
