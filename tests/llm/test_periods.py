"""Periodic runs against a scan of every period, and the LCE structures against direct comparison."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillon.llm import op13_periods
from quillon.llm.op13_periods import Extensions, Minima, altered, collapsed, found, runs_of

from . import brute


def scanned(c, least=12):
    """Stretches of equal words a period apart, for each period; the smallest period of each stretch."""
    n, out = len(c), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            s = i
            while i + p < n and c[i] == c[i + p]:
                i += 1
            if i - s + p >= max(least, 2 * p):
                out.setdefault((s, i - s + p), p)
            i += 1
    return sorted(((s, m, p) for (s, m), p in out.items()), key=lambda r: (r[0], r[2]))


def listed(c, least=12):
    return [tuple(r) for r in runs_of(np.array(c, np.int64), least).tolist()]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(4, 14))
def test_small_alphabets(c, least):
    assert listed(c, least) == scanned(c, least)


def test_repeated_stretches():
    rng = random.Random(5)
    for _ in range(150):
        n, k = rng.randrange(12, 300), rng.choice((1, 2, 3, 8, 50))
        c = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randrange(3)):
            a, p = rng.randrange(n), rng.randrange(1, 1 + n // 3)
            b = rng.randrange(a, n) + 1
            c[a:b] = [c[a + (i - a) % p] if a + (i - a) % p < n else 0 for i in range(a, b)]
        assert listed(c) == scanned(c)


def test_batches_of_pairs(monkeypatch):
    c = [0] * 100 + [1, 2] * 40 + [0] * 50
    whole = listed(c)
    monkeypatch.setattr(op13_periods, "MOST", 7)
    assert listed(c) == whole == scanned(c)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 100])
def test_extensions_and_minima(n):
    rng = np.random.default_rng(n)
    c = rng.integers(0, 2, n)
    e = Extensions(c)
    for _ in range(60):
        i, j = sorted(rng.integers(0, n + 1, 2))
        if i < j:
            k = 0
            while j + k < n and c[i + k] == c[j + k]:
                k += 1
            assert e.of(np.array([i]), np.array([j]))[0] == k
    values = rng.integers(0, 99, n).astype(np.int32)
    m = Minima(values)
    lo, hi = np.sort(rng.integers(0, n, (2, 200)), axis=0)
    assert (m.of(lo, hi) == [values[a : b + 1].min() for a, b in zip(lo, hi, strict=True)]).all()


def test_collapsed_text():
    words = [b"x", *[b"a", b"b"] * 7, b"y"]
    runs = runs_of(np.array([0, *[1, 2] * 7, 3]))
    assert runs.tolist() == [[1, 14, 2]] and collapsed(words, runs) == b"x a b y"


def test_altered_by_id():
    words = [b"%d" % k for k in range(50)]
    changed = {i for i in range(400) if altered(i, words) != words}
    assert 20 < len(changed) < 70 and altered(None, words) == words and altered(3, []) == []
    for i in changed:
        new = altered(i, words)
        assert len(new) == 50 and set(new) <= set(words)


LONG = "w x y " * 30000


def test_odd_rows(spark):
    rows = [(None, "a " * 20), (1, None), (2, ""), (3, " \n\t "), (4, "a b " * 6), (4, "a b " * 6), (4, "a b " * 5), (5, LONG), (6, "aa " * 12 + "bb " * 12)]
    docs = spark.createDataFrame([(i, t, 1, 2, [3], "x") for i, t in rows], "doc_id long, text string, n_runs long, start long, runs array<int>, collapsed string")
    got = {}
    for r in found(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    assert (got[None][0].n_runs, got[None][0].length, got[None][0].period, got[None][0].collapsed) == (1, 20, 1, "a")
    for i in (1, 2, 3):
        assert got[i][0].n_runs == 0 and got[i][0].start is None and got[i][0].collapsed == ""
    assert sorted(r.n_runs for r in got[4]) == [0, 1, 1]
    assert (got[5][0].n_runs, got[5][0].length, got[5][0].period, got[5][0].exponent_milli) == (1, 90000, 3, 30_000_000)
    assert (got[6][0].n_runs, got[6][0].start, got[6][0].collapsed) == (2, 0, "aa bb")  # a tie: the first
    assert found(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        found(docs, least=3)


def test_whole_table_against_scan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in found(docs, repeat_some=True).collect()}
    some = 0
    for i, t in ((r.doc_id, r.text) for r in docs.collect()):
        words = altered(i, [w.encode() for w in brute.words(t, lower=False)])
        if len(words) < 2500:
            number: dict = {}
            want = scanned([number.setdefault(w, len(number)) for w in words])
            assert got[i] == want
            some += bool(want)
    assert some > 10
