"""Trimming against plain versions, read by read."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.operators import reads

ADAPTERS = ["AGATCGGAAGAGCACACGTCTGAACTCCAGTCA", "AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT"]
TURN = str.maketrans("ACGT", "TGCA")


def differ(a, b):
    return sum(x != y for x, y in zip(a, b, strict=True))


def plain_start(seq, k=23, least=11):
    both = [s for a in ADAPTERS for s in (a, a.translate(TURN)[::-1])]
    mers = [s[i : i + k] for s in both for i in range(len(s) - k + 1)]
    for i in range(len(seq) - k + 1):
        if set(seq[i : i + k]) <= set("ACGT") and any(differ(seq[i : i + k], m) <= 1 for m in mers):
            return i
    for n in range(k - 1, least - 1, -1):
        if len(seq) >= n and set(seq[-n:]) <= set("ACGT") and any(differ(seq[-n:], s[:n]) <= 1 for s in both):
            return len(seq) - n
    return len(seq)


def plain_quality(qual, least=10):
    total = low = cut = 0
    for n, c in enumerate(reversed(qual), 1):
        total += ord(c) - 33 - least
        if total < low:
            low, cut = total, n
    return len(qual) - cut


def made(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        seq = "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 150)))
        kind = rng.random()
        if kind < 0.6:
            a = rng.choice(ADAPTERS)
            a = a if rng.random() < 0.7 else a.translate(TURN)[::-1]
            a = list(a[: rng.randrange(5, len(a) + 1)])
            for _ in range(rng.randrange(3)):
                a[rng.randrange(len(a))] = rng.choice("ACGTN")
            seq += "".join(a) + ("".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 9))) if kind < 0.2 else "")
        out.append(seq)
    return out


def test_adapter_starts():
    index = reads.adapter_index(ADAPTERS)
    seqs = made(600, 1) + ["", "A", "N" * 60, "A" * 11]
    got = reads.adapter_starts([*seqs, None], index)
    assert got.tolist() == [*map(plain_start, seqs), 0]
    assert sum(g < len(s) for g, s in zip(got, seqs, strict=False)) > 150
    assert reads.adapter_starts(["ACGT" * 20], reads.adapter_index([])).tolist() == [80]
    with pytest.raises(ValueError, match="too large"):
        reads.adapter_index(["A" * 400_000])
    assert set(reads.adapter_index(["ACGTA"], 5, 3, mismatch=False)[5].tolist()) == {0b0001101100, 0b1100011011}


def test_quality_from_the_right(spark):
    rng = random.Random(2)
    quals = ["".join(chr(33 + rng.choice((2, 8, 12, 30, 40))) for _ in range(rng.randrange(0, 60))) for _ in range(200)] + [""]
    df = spark.createDataFrame([(q,) for q in quals], "q string")
    assert [r.n for r in df.select("q", reads.kept_by_quality(F.col("q")).alias("n")).collect()] == [plain_quality(q) for q in quals]


def test_trimmed_reads(spark):
    rng = random.Random(3)
    rows = [(f"r{i}", s, "".join(chr(33 + (rng.choice((2, 35)) if j > 100 else 38)) for j in range(len(s)))) for i, s in enumerate(made(300, 4))] + [("none", None, None)]
    got = {r.qname: (r.seq, r.qual) for r in reads.trimmed(spark.createDataFrame(rows, "qname string, seq string, qual string").repartition(3), ADAPTERS).collect()}
    want = {}
    for name, s, q in rows:
        s, q = (s or "")[: len(s or "") // 5 * 5], (q or "")[: len(s or "") // 5 * 5]
        end = plain_start(s)
        s, q = s[10:end], q[10:end]
        n = plain_quality(q)
        if n >= 50:
            want[name] = (s[:n], q[:n])
    assert got == want and len(want) > 100


def test_duplicates(spark):
    rows = [("b", "AC", "GG"), ("a", "AC", "GG"), ("c", "AC", "GT"), ("d", "TT", None)]
    df = spark.createDataFrame(rows, "qname string, one string, two string")
    assert sorted(r.qname for r in reads.without_duplicates(df, "one", "two").collect()) == ["a", "c", "d"]
    assert np.array(reads.without_duplicates(df.limit(0), "one").collect()).size == 0
