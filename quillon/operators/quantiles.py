"""Exact percentiles without a task that holds all values: brackets around ranks, and ranks over range partitions.

A percentile between two values is interpolated linearly: position share * (n - 1) in the ascending order. Nulls do not
count; NaN is the largest value.
"""

from __future__ import annotations

from collections.abc import Iterable
from math import floor

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values in a bracket that the driver sorts; more are narrowed down by a further pass.
MOST = 10_000
#: Accuracy of the sketch that proposes brackets: it only decides how many passes are needed, never the result.
ACCURACY = 2_000


def _between(low: float, high: float, low_in: bool, high_in: bool) -> Column:
    v = F.col("v")
    return (v >= F.lit(low) if low_in else v > F.lit(low)) & (v <= F.lit(high) if high_in else v < F.lit(high))


def _at_ranks(values: DataFrame, ranks: list[int], n: int, low: float, high: float, most: int) -> dict[int, float]:
    """The values at those ranks (from 0). Each rank has a bracket and the number of values below it; a pass sketches the
    values of all brackets, proposes smaller ones, and counts exactly on which side of a proposal each rank lies."""
    # bracket: low, high, whether each end belongs to it, values below, values inside
    open_ = {r: (low, high, True, True, 0, n) for r in ranks}
    found: dict[int, float] = {}
    while open_:
        for r, b in list(open_.items()):
            if b[0] == b[1] or b[0] != b[0]:
                found[r] = b[0]
                del open_[r]
        small = {b for b in open_.values() if b[5] <= most}
        for b in small:
            rows = sorted((x.v for x in values.where(_between(*b[:4])).select("v").collect()), key=lambda x: (x != x, x))
            for r in [r for r, own in open_.items() if own == b]:
                found[r] = rows[r - b[4]]
                del open_[r]
        if not open_:
            break
        brackets = sorted(set(open_.values()), key=str)
        asked = {b: [min(1.0, max(0.0, (r - b[4]) / b[5] + d / ACCURACY)) for r, own in sorted(open_.items()) if own == b for d in (-2, 2)] for b in brackets}
        sketches = [F.percentile_approx(F.when(_between(*b[:4]), F.col("v")), [float(s) for s in asked[b]], ACCURACY) for b in brackets]
        proposed = dict(zip(brackets, values.agg(*[s.alias(f"s{k}") for k, s in enumerate(sketches)]).first(), strict=True))
        seen = [float(x) for b in brackets for x in proposed[b]]
        cuts = sorted({x for x in seen if x == x}) + [x for x in seen if x != x][:1]  # NaN is the largest
        counted = values.agg(
            *[F.count_if(F.col("v") < F.lit(c)).alias(f"l{k}") for k, c in enumerate(cuts)], *[F.count_if(F.col("v") <= F.lit(c)).alias(f"u{k}") for k, c in enumerate(cuts)]
        ).first()
        for r, (lo, hi, lo_in, hi_in, below, inside) in list(open_.items()):
            end = below + inside
            for k, c in enumerate(cuts):
                under, upto = counted[f"l{k}"], counted[f"u{k}"]
                if under <= r < upto:
                    found[r] = c
                    del open_[r]
                    break
                if upto <= r and (c > lo or (c == lo and lo_in)):
                    lo, lo_in, below = c, False, upto
                elif under > r and (c < hi or (c == hi and hi_in) or (hi != hi and (hi_in or c == c))):
                    hi, hi_in, end = c, False, under
                    break
            else:
                open_[r] = (lo, hi, lo_in, hi_in, below, end - below)
                continue
            if r in open_:
                open_[r] = (lo, hi, lo_in, hi_in, below, end - below)
    return found


def percentiles(df: DataFrame, column: str, shares: Iterable[float], most: int = MOST) -> list[float | None]:
    """The percentiles of a column (shares from 0 to 1), None without values.

    df is read a few times (three passes for a billion distinct values), so pass a stored table; no pass shuffles more
    than a sketch and a few counts from each task, and the driver sorts `most` values of a bracket at most.
    """
    shares = list(shares)
    if any(not 0 <= s <= 1 for s in shares):
        raise ValueError("a share is from 0 to 1")
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    first = values.agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    if not first.n:
        return [None] * len(shares)
    places = [s * (first.n - 1) for s in shares]
    ranks = sorted({r for p in places for r in (floor(p), min(floor(p) + 1, first.n - 1))})
    at = _at_ranks(values, ranks, first.n, first.low, first.high, most)
    out: list[float | None] = []
    for p in places:
        lower, upper = at[floor(p)], at[min(floor(p) + 1, first.n - 1)]
        part = p - floor(p)
        out.append(lower if part == 0 or lower == upper else (1 - part) * lower + part * upper)
    return out


def bucket_of(x: float | np.ndarray) -> np.ndarray:
    """Numbers of narrow ranges of values other than zero, in their order: the leading bits, 256 for each power of two."""
    x = np.asarray(x, np.float64)
    leading = np.abs(x).view(np.int64) >> 44
    return np.where(x < 0, -1 - leading, leading)


def percentile_of_buckets(values: DataFrame, seen: list[tuple[int, int]], share: float, low: float = float("-inf")) -> float | None:
    """The percentile of values (v), of which `seen` tells how many each bucket has, in order: only its own bucket is read.
    None if it, or what it is interpolated with, may not be above zero or not be above low, up to which values may be left out."""
    ends = np.cumsum([0, *(n for _, n in seen)])
    place = share * (ends[-1] - 1)
    ranks = [floor(place), min(floor(place) + 1, ends[-1] - 1)] if ends[-1] else []
    first, last = (int(np.searchsorted(ends, r, side="right")) - 1 for r in ranks) if ranks else (0, 0)
    if not ranks or seen[first][0] < 0:
        return None
    least, most = (np.array([b << 44], np.int64).view(np.float64)[0] for b in (seen[first][0], seen[last][0] + 1))
    if least <= low:
        return None
    most, below, inside = float(np.nextafter(most, 0)), int(ends[first]), int(ends[last + 1] - ends[first])
    own = values.where((F.col("v") >= F.lit(float(least))) & (F.col("v") <= F.lit(most)))
    at = _at_ranks(own, sorted({int(r) - below for r in ranks}), inside, float(least), most, MOST)
    lower, upper = (at[int(r) - below] for r in ranks)
    part = place - floor(place)
    return float(lower if part == 0 or lower == upper else (1 - part) * lower + part * upper)


def at_rank(df: DataFrame, column: str, share: float) -> float | None:
    """The value at place floor(share * n) in the ascending order (the upper median for a half), None without values."""
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    first = values.agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    if not first.n:
        return None
    rank = min(floor(share * first.n), first.n - 1)
    return _at_ranks(values, [rank], first.n, first.low, first.high, MOST)[rank]


def group_percentiles(df: DataFrame, group: str, column: str, share: float, name: str = "percentile") -> DataFrame:
    """group and the percentile of each group's values; groups without a value are absent.

    Rows are range-partitioned by group and value, so a group of any size is spread over as many partitions as it needs;
    ranks are places within a partition, shifted by the group's rows in the partitions before (one number for each
    partition and group in it).
    """
    from ..sources.tables import stored

    rows = df.select(F.col(group).alias("g"), F.col(column).cast("double").alias("v")).where("v is not null")
    parts = stored(rows.repartitionByRange("g", "v").withColumn("part", F.spark_partition_id()))
    sizes = parts.groupBy("g", "part").agg(F.count("*").alias("m"))
    by = Window.partitionBy("g").orderBy("part")
    before = sizes.select("g", "part", F.coalesce(F.sum("m").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("m").over(Window.partitionBy("g")).alias("n"))
    rank = F.row_number().over(Window.partitionBy("part", "g").orderBy("v")) - 1
    at = parts.withColumn("own", rank).join(F.broadcast(before) if _few(before) else before, ["part", "g"]).withColumn("rank", F.col("own") + F.col("before"))
    place = F.lit(float(share)) * (F.col("n") - 1)
    low = F.floor(place)
    value = lambda r: F.max(F.when(F.col("rank") == r, F.col("v")))
    ends = at.where((F.col("rank") == low) | (F.col("rank") == low + 1)).groupBy("g", "n").agg(value(low).alias("lower"), value(low + 1).alias("upper"))
    part = place - F.floor(place)
    exact = (part == 0) | F.col("upper").isNull() | (F.col("lower") == F.col("upper"))
    return ends.select(F.col("g").alias(group), F.when(exact, F.col("lower")).otherwise((1 - part) * F.col("lower") + part * F.col("upper")).alias(name))


def _few(rows: DataFrame, most: int = 100_000) -> bool:
    return rows.limit(most + 1).count() <= most
