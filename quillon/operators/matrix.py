"""Sparse linear algebra on edges (i, j, v): joins and aggregations, scalars by one-row joins, loops with stored tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import mean_of
from .contacts import symmetric
from .quantiles import bucket_of, percentile_of_buckets, percentiles


def with_attributes(edges: DataFrame, vertices: DataFrame, *columns: str) -> DataFrame:
    """Each attribute of both ends, as name_i and name_j."""
    for end in ("i", "j"):
        edges = edges.join(vertices.select(F.col("contig").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]), end)
    return edges


def site_normalised(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """v / (s_i * s_j) with at least one site."""
    one = lambda c: F.greatest(F.lit(1), F.col(c))
    return with_attributes(edges, vertices, "sites").select("i", "j", (F.col("v") / (one("sites_i") * one("sites_j"))).alias("v"))


def length_normalised(edges: DataFrame, vertices: DataFrame, mean: str = "geometric") -> DataFrame:
    """v / (mean of the lengths in thousands)."""
    return with_attributes(edges, vertices, "length").select("i", "j", (F.col("v") / (1e-3 * mean_of(mean, F.col("length_i"), F.col("length_j")))).alias("v"))


def coverage_normalised(edges: DataFrame, vertices: DataFrame, epsilon: float = 1e-9) -> DataFrame:
    """v / sqrt(c_i * c_j), no diagonal."""
    e = F.lit(epsilon)
    return with_attributes(edges.where("i <> j"), vertices, "coverage").select("i", "j", (F.col("v") / F.sqrt((F.col("coverage_i") + e) * (F.col("coverage_j") + e))).alias("v"))


def regression_scaled(edges: DataFrame, vertices: DataFrame, expected: Column) -> DataFrame:
    """max(mu) * v / sqrt(mu_i * mu_j) for the off-diagonal, mu an expression over a vertex's attributes."""
    mu = vertices.select("contig", expected.alias("mu"))
    top = mu.agg(F.max("mu").alias("top"))  # one row
    return with_attributes(edges.where("i <> j"), mu, "mu").crossJoin(F.broadcast(top)).select("i", "j", (F.col("top") * F.col("v") / F.sqrt(F.col("mu_i") * F.col("mu_j"))).alias("v"))


def above_percentile(edges: DataFrame, p: float, keep_equal: bool = False) -> DataFrame:
    """Entries above the p-th percentile of the values (p in percent); keep_equal keeps those equal to it. Edges are
    stored once, for the exact percentile reads them a few times. An empty matrix stays empty."""
    from ..sources.tables import stored

    if not 0 < p < 100:
        raise ValueError("a percentile is between 0 and 100")
    edges = stored(edges)
    cut = percentiles(edges, "v", [p / 100])[0]
    if cut is None:
        return edges
    return edges.where(F.col("v") >= F.lit(cut) if keep_equal else F.col("v") > F.lit(cut))


def max_scaled(edges: DataFrame) -> DataFrame:
    return edges.crossJoin(F.broadcast(edges.agg(F.max("v").alias("top")))).select("i", "j", (F.col("v") / F.col("top")).alias("v"))


def compressed(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """The submatrix of kept contigs, renumbered from 0 in the order of their names."""
    place = placed(kept)
    for end in ("i", "j"):
        edges = edges.join(place.select(F.col("contig").alias(end), F.col("place").alias(f"p_{end}")), end)
    return edges.select(F.col("p_i").alias("i"), F.col("p_j").alias("j"), "v")


def placed(kept: DataFrame, order: str = "contig") -> DataFrame:
    """Dense numbers from 0. Numbers within ranges of the order, plus the sizes of the ranges before: no single task
    sees all rows."""
    from ..operators.ordering import dense_numbers

    return dense_numbers(kept.select("contig"), order, "place")


def permuted(edges: DataFrame, places: DataFrame) -> DataFrame:
    """Both axes renamed by (contig, place)."""
    for end in ("i", "j"):
        edges = edges.join(places.select(F.col("contig").alias(end), F.col("place").alias(f"p_{end}")), end)
    return edges.select(F.least("p_i", "p_j").alias("i"), F.greatest("p_i", "p_j").alias("j"), "v")


def downsampled(edges: DataFrame, block: int, how: str = "mean") -> DataFrame:
    """Blocks of block x block: the mean over block squared, or the maximum."""
    value = F.sum("v") / (block * block) if how == "mean" else F.max("v")
    return edges.groupBy(F.floor(F.col("i") / block).alias("i"), F.floor(F.col("j") / block).alias("j")).agg(value.alias("v"))


#: Entries of the left side that a group has, about; a row with more is cut along the inner index.
GROUP = 1_000_000
#: Entries of the right side that a group has, about; where its inner indices have more, its columns are cut.
PIECE = 1_000_000
#: Products that a group sums at once.
SUMMED = 1_000_000


def product(left: DataFrame, right: DataFrame, held: list[DataFrame] | None = None) -> DataFrame:
    """left . right: a group is a range of left's rows with what right has at their inner indices.

    So a group's sums are whole, and no product is shuffled. Where the inner indices have many entries in right, its
    columns are dealt to several groups, which get the same rows of left. A range of rows with many entries is cut by
    rows, and one row with many by inner indices: only where there is such a row, sums are shuffled. Values of whole
    numbers give whole numbers. Both sides are sent as lists, left's by row and right's by inner index.
    The result reads stored tables; held, if given, gets them, for a loop to drop when it has stored the result.
    """
    from ..sources.tables import dropped, stored
    from .ordering import dense_numbers

    whole = all(dict(d.dtypes)["v"] in ("bigint", "int") for d in (left, right))
    kinds = dict(left.dtypes)["i"], dict(right.dtypes)["j"]
    a = stored(left.select("i", F.col("j").alias("k"), F.col("v").cast("double").alias("v")))
    b = stored(right.select(F.col("i").alias("k"), "j", F.col("v").cast("double").alias("v")))
    numbered = rows = stored(dense_numbers(a.groupBy("i").agg(F.count("*").alias("n")), "i", "place"))
    some = rows.agg(F.sum("n").alias("n"), F.count("*").alias("rows"), F.max("n").alias("most")).first()
    step = max(1, GROUP * some.rows // some.n) if some.n else 1
    # a row with many entries is a range of its own
    many = F.col("n") > GROUP
    rows = rows.withColumn("band", F.when(many, -1 - F.col("place")).otherwise(F.floor(F.col("place") / step)).cast("long"))
    cuts = rows.groupBy("band").agg(F.ceil(F.sum("n") / GROUP).cast("int").alias("cuts"))
    of = rows.join(cuts, "band").select("i", "band", "cuts")
    cut = F.pmod(F.when(F.col("band") < 0, F.xxhash64("k")).otherwise(F.xxhash64("i")), F.col("cuts")).cast("int").alias("cut")
    listed = lambda d, c: d.agg(F.collect_list(F.struct(c, "v")).alias("x"))
    x = listed(a.join(of, "i").select("band", cut, "i", "k", "v").groupBy("band", "cut", "i"), "k")
    x = stored(x.select("band", "cut", "i", F.col("x.k").alias("k"), F.col("x.v").alias("v")))
    dropped(a)
    dropped(numbered)
    shares = 1 << max(0, -(-b.count() // PIECE) - 1).bit_length()
    y = listed(b.groupBy("k", F.pmod(F.xxhash64("j"), F.lit(shares)).cast("int").alias("share")), "j")
    y = stored(y.select("k", "share", F.col("x.j").alias("j"), F.col("x.v").alias("v")))
    dropped(b)
    met = x.select("band", "cut", F.explode("k").alias("k")).distinct()
    met = stored(met.join(y.groupBy("k").agg(F.sum(F.size("j")).alias("nb")), "k"))
    pieces = F.least(F.lit(shares), F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(1.0), F.sum("nb") / PIECE))))).cast("int")
    parts = stored(met.groupBy("band", "cut").agg(pieces.alias("parts")))
    if held is not None:
        held += [x, y, met, parts]
    y = y.join(met.select("band", "cut", "k").join(parts, ["band", "cut"]), "k").select("band", "cut", F.pmod("share", "parts").cast("int").alias("part"), "k", "j", "v")
    x = x.join(parts, ["band", "cut"]).select("band", "cut", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "i", "k", "v")
    schema = f"i {kinds[0]}, j {kinds[1]}, v double"

    def multiplied(one: pa.Table, other: pa.Table) -> pa.Table:
        def flat(t: pa.Table, row: str, to: str) -> dict[str, pa.Array]:
            names, lists, values = (t[c].combine_chunks() for c in (row, to, "v"))
            n = lists.value_lengths().to_numpy(zero_copy_only=False)
            return {row: names.take(pa.array(np.repeat(np.arange(len(n)), n))), to: lists.flatten(), "v": values.flatten()}

        ends = [[t[c] for c in ("k", e, "v")] for t, e in ((flat(one, "i", "k"), "i"), (flat(other, "k", "j"), "j"))]
        sums = _products(*ends)
        i, j, v = (np.concatenate(z) for z in zip(*sums, strict=True)) if sums else (np.empty(0, np.int64),) * 3
        left_names, right_names = (e[1].unique() for e in ends)
        return pa.Table.from_arrays([left_names.take(pa.array(i, pa.int64())), right_names.take(pa.array(j, pa.int64())), pa.array(v, pa.float64())], names=["i", "j", "v"])

    by = ["band", "cut", "part"]
    sums = x.groupBy(*by).cogroup(y.groupBy(*by)).applyInArrow(multiplied, schema)
    if (some.most or 0) > GROUP:
        sums = sums.groupBy("i", "j").agg(F.sum("v").alias("v"))
    return sums.withColumn("v", F.round("v").cast("long")) if whole else sums


def _products(a: list[pa.Array], b: list[pa.Array]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sums over the inner index k of a group, as places among the distinct outer names of both sides, each place once: of
    at most SUMMED products at a time, or one matrix product where that is dense enough."""
    if not len(a[0]) or not len(b[0]):
        return []
    inner = pa.chunked_array([a[0], b[0]]).combine_chunks().dictionary_encode().indices.to_numpy()
    (ka, kb), va, vb = np.split(inner, [len(a[0])]), a[2].to_numpy(), b[2].to_numpy()
    i, j = (z.dictionary_encode().indices.to_numpy().astype(np.int64) for z in (a[1], b[1]))
    ni, nj, nk = i.max() + 1, j.max() + 1, inner.max() + 1
    flops = float((np.bincount(ka, minlength=nk).astype(float) * np.bincount(kb, minlength=nk)).sum())
    if max(ni * nk, nk * nj, ni * nj) <= 8_000_000 and ni * nj * nk <= 64 * flops:
        x, y, in_x, in_y = np.zeros((ni, nk)), np.zeros((nk, nj)), np.zeros((ni, nk), np.float32), np.zeros((nk, nj), np.float32)
        np.add.at(x, (i, ka), va)
        np.add.at(y, (kb, j), vb)
        in_x[i, ka] = in_y[kb, j] = 1
        r, c = np.nonzero(in_x @ in_y)  # sums that are zero stay
        return [(r, c, (x @ y)[r, c])]
    # by rows of the left side, so that the sums of a row are done when it is
    order_a, order_b = np.lexsort((ka, i)), np.argsort(kb, kind="stable")
    ka, i, va, kb, j, vb = ka[order_a], i[order_a], va[order_a], kb[order_b], j[order_b], vb[order_b]
    first = np.searchsorted(kb, np.arange(nk + 1))
    width = (first[1:] - first[:-1])[ka]  # products of each entry of a
    out, lo, so_far, broken = [], 0, np.cumsum(width), False
    last = np.searchsorted(i, np.arange(ni), side="right")  # where each row ends
    while lo < len(ka):
        hi = max(lo + 1, int(np.searchsorted(so_far, (so_far[lo - 1] if lo else 0) + SUMMED, side="right")))
        if hi < len(ka) and i[hi] > i[lo]:
            hi = int(last[i[hi] - 1])
        broken |= hi < len(ka) and i[hi] == i[hi - 1]
        w = width[lo:hi]
        at = np.repeat(np.arange(lo, hi), w)
        to = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + first[ka[at]]
        row, most = i[lo], int(i[hi - 1] - i[lo] + 1) * int(nj)
        key, v = (i[at] - row) * nj + j[to], va[at] * vb[to]
        if len(key) and most <= 4 * len(key):
            start = np.flatnonzero(np.bincount(key, minlength=most))
            out.append((start // nj + row, start % nj, np.bincount(key, v, most)[start]))
        elif len(key):
            order = np.argsort(key, kind="stable")
            key, v = key[order], v[order]
            start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            out.append((key[start] // nj + row, key[start] % nj, np.add.reduceat(v, start)))
        lo = hi
    if broken:  # a row of more products than are summed at once
        x, y, v = (np.concatenate(z) for z in zip(*out, strict=True))
        key, at = np.unique(x * nj + y, return_inverse=True)
        return [(key // nj, key % nj, np.bincount(at, v))]
    return out


def column_stochastic(full: DataFrame, vertices: DataFrame) -> DataFrame:
    """No diagonal, a loop for vertices without entries, divided by column sums."""
    off = full.where("i <> j")
    lone = vertices.join(off.select(F.col("j").alias("contig")), "contig", "left_anti")
    loops = lone.select(F.col("contig").alias("i"), F.col("contig").alias("j"), F.lit(1.0).alias("v"))
    whole = off.select("i", "j", F.col("v").cast("double").alias("v")).union(loops)
    return whole.join(whole.groupBy("j").agg(F.sum("v").alias("s")), "j").select("i", "j", (F.col("v") / F.col("s")).alias("v"))


def degree_normalised(full: DataFrame) -> DataFrame:
    """D^-1/2 (Q + Q') D^-1/2 of a full matrix."""
    both = full.union(full.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    d = both.groupBy(F.col("i").alias("k")).agg(F.sum("v").alias("d"))
    di, dj = d.select(F.col("k").alias("i"), F.col("d").alias("di")), d.select(F.col("k").alias("j"), F.col("d").alias("dj"))
    one = lambda c: F.when(F.col(c) == 0, 1.0).otherwise(F.col(c))
    return both.join(di, "i").join(dj, "j").select("i", "j", (F.col("v") / F.sqrt(one("di") * one("dj"))).alias("v"))


def row_stochastic(full: DataFrame, vertices: DataFrame) -> DataFrame:
    """No diagonal, a loop for vertices without entries, rows divided by their sums: of a symmetric matrix, the transpose
    of column_stochastic()."""
    return column_stochastic(full, vertices).select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


#: Columns of a matrix whose rows a walk keeps whole in a group; beyond, its steps are products that may cut a row.
LONGEST = 4_000_000
#: Entries of a walk's rows that a group has, about, and of the matrix that they meet there.
WALKED, MET = 200_000, 500_000
#: Cells of a group's sums, and of a panel of the matrix, that are held as a table.
CELLS = 2_000_000


def walked(
    stochastic: DataFrame, starts: DataFrame, restart: float, steps: int, percent: float | None = None, tolerance: float = 0.01, steady: int = 5, change: float = 1e-3, digits: int = 12, longest: int = LONGEST
) -> DataFrame:
    """Random walk with restart from the start rows: Q <- (1 - r) Q P + r I.

    From the second step on, what is not above the percentile of the values goes before the next step, if that percentile is
    above zero. It stops when the Frobenius norm of a step's change (before the cut) is below the tolerance, or when
    `steady` steps in all changed about as much as the step before (by less than `change`). Values are rounded to
    `digits` digits, so that a rerun, which may add up in another order, cuts alike. Each step's matrix is a stored table.

    With a percentile, both matrices are lists of entries by row, columns by number. A group has a range of the walk's rows,
    whole, and a share of the columns, so it rounds its sums, knows its part of the change and counts its values by bucket:
    nothing is added up after it. With more than `longest` contigs a row may be too long for that; then, and without a
    percentile, the steps are products of entries.
    """
    from ..sources.tables import dropped, stored
    from .ordering import dense_numbers

    if percent is None:
        return _walked_by_products(stochastic, starts, restart, steps, percent, tolerance, steady, change, digits)
    p = stored(stochastic.select("i", "j", F.col("v").cast("double").alias("v")))
    own = starts.select("contig").distinct()
    names = stored(dense_numbers(p.select(F.col("i").alias("contig")).union(p.select("j")).union(own).distinct(), "contig", "place"))
    size = names.count()
    if size > longest:
        return _walked_by_products(p, own, restart, steps, percent, tolerance, steady, change, digits)
    place = lambda e, to: names.select(F.col("contig").alias(e), F.col("place").alias(to))
    shares = 1 << (-(-p.count() // MET) - 1).bit_length() if size else 1
    entries = p.join(place("i", "k"), "i").join(place("j", "to"), "j").groupBy("k", F.pmod("to", F.lit(shares)).cast("int").alias("share")).agg(F.collect_list(F.struct("to", "v")).alias("x"))
    right = stored(entries.select("k", "share", F.col("x.to").alias("j"), F.col("x.v").alias("v")))
    counts = stored(right.groupBy("k").agg(F.sum(F.size("j")).alias("nb")))
    q = stored(own.join(names, "contig").select(F.col("place").alias("i"), F.array("place").alias("k"), F.array(F.lit(1.0)).alias("v")))
    by = ["band", "cut"]

    def stepped(q: DataFrame, n: int, cut: float, low: float) -> tuple[DataFrame, list]:
        """The next step's rows without what is up to low, and how many values there are in each bucket, low ones too."""
        left = q.withColumn("band", F.floor(F.col("i") / max(1, WALKED * size // max(1, n))))
        cuts = left.groupBy("band").agg(F.greatest(F.lit(1), F.ceil(F.sum(F.size("k")) / WALKED)).cast("int").alias("cuts"))
        left = left.join(cuts, "band").select("band", F.pmod(F.xxhash64("i"), F.col("cuts")).cast("int").alias("cut"), "i", "k", "v")
        met = left.select(*[F.col(c).alias(c) for c in by], F.explode("k").alias("k")).distinct()
        parts = F.least(F.lit(shares), F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(1.0), F.sum("nb") / MET))))).cast("int")
        dealt = stored(met.join(counts, "k").groupBy(*by).agg(parts.alias("parts")))
        x = left.join(dealt, by, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        x = x.select(*by, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "parts", "i", "k", "v")
        y = right.join(met, "k").join(dealt, by).select(*by, F.pmod("share", "parts").cast("int").alias("part"), "k", "j", "v")
        kinds = "i long, k array<long>, v array<double>, gap double, bucket array<long>, n array<long>"
        new = stored(x.groupBy(*by, "part").cogroup(y.groupBy(*by, "part")).applyInArrow(_stepper(restart, digits, cut, low), kinds))
        dropped(dealt)
        seen = new.select(F.explode(F.arrays_zip("bucket", "n")).alias("x")).groupBy(F.col("x.bucket").alias("bucket")).agg(F.sum("x.n").alias("n"))
        return new, sorted((r.bucket, r.n) for r in seen.collect())

    all_ = float("-inf")
    n, cut, low, before, still = q.count(), all_, all_, 0.0, 0
    for step in range(steps):
        new, seen = stepped(q, n, cut, low)
        last = cut
        if step:
            values = new.select(F.explode("v").alias("v"))
            found = percentile_of_buckets(values, seen, percent / 100, low)
            if found is None and low > all_:  # it is not above low: once more with all values
                dropped(new)
                low = all_
                new, seen = stepped(q, n, cut, low)
                values = new.select(F.explode("v").alias("v"))
                found = percentile_of_buckets(values, seen, percent / 100, low)
            found = percentiles(values, "v", [percent / 100])[0] if found is None else found
            cut = found if found is not None and found > 0 else all_
        dropped(q)
        q = new.select("i", "k", "v")
        left_in = low == all_  # what is up to the cut
        if cut > all_ and left_in:
            q = stored(q.mapInArrow(_cutter(cut), q.schema))
        n = sum(m for b, m in seen if cut == all_ or b >= bucket_of(cut))
        # the next step leaves out what is well below the cut that is to be expected, if two cuts tell that
        low = 0.9 * cut * min(1.0, cut / last) if min(cut, last) > all_ else all_
        rests = False
        if tolerance and step < steps - 1:  # the last step's change decides nothing, and without a tolerance none does
            gap = (new.agg(F.sum("gap")).first()[0] or 0.0) ** 0.5
            still += abs(gap - before) < change
            rests, before = gap < tolerance or still == steady, gap
        if cut > all_ and left_in:
            dropped(new)
        if rests:
            break
    rows = q.select(F.col("i").alias("row"), F.explode(F.arrays_zip("k", "v")).alias("x")).select("row", F.col("x.k").alias("column"), F.col("x.v").alias("v"))
    return rows.where(F.col("v") > F.lit(cut)).join(place("i", "row"), "row").join(place("j", "column"), "column").select("i", "j", "v")


def _entries(t: pa.Table, columns: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many entries each row of lists has, and their columns and values."""
    a, b = (t[c].combine_chunks() for c in (columns, "v"))
    return a.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), a.flatten().to_numpy(), b.flatten().to_numpy()


def _lists(n: np.ndarray, columns: np.ndarray, values: np.ndarray) -> list[pa.Array]:
    ends = pa.array(np.append(0, np.cumsum(n)), pa.int32())
    return [pa.ListArray.from_arrays(ends, pa.array(x, t)) for x, t in ((columns, pa.int64()), (values, pa.float64()))]


def _cutter(cut: float):
    """Lists without the entries up to the cut."""

    def above(batches):
        for batch in batches:
            n, k, v = _entries(pa.Table.from_batches([batch]), "k")
            kept = v > cut
            ends = np.append(0, np.cumsum(kept))[np.append(0, np.cumsum(n))]
            yield pa.RecordBatch.from_arrays([batch["i"], *_lists(np.diff(ends), k[kept], v[kept])], names=["i", "k", "v"])

    return above


def _stepper(restart: float, digits: int, cut: float, low: float):
    """A step of a walk, from the entries above cut, for whole rows and the columns that are `part` modulo `parts`: new entries
    above low, and with the first row the sum of squares of what has changed and how many values each bucket has."""
    whole, real = pa.int64(), pa.float64()
    kinds = pa.schema([("i", whole), ("k", pa.list_(whole)), ("v", pa.list_(real)), ("gap", real), ("bucket", pa.list_(whole)), ("n", pa.list_(whole))])

    def step(one: pa.Table, other: pa.Table) -> pa.Table:
        if not one.num_rows:
            return kinds.empty_table()
        part, parts = one["part"][0].as_py(), one["parts"][0].as_py()
        n, k, v = _entries(one, "k")
        m, j, w = _entries(other, "j")
        rows = np.unique(one["i"].to_numpy())
        kept, of = v > cut, np.repeat(np.searchsorted(rows, one["i"].to_numpy()), n)
        k, v, i, h = k[kept], v[kept], of[kept], np.repeat(other["k"].to_numpy(), m)
        own, was = rows[rows % parts == part], k % parts == part
        columns = np.unique(np.concatenate((j, own, k[was])))
        at = lambda x: np.searchsorted(columns, x)
        diagonal, old = np.searchsorted(rows, own) * len(columns) + at(own), i[was] * len(columns) + at(k[was])
        inner = np.unique(h)
        met = np.isin(k, inner)
        a, b, x, y = np.searchsorted(inner, k[met]), np.searchsorted(inner, h), i[met], at(j)
        products = float((np.bincount(a, minlength=len(inner)).astype(float) * np.bincount(b, minlength=len(inner))).sum())
        cells = len(rows) * len(columns)
        if cells <= CELLS and cells * len(inner) <= 256 * products:
            sums = _panels((x, a, v[met]), (b, y, w), len(rows), len(inner), len(columns)).ravel() * (1 - restart)
            sums[diagonal] += restart
            sums = np.round(sums, digits)
            key = np.flatnonzero(sums)
            values = sums[key]
            np.subtract.at(sums, old, v[was])
            gap = float(np.dot(sums, sums))
        else:
            found = _products([pa.array(a), pa.array(x), pa.array(v[met])], [pa.array(b), pa.array(y), pa.array(w)]) if products else []
            # names in the order in which _products() numbers them
            x, y = (pa.array(z).unique().to_numpy() for z in (x, y))
            key = np.concatenate([*(x[r] * len(columns) + y[c] for r, c, _ in found), diagonal])
            values = np.concatenate([*(s * (1 - restart) for *_, s in found), np.full(len(diagonal), restart)])
            key, to = np.unique(key, return_inverse=True)
            values = np.round(np.bincount(to, values, len(key)), digits)
            both, to = np.unique(np.concatenate((key, old)), return_inverse=True)
            gap = float((np.bincount(to, np.concatenate((values, -v[was])), len(both)) ** 2).sum())
            key, values = key[values != 0], values[values != 0]
        bucket, m = np.unique(bucket_of(values), return_counts=True)
        key, values = key[values > low], values[values > low]
        lists = _lists(np.bincount(key // max(1, len(columns)), minlength=len(rows)), columns[key % max(1, len(columns))], values)
        rest = len(rows) - 1
        told = [pa.array([x, *[[]] * rest], pa.list_(whole)) for x in (bucket, m)]
        return pa.Table.from_arrays([pa.array(rows), *lists, pa.array([gap, *[0.0] * rest]), *told], schema=kinds)

    return step


def _panels(one: tuple, other: tuple, rows: int, inner: int, columns: int) -> np.ndarray:
    """The product of (row, inner, value) and (inner, column, value) as a table, a panel of inner numbers at a time."""
    out, wide = np.zeros((rows, columns)), max(1, CELLS // max(rows, columns, 1))
    (x, a, v), (b, y, w) = ([z[order] for z in side] for side, order in ((one, np.argsort(one[1], kind="stable")), (other, np.argsort(other[0], kind="stable"))))
    for low in range(0, inner, wide):
        high = min(inner, low + wide)
        p, q = (slice(*np.searchsorted(c, (low, high))) for c in (a, b))
        left, right = np.zeros((rows, high - low)), np.zeros((high - low, columns))
        np.add.at(left, (x[p], a[p] - low), v[p])
        np.add.at(right, (b[q] - low, y[q]), w[q])
        out += left @ right
    return out


def _walked_by_products(stochastic: DataFrame, starts: DataFrame, restart: float, steps: int, percent: float | None, tolerance: float, steady: int, change: float, digits: int) -> DataFrame:
    """walked(), each step a product of entries; a row of any length is cut where that is needed."""
    from ..sources.tables import dropped, stored

    unit = stored(starts.select(F.col("contig").alias("i"), F.col("contig").alias("j"), F.lit(1.0).alias("v")).distinct())
    none = unit.withColumn("v", F.lit(0.0))  # so a product has all starts' own entries, and r is added in place
    back = F.when(F.col("i") == F.col("j"), restart).otherwise(0.0)
    stochastic = stored(stochastic.select("i", "j", "v").union(none))  # read in every step
    q, table, before, still = unit, None, 0.0, 0
    for step in range(steps):
        held: list[DataFrame] = []
        spread = product(q.select("i", "j", "v").union(none), stochastic, held)
        new = stored(spread.select("i", "j", F.round(F.col("v") * (1 - restart) + back, digits).alias("v")).where("v <> 0"))
        for one in held:
            dropped(one)
        last = step == steps - 1
        if tolerance and not last:  # the last step's change decides nothing, and without a tolerance none does
            both = new.union(q.select("i", "j", (-F.col("v")).alias("v"))).groupBy("i", "j").agg(F.sum("v").alias("d"))
            gap = both.agg(F.sqrt(F.sum(F.col("d") ** 2)).alias("d")).first().d or 0.0
        if table is not None:
            dropped(table)
        table = q = new
        if percent is not None and step:
            cut = percentiles(new, "v", [percent / 100])[0]
            if cut is not None and cut > 0:
                q = new.where(F.col("v") > F.lit(cut))
        if tolerance and not last:
            still += abs(gap - before) < change
            if gap < tolerance or still == steady:
                break
            before = gap
    return q


def balanced(edges: DataFrame, rounds: int, tolerance: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Scale factors x with x * (A x) = 1 after so many rounds of x <- sqrt(x / (A x)), on the matrix with ones on empty
    diagonals, and the scaled original matrix."""
    from ..sources.tables import dropped, stored

    full = symmetric(edges.select("i", "j", F.col("v").cast("double").alias("v")))
    ids = full.select(F.col("i").alias("contig")).distinct()
    holes = ids.join(full.where("i = j").select(F.col("i").alias("contig")), "contig", "left_anti")
    work = stored(full.union(holes.select(F.col("contig").alias("i"), F.col("contig").alias("j"), F.lit(1.0).alias("v"))))
    x = stored(ids.select("contig", F.lit(1.0).alias("x")))
    for _ in range(rounds):
        ax = work.join(x.select(F.col("contig").alias("j"), "x"), "j").groupBy("i").agg(F.sum(F.col("v") * F.col("x")).alias("ax"))
        new = stored(x.join(ax, x.contig == ax.i).select("contig", F.sqrt(F.col("x") / F.col("ax")).alias("x"), F.abs(1 - F.col("x") * F.col("ax")).alias("off")))
        dropped(x)
        x = new.select("contig", "x")
        off = new.agg(F.max("off")).first()[0] if tolerance else 1.0
        if off is None or off < tolerance:  # an empty matrix is balanced
            break
    return x, rescaled(edges, x)


def newton_balanced(edges: DataFrame, tolerance: float = 1e-6, rounds: int = 1000, low: float = 0.1, high: float = 3.0) -> tuple[DataFrame, DataFrame, int]:
    """Scale factors x with x * (A x) = 1 by Newton steps, the scaled original matrix, and the matrix products it took.

    Ones stand on empty diagonals for the scaling only. Each Newton step solves (diag(x * A x) + diag(x) A diag(x)) y = 1 + x * A x by
    conjugate gradients, as far as the residual deserves; factors of one step stay between `low` and `high`, where the
    inner loop ends. It is done when the norm of 1 - x * (A x) is below the tolerance. A round is one product, a join on
    the contigs; the driver holds a few sums.
    """
    from ..sources.tables import dropped, stored

    full = symmetric(edges.select("i", "j", F.col("v").cast("double").alias("v")).where("v <> 0"))
    ids = edges.select(F.col("i").alias("contig")).union(edges.select("j")).distinct()
    holes = ids.join(full.where("i = j").select(F.col("i").alias("contig")), "contig", "left_anti")
    work = stored(full.union(holes.select(F.col("contig").alias("i"), F.col("contig").alias("j"), F.lit(1.0).alias("v"))))

    def times(vector: DataFrame) -> DataFrame:
        """(contig, m): the matrix times (contig, value)."""
        by = work.join(vector.select(F.col("contig").alias("j"), F.col("value").alias("x")), "j")
        return by.groupBy(F.col("i").alias("contig")).agg(F.sum(F.col("v") * F.col("x")).alias("m"))

    def begun(x: DataFrame) -> DataFrame:
        """x with v = x * (A x), the residual, and a step of ones."""
        v = F.col("x") * F.col("m")
        made = x.join(times(x.select("contig", F.col("x").alias("value"))), "contig").select("contig", "x", v.alias("v"), (1 - v).alias("r"))
        return stored(made.withColumns({"y": F.lit(1.0), "p": F.lit(0.0)}))

    state = begun(ids.select("contig", F.lit(1.0).alias("x")))
    products, forcing = 1, 0.1
    outer = state.agg(F.sum(F.col("r") ** 2)).first()[0] or 0.0
    while outer > tolerance**2 and products < rounds:
        goal, beta, z = max(forcing**2 * outer, tolerance**2), 0.0, F.col("r") / F.col("v")
        rho = state.agg(F.sum(F.col("r") * z)).first()[0]
        stepped = False
        while products < rounds and (not stepped or rho > goal):
            stepped = True
            # the direction, and the matrix of the step times it, in one table
            aimed = state.select("contig", "x", "v", "r", "y", (z + F.lit(beta) * F.col("p")).alias("p"))
            w = F.col("x") * F.col("m") + F.col("v") * F.col("p")
            new = stored(aimed.join(times(aimed.select("contig", (F.col("x") * F.col("p")).alias("value"))), "contig").select("contig", "x", "v", "r", "y", "p", w.alias("w")))
            products += 1
            dropped(state)
            alpha = rho / new.agg(F.sum(F.col("p") * F.col("w"))).first()[0]
            step, y = F.lit(alpha) * F.col("p"), F.col("y")
            rest = F.col("r") - F.lit(alpha) * F.col("w")
            seen = new.agg(
                F.min(y + step).alias("least"), F.max(y + step).alias("most"), F.sum(rest * rest / F.col("v")).alias("rho"),
                F.min(F.when(step < 0, (low - y) / step)).alias("down"), F.min(F.when(y + step > high, (high - y) / step)).alias("up"),
            ).first()
            if seen.least <= low or seen.most >= high:
                part = F.lit(float(seen.down if seen.least <= low else seen.up))
                state = new.select("contig", "x", "v", "r", (y + part * step).alias("y"), "p")
                break
            state = new.select("contig", "x", "v", rest.alias("r"), (y + step).alias("y"), "p")
            beta, rho = seen.rho / rho, seen.rho
        was, before = state, outer
        state = begun(was.select("contig", (F.col("x") * F.col("y")).alias("x")))
        products += 1
        outer = state.agg(F.sum(F.col("r") ** 2)).first()[0] or 0.0
        aim, forcing = forcing, 0.9 * outer / before
        if 0.9 * aim**2 > 0.1:
            forcing = max(forcing, 0.9 * aim**2)
        forcing = max(min(forcing, 0.1), 0.5 * tolerance / max(outer**0.5, 1e-300))
    x = state.select("contig", "x")
    return x, rescaled(edges, x), products


def rescaled(edges: DataFrame, x: DataFrame) -> DataFrame:
    """Every entry times the factors (contig, x) of both its ends; other columns than i, j and v stay."""
    end = lambda e: x.select(F.col("contig").alias(e), F.col("x").alias(f"__{e}"))
    both = edges.join(end("i"), "i").join(end("j"), "j")
    return both.select(*[(F.col("__i") * F.col("v") * F.col("__j")).alias("v") if c == "v" else F.col(c) for c in edges.columns])


# -- four dimensions: (i, j, k, l, v), k and l the ends of contigs i and j that a pair touches -------------------------
def tip(position: Column, length: Column, size: int) -> Column:
    """0 for a read in the first `size` bases (positions from 0), 1 in the last ones, null between; a contig shorter than
    two tips is halved."""
    reach = F.when(length < 2 * size, F.floor(length / 2)).otherwise(F.lit(size))
    return F.when(position < reach, 0).when(position >= length - reach, 1)


def tip_counts(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b, tip_a, tip_b) counted by contigs and tips, i <= j; on the diagonal k <= l. Pairs with a read outside
    the tips do not count."""
    kept = pairs.where("tip_a is not null and tip_b is not null")
    swap = (F.col("a") > F.col("b")) | ((F.col("a") == F.col("b")) & (F.col("tip_a") > F.col("tip_b")))
    one = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    return kept.groupBy(one("a", "b").alias("i"), one("b", "a").alias("j"), one("tip_a", "tip_b").alias("k"), one("tip_b", "tip_a").alias("l")).agg(F.count("*").alias("v"))


def tensor_symmetric(tensor: DataFrame) -> DataFrame:
    """The full tensor of an upper half: off the diagonal both pairs of axes are swapped; the diagonal stays as it is."""
    both = F.array(F.struct("i", "j", "k", "l"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), F.col("l").alias("k"), F.col("k").alias("l")))
    own = F.when(F.col("i") == F.col("j"), F.slice(both, 1, 1)).otherwise(both)
    return tensor.select(F.explode(own).alias("x"), "v").select("x.i", "x.j", "x.k", "x.l", "v")


def tensor_balanced(tensor: DataFrame, tolerance: float = 1e-6, rounds: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Scale factors of the marginal matrix of an upper half (i <= j), and the tensor's entries times both ends' factors."""
    x, _, _ = newton_balanced(marginal(tensor), tolerance, rounds)
    return x, rescaled(tensor, x)


def marginal(tensor: DataFrame) -> DataFrame:
    """(i, j, k, l, v) summed over the ends k and l."""
    return tensor.groupBy("i", "j").agg(F.sum("v").alias("v"))


def flattened(tensor: DataFrame) -> DataFrame:
    """(i, j, k, l, v) as a matrix of twice the size."""
    return tensor.select((2 * F.col("i") + F.col("k")).alias("i"), (2 * F.col("j") + F.col("l")).alias("j"), "v")


def tensor_largest(tensor: DataFrame) -> DataFrame:
    m = marginal(tensor)
    return symmetric(m).where("i <> j").groupBy("i").agg(F.max("v").alias("v"))


def sparsity(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    n = vertices.agg(F.count("*").alias("n"))
    return edges.agg(F.count("*").alias("nnz")).crossJoin(n).select((F.col("nnz") / (F.col("n") * F.col("n"))).alias("sparsity"))


def neighbours(full: DataFrame, top: int) -> DataFrame:
    """The `top` heaviest neighbours of each vertex."""
    r = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("v"), "j"))
    return full.where("i <> j").withColumn("rank", r).where(F.col("rank") <= top)
