"""Graph operators: components by least labels, modularity of clusters, matching. Communities are in communities.py."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def components(edges: DataFrame) -> DataFrame:
    """node and component (the least node reachable) of all ends of edges (i, j)."""
    from ..sources.tables import stored

    ends = F.array(F.struct(F.col("i").alias("a"), F.col("j").alias("b")), F.struct(F.col("j").alias("a"), F.col("i").alias("b")))
    both = stored(edges.select(F.explode(ends).alias("x")).select("x.a", "x.b"))
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("was"), F.least("label", "near").alias("l"))
        up = labels.select(F.col("node").alias("l"), F.col("label").alias("further"))
        seen = Observation()
        new = hooked.join(up, "l", "left").select("node", "was", F.least("l", "further").alias("label"))
        labels = stored(new.observe(seen, F.count_if(F.col("was") != F.col("label")).alias("changed"))).select("node", "label")
        if not seen.get["changed"]:
            return labels.withColumnRenamed("label", "component")


def local_regions(edges: DataFrame, top: int, hops: int) -> DataFrame:
    """node, near: what each contig reaches by one step to `hops` + 1 steps, each to one of the `top` heaviest neighbours of
    where it is (ties by name). Only new pairs are expanded, so a round is a join of the frontier with the stored lists of
    neighbours; a contig has at most top + top^2 + ... pairs."""
    from ..sources.tables import stored
    from .contacts import symmetric
    from .matrix import neighbours

    lists = stored(neighbours(symmetric(edges.select("i", "j", "v")).where("v > 0"), top).select("i", "j"))
    reached = frontier = stored(lists.select(F.col("i").alias("node"), F.col("j").alias("near")))
    for _ in range(hops):
        step = frontier.join(lists.select(F.col("i").alias("near"), F.col("j").alias("next")), "near").select("node", F.col("next").alias("near")).distinct()
        frontier = stored(step.join(reached, ["node", "near"], "left_anti"))
        reached = stored(reached.union(frontier))
    return reached


def degenerates(edges: DataFrame, vertices: DataFrame, most: float, least: int = 0, top: int = 5, hops: int = 1) -> DataFrame:
    """contig, degenerate, coverage, local and fold of each contig of at least `least` length that has a neighbour: its coverage
    against the geometric mean of its region's; a fold above `most` marks a repeat."""
    v = vertices.select("contig", "length", F.col("coverage").cast("double").alias("coverage"))
    near = local_regions(edges, top, hops).join(v.select(F.col("contig").alias("near"), F.col("coverage").alias("c")), "near")
    mean = near.groupBy(F.col("node").alias("contig")).agg(F.exp(F.avg(F.log("c"))).alias("local"))
    out = v.where(F.col("length") >= least).join(mean, "contig").withColumn("fold", F.col("coverage") / F.col("local"))
    return out.select("contig", (F.col("fold") > most).alias("degenerate"), "coverage", "local", "fold")


def modularity(edges: DataFrame, clusters: DataFrame, gamma: float = 1.0) -> DataFrame:
    """Of clusters (node, cluster); edges (i, j, v) are read once. Ends without a cluster are not counted."""
    c = lambda e: clusters.select(F.col("node").alias(e), F.col("cluster").alias(f"c{e}"))
    both = edges.where("i <> j").join(c("i"), "i", "left").join(c("j"), "j", "left")
    known = F.col("ci").isNotNull() & F.col("cj").isNotNull()
    v, zero = F.col("v"), F.col("v") * 0
    first = F.struct(F.col("ci").alias("c"), F.when(F.col("ci") == F.col("cj"), v).otherwise(zero).alias("w"), F.when(known, v).alias("m"))
    other = F.struct(F.col("cj").alias("c"), zero.alias("w"), F.lit(None).cast(edges.schema["v"].dataType).alias("m"))
    by = both.select("v", F.explode(F.array(first, other)).alias("x")).groupBy("x.c").agg(F.sum("v").alias("k"), F.sum("x.w").alias("w"), F.sum("x.m").alias("m"))
    held = F.when(F.col("c").isNotNull(), F.col("k") * F.col("k"))
    sums = by.agg(F.sum("w").alias("w_in"), F.sum("m").alias("m"), F.sum(held).alias("kk"))
    return sums.select((F.col("w_in") / F.col("m") - gamma * F.col("kk") / (4 * F.col("m") * F.col("m"))).alias("modularity"))


def assignment(cost: np.ndarray) -> list[tuple[int, int]]:
    """Minimum-cost matching of all rows or all columns, whichever are fewer, by shortest augmenting paths."""
    flip = cost.shape[0] > cost.shape[1]
    c = cost.T if flip else cost
    n, m = c.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            i0 = match[j0]
            free = np.flatnonzero(~used[1:]) + 1
            slack = c[i0 - 1, free - 1] - u[i0] - v[free]
            better = slack < least[free]
            least[free[better]], way[free[better]] = slack[better], j0
            j1 = free[least[free].argmin()]
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    pairs = [(int(match[j]) - 1, j - 1) for j in range(1, m + 1) if match[j]]
    return sorted((b, a) if flip else (a, b) for a, b in pairs)


def sums_of(contigs: np.ndarray, i: np.ndarray, j: np.ndarray, v: np.ndarray):
    """sums(new, placed, n): weights of each new contig to all members of each of n bins. contigs are sorted and hold all ends."""
    at, to = (np.searchsorted(contigs, np.concatenate(x)) for x in ((i, j), (j, i)))
    order = np.argsort(at, kind="stable")
    first, to, v = np.searchsorted(at[order], np.arange(len(contigs) + 1)), to[order], np.concatenate([v, v]).astype(float)[order]

    def sums(new: list, placed: dict, n: int) -> np.ndarray:
        bin_of = np.full(len(contigs), -1)
        bin_of[np.searchsorted(contigs, list(placed))] = list(placed.values())
        out = np.zeros((len(new), n))
        for r, c in enumerate(np.searchsorted(contigs, new)):
            b, x = bin_of[to[first[c] : first[c + 1]]], v[first[c] : first[c + 1]]
            out[r] = np.bincount(b[b >= 0], x[b >= 0], n)
        return out

    return sums


def matched_bins(markers: list[tuple[str, list[str]]], weight, intra: float, inter: float, own: dict[str, set[str]], sums=None) -> dict[str, int]:
    """contig -> bin. The first marker's contigs open bins; each later marker's are matched with the bins by mean weight
    to the members, taken if it is at least intra and no marker is shared, and open a bin if no weight is above inter.
    sums(new, placed, bins), if given, stands for weight(contig, member) over many at once."""
    bins: list[list[str]] = []
    held: list[set[str]] = []
    placed: dict[str, int] = {}

    def opened(c: str) -> None:
        placed[c] = len(bins)
        bins.append([c])
        held.append(set(own.get(c, ())))

    for k, (_, contigs) in enumerate(markers):
        new = [c for c in contigs if c not in placed]
        if k == 0:
            for c in new:
                opened(c)
            continue
        if not new or not bins:
            continue
        if sums is None:
            w = np.array([[np.mean([weight(c, x) for x in b]) for b in bins] for c in new])
        else:
            w = sums(new, placed, len(bins)) / [len(b) for b in bins]
        left = set()
        for r, b in assignment(-w):
            if w[r, b] >= intra and not held[b] & own.get(new[r], set()):
                placed[new[r]] = b
                bins[b].append(new[r])
                held[b] |= own.get(new[r], set())
            else:
                left.add(r)
        for r in sorted(left):
            if (w[r] <= inter).all():
                opened(new[r])
    return placed
