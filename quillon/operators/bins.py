"""Algebra of alternative clusterings: long tables (bin_set, bin, contig, length) and bin statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import at_rank, group_percentiles


def extents(members: DataFrame, least: int = 0) -> DataFrame:
    return members.groupBy("bin").agg(F.sum("length").alias("extent"), F.count("*").alias("size")).where(F.col("extent") >= least)


def large_clusters(members: DataFrame, least: int) -> DataFrame:
    return extents(members, least).agg(F.count("*").alias("numcom"))


def cluster_report(members: DataFrame, value: str) -> DataFrame:
    """Size, extent and, of a value of each contig, the length-weighted mean, mean, median and population deviation."""
    moments = members.groupBy("bin").agg(
        F.count("*").alias("size"), F.sum("length").alias("extent"), (F.sum(F.col("length") * F.col(value)) / F.sum("length")).alias("expect"),
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
    )
    return moments.join(group_percentiles(members, "bin", value, 0.5, "median"), "bin", "left")


def intersections(members: DataFrame, sets: list[str], least: int) -> DataFrame:
    """Contigs that are in all the sets, grouped by their bins: one row for each tuple of bins with enough length.

    One aggregation by contig instead of joins between the sets.
    """
    names = [F.max(F.when(F.col("bin_set") == s, F.col("bin"))).alias(s) for s in sets]
    by = members.where(F.col("bin_set").isin(sets)).groupBy("contig").agg(*names, F.max("length").alias("length")).dropna(subset=sets)
    return by.groupBy(*sets).agg(F.count("*").alias("contigs"), F.sum("length").alias("extent")).where(F.col("extent") >= least)


def overlaps(a: DataFrame, b: DataFrame) -> DataFrame:
    """Shared length of each pair of bins with a shared contig, as the larger of its shares in percent."""
    size = lambda d, n: d.groupBy("bin").agg(F.sum("length").alias(n))
    shared = (
        a.select(F.col("bin").alias("bin_a"), "contig", "length")
        .join(b.select(F.col("bin").alias("bin_b"), "contig"), "contig")
        .groupBy("bin_a", "bin_b")
        .agg(F.sum("length").alias("shared"))
    )
    return (
        shared.join(size(a, "len_a").withColumnRenamed("bin", "bin_a"), "bin_a")
        .join(size(b, "len_b").withColumnRenamed("bin", "bin_b"), "bin_b")
        .select("bin_a", "bin_b", "shared", (100.0 * F.greatest(F.col("shared") / F.col("len_a"), F.col("shared") / F.col("len_b"))).alias("ratio"))
    )


def unmatched(a: DataFrame, b: DataFrame, ratio: float) -> DataFrame:
    """Bins of b that no bin of a shares at least `ratio` percent of either's length with."""
    matched = overlaps(a, b).where(F.col("ratio") >= ratio).select(F.col("bin_b").alias("bin"))
    return b.select("bin").distinct().join(matched, "bin", "left_anti")


def marker_listing(hits: DataFrame, by: str = "bin") -> DataFrame:
    """Per bin or marker: the distinct genes, sorted and joined, and how many there are."""
    genes = hits.select(by, "gene").distinct().groupBy(by)
    return genes.agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("gene")), ",").alias("genes"))


def membership(members: DataFrame) -> DataFrame:
    """Lines of contig and bin for every final bin."""
    return members.select(F.concat_ws("\t", F.col("contig").cast("string"), "bin").alias("value"))


def good(comp: float, cont: float, strict: bool = False) -> Column:
    if strict:
        return (F.col("completeness") > comp) & (F.col("contamination") < cont)
    return F.col("completeness").between(comp, 100) & F.col("contamination").between(0, cont)


def consolidated(stats_a: DataFrame, stats_b: DataFrame, overlap: DataFrame, ratio: float = 80.0) -> DataFrame:
    """The better (completeness - 5 contamination) of each A bin and the B bins that overlap it enough, and the B bins
    that no A bin overlaps. Ties stay with A, then with the first name."""
    score = F.col("completeness") - 5 * F.col("contamination")
    a = stats_a.select(F.col("bin").alias("bin_a"), score.alias("score_a"))
    b = stats_b.select(F.col("bin").alias("bin_b"), score.alias("score_b"))
    match = overlap.where(F.col("ratio") >= ratio).join(a, "bin_a").join(b, "bin_b")
    best = match.groupBy("bin_a").agg(F.min(F.struct((-F.col("score_b")).alias("s"), F.col("bin_b").alias("bin"))).alias("m"))
    kept_a = a.join(best, "bin_a", "left").select(
        F.when(-F.col("m.s") > F.col("score_a"), F.struct(F.lit("B").alias("origin"), F.col("m.bin").alias("bin"), (-F.col("m.s")).alias("score")))
        .otherwise(F.struct(F.lit("A").alias("origin"), F.col("bin_a").alias("bin"), F.col("score_a").alias("score"))).alias("k")
    ).select("k.*").distinct()
    rest = b.join(match.select("bin_b").distinct(), "bin_b", "left_anti").select(F.lit("B").alias("origin"), F.col("bin_b").alias("bin"), F.col("score_b").alias("score"))
    return kept_a.union(rest)


def dereplicated(members: DataFrame, stats: DataFrame, remove: bool = False) -> DataFrame:
    """Each contig in its best bin (completeness - 5 contamination + 1e-10 N50); remove drops repeated contigs instead."""
    if remove:
        once = members.groupBy("contig").agg(F.count("*").alias("n")).where("n = 1").select("contig")
        return members.join(once, "contig", "left_semi").select("contig", "bin")
    score = F.col("completeness") - 5 * F.col("contamination") + 1e-10 * F.col("n50")
    best = members.join(stats.select("bin", score.alias("score")), "bin")
    # a maximum instead of a window: it is combined before the shuffle
    return best.groupBy("contig").agg(F.max(F.struct("score", "bin")).alias("m")).select("contig", F.col("m.bin").alias("bin"))


def best_versions(stats: DataFrame) -> DataFrame:
    """The version of each base bin with the highest completeness + 5 (100 - contamination), then N50, then name."""
    score = F.col("completeness") + 5 * (100 - F.col("contamination"))
    return stats.groupBy("base").agg(F.max(F.struct(score.alias("score"), F.col("n50").alias("n50"), F.col("version").alias("version"))).alias("m")).select("base", "m.version", "m.score")


def graded() -> Column:
    c = F.col("completeness")
    return F.when(F.col("contamination") <= 5, F.when(c >= 90, 3).when(c >= 70, 2).when(c >= 50, 1).otherwise(0)).otherwise(0)


def quality_grid(stats: DataFrame, comps: list[int], conts: list[int]) -> DataFrame:
    """Bins of each set that meet each pair of thresholds; one pass, one conditional count for each."""
    made = stats.groupBy("bin_set").agg(*[F.count_if((F.col("completeness") >= c) & (F.col("contamination") <= x)).alias(f"c{c}_x{x}") for c in comps for x in conts])
    return made


def marker_counts(hits: DataFrame) -> DataFrame:
    """Distinct contigs of each marker, and how many markers have as many."""
    per = hits.groupBy("marker").agg(F.count_distinct("contig").alias("contigs"))
    return per.groupBy("contigs").agg(F.count("*").alias("markers"))


def seed_marker(hits: DataFrame) -> DataFrame:
    """The marker with the upper-median number of contigs and the shortest query; no row if that number is 1 or less."""
    from ..sources.tables import stored

    per = stored(hits.groupBy("marker").agg(F.count_distinct("contig").alias("contigs"), F.min("qlen").alias("qlen")))
    median = at_rank(per, "contigs", 0.5)
    at = per.where(F.col("contigs") == F.lit(median)).where("contigs > 1")
    one = at.agg(F.min(F.struct("qlen", "marker")).alias("m"), F.max("contigs").alias("median")).where("m is not null")
    return one.select("m.marker", "m.qlen", "median")


def marker_order(hits: DataFrame) -> DataFrame:
    """Markers by contigs, then by the markers on those contigs, both descending, then by name."""
    pairs = hits.select("marker", "contig").distinct()
    on = pairs.groupBy("contig").agg(F.count("*").alias("m"))
    by = pairs.join(on, "contig").groupBy("marker").agg(F.count("*").alias("contigs"), F.sum("m").alias("load"))
    return by


def completeness(hits: DataFrame, sets: DataFrame) -> DataFrame:
    """Per bin: mean over marker sets of the share found, and of the extra copies, in percent."""
    copies = hits.groupBy("bin", "marker").agg(F.count("*").alias("c"))
    size = sets.groupBy("set_id").agg(F.count("*").alias("size"))
    n_sets = size.agg(F.count("*").alias("n_sets"))
    per = copies.join(sets, "marker").groupBy("bin", "set_id").agg(F.count("*").alias("found"), F.sum(F.col("c") - 1).alias("extra"))
    return per.join(size, "set_id").crossJoin(F.broadcast(n_sets)).groupBy("bin").agg(
        (100.0 * F.sum(F.col("found") / F.col("size")) / F.max("n_sets")).alias("completeness"),
        (100.0 * F.sum(F.col("extra") / F.col("size")) / F.max("n_sets")).alias("contamination"),
    )


def greedy_ensemble(members: DataFrame, stats_of, weight: float = 2.0, least_quality: float = 10.0, least_comp: float = 50.0, most_cont: float = 10.0) -> DataFrame:
    """Repeatedly the best bin (completeness - weight * contamination, then N50, size and name) of all sets; its contigs
    leave every other bin. stats_of(members) gives bin_set, bin, completeness, contamination, n50 and extent. The loop
    has a round for each reported bin; each round is one small aggregate over the members that are left."""
    from ..sources.tables import stored

    left, out = stored(members), []
    while True:
        best = (
            stats_of(left)
            .withColumn("quality", F.col("completeness") - weight * F.col("contamination"))
            .orderBy(F.desc("quality"), F.desc("n50"), F.desc("extent"), "bin_set", "bin")
            .first()
        )
        if best is None or best.quality < least_quality:
            break
        own = left.where((F.col("bin_set") == best.bin_set) & (F.col("bin") == best.bin)).select("contig")
        if best.completeness >= least_comp and best.contamination <= most_cont:
            out.append((best.bin_set, best.bin, float(best.completeness), float(best.contamination), float(best.quality)))
        left = stored(left.join(own, "contig", "left_anti"))
    return members.sparkSession.createDataFrame(out, "bin_set string, bin string, completeness double, contamination double, quality double")


def rank_curves(stats: DataFrame, comp: float, cont: float) -> DataFrame:
    """Ranks by completeness and by contamination of each set's good bins."""
    kept = stats.where(good(comp, cont))
    by = lambda *o: F.row_number().over(Window.partitionBy("bin_set").orderBy(*o, "bin"))
    return kept.select("bin_set", "bin", by(F.desc("completeness")).alias("rank_completeness"), by("contamination").alias("rank_contamination"), by(F.desc("n50")).alias("rank_n50"))
