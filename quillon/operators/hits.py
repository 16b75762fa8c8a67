"""Lists of profile hits: staged filters, two-level thresholds, order and removal of near-equal neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def staged(hits: DataFrame, stages: list[tuple[str, float]]) -> DataFrame:
    """Each hit with the number of filters that it passes in turn (P value columns and their limits)."""
    passed, so_far = F.lit(0), F.lit(True)
    for column, limit in stages:
        so_far = so_far & (F.col(column) <= limit)
        passed = passed + so_far.cast("int")
    return hits.withColumn("passed", passed)


def thresholded(hits: DataFrame, targets: float, most: float, domain_most: float) -> DataFrame:
    """Reported domains of reported targets: a target's P value times the number of targets compared is at most `most`;
    a domain's, times the number of reported targets, at most `domain_most`."""
    by = hits.groupBy("target").agg(F.min("p").alias("best")).where(F.col("best") * targets <= most)
    n = by.agg(F.count("*").alias("reported"))
    return hits.join(by.select("target"), "target", "left_semi").crossJoin(F.broadcast(n)).where(F.col("p") * F.col("reported") <= domain_most)


def without_twins(hits: DataFrame, near: int = 3, share: float = 0.95) -> DataFrame:
    """Hits of a target by start without those that begin and end within `near` of the hit before, or that it covers by
    `share`; only neighbours are compared, and a target's first hit stays."""
    w = Window.partitionBy("target").orderBy("start", "end", "hit")
    s, e = F.lag("start").over(w), F.lag("end").over(w)
    d = hits.withColumns({"__s": s, "__e": e})
    flush = (F.abs(F.col("start") - F.col("__s")) <= near) & (F.abs(F.col("end") - F.col("__e")) <= near)
    inside = F.greatest(F.lit(0), F.least("end", "__e") - F.greatest("start", "__s") + 1) >= share * (F.col("end") - F.col("start") + 1)
    # a target's first hit has no neighbour; least() would skip its nulls
    return d.where(F.col("__s").isNull() | ~F.coalesce(flush | inside, F.lit(False))).drop("__s", "__e")


def of_known(hits: DataFrame, contigs: DataFrame) -> DataFrame:
    """Hits on contigs that are known."""
    return hits.join(contigs.select("contig").distinct(), "contig", "left_semi")


def longest_markers(hits: DataFrame, lengths: DataFrame, most: int = 8000) -> DataFrame:
    """Hits on the `most` longest marker contigs (ties by name): a top-k report, merged from each task's own."""
    own = lengths.join(hits.select("contig").distinct(), "contig", "left_semi").orderBy(F.desc("length"), "contig").limit(most)
    return hits.join(own.select("contig"), "contig", "left_semi")
