"""From name-grouped records to contact matrices: pairing, accounting, counting, filters and quality ratios.

Records are DataFrames with qname, an order column, contig and whatever the match rule needs; matrices are edges
(i, j, v) with i <= j.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(records: DataFrame, *order: str) -> DataFrame:
    """Records with their pair: the first and second of a name are pair 0, the next two pair 1, and so on."""
    rn = F.row_number().over(Window.partitionBy("qname").orderBy(*order))
    return records.withColumn("rn", rn).withColumn("pair", F.floor((F.col("rn") - 1) / 2))


def pairs(records: DataFrame, match: Column, *order: str) -> DataFrame:
    """qname, pair, a, b (contigs in order) and ok (both records match); a name's odd last record is left out.

    One shuffle, by name: the aggregation reuses the window's partitioning.
    """
    first = F.col("rn") % 2 == 1
    return (
        numbered(records.withColumn("match", match), *order)
        .groupBy("qname", "pair")
        .agg(F.min(F.when(first, F.col("contig"))).alias("a"), F.min(F.when(~first, F.col("contig"))).alias("b"), F.min("match").alias("ok"), F.count("*").alias("n"))
        .where("n = 2")
        .drop("n")
    )


def counts(paired: DataFrame) -> DataFrame:
    """Contacts of each unordered pair of contigs, the diagonal included."""
    return paired.groupBy(F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).agg(F.count("*").alias("v"))


def accounting(records: DataFrame, contigs: DataFrame, match: Column, *order: str) -> DataFrame:
    """status and n: each pair is excluded by the contigs kept, a poor match, or of one or two contigs; odd last records
    of a name that has records after it in the whole order (by name, then by the given columns) are single."""
    known = contigs.select(F.col("contig").alias("known"))
    p = pairs(records, match, *order)
    a, b = known.withColumnRenamed("known", "ka"), known.withColumnRenamed("known", "kb")
    status = (
        F.when(F.col("ka").isNull() | F.col("kb").isNull(), "ref_excluded")
        .when(~F.col("ok"), "poor_match")
        .when(F.col("a") == F.col("b"), "same_contig")
        .otherwise("different_contig")
    )
    by = records.groupBy("qname").agg((F.count("*") % 2).alias("odd"))
    # the last name of all comes by a one-row maximum; its odd record meets the end of the file uncounted
    single = by.agg((F.sum("odd") - F.max_by("odd", "qname")).alias("n")).where("n > 0").select(F.lit("single").alias("status"), "n")
    return p.join(a, p.a == F.col("ka"), "left").join(b, p.b == F.col("kb"), "left").groupBy(status.alias("status")).agg(F.count("*").alias("n")).union(single)


def length_accounting(contigs: DataFrame, least: int) -> DataFrame:
    """How many contigs are long enough and how many are too short; a null length is too short."""
    enough = F.coalesce(F.col("length") >= least, F.lit(False))
    return contigs.agg(F.count_if(enough).alias("kept"), F.count_if(~enough).alias("too_short"))


def informative(same_contig: Column, distance: Column, mapq_a: Column, mapq_b: Column, flag_a: Column, flag_b: Column, apart: int = 10_000, strict: bool = False) -> Column:
    """Pairs that tell of contacts: both mapped (flag 4) with a mapping quality, no duplicate (flag 0x400), and of two
    contigs or far enough apart; strict leaves out all of one contig."""
    fine = (mapq_a != 0) & (mapq_b != 0)
    for flag in (flag_a, flag_b):
        fine = fine & (flag.bitwiseAND(F.lit(0x404)) == 0)
    return fine & (~same_contig if strict else ~same_contig | (F.abs(distance) >= apart))


def mate_gated(records: DataFrame, allowed: DataFrame) -> DataFrame:
    """Records of pairs (flag 1) whose both ends are mapped (flags 4 and 8), with both contigs in the allowed set."""
    gate = records.where(F.col("flag").bitwiseAND(F.lit(0x1 | 0x4 | 0x8)) == 1)
    for end in ("contig", "mate_contig"):
        gate = gate.join(allowed.select(F.col("contig").alias("__allowed")).distinct(), F.col(end) == F.col("__allowed"), "left_semi")
    return gate


def symmetric(edges: DataFrame) -> DataFrame:
    """The full matrix of an upper half; the input is read once."""
    both = F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    ends = F.when(F.col("i") == F.col("j"), F.slice(both, 1, 1)).otherwise(both)
    return edges.select(F.explode(ends).alias("x"), "v").select("x.i", "x.j", "v")


def off_diagonal(edges: DataFrame) -> DataFrame:
    return edges.where("i <> j")


def signal(edges: DataFrame, contigs: DataFrame) -> DataFrame:
    """contig, total and largest off-diagonal entry and the diagonal's; zeros for contigs without contacts."""
    full = symmetric(edges)
    off = F.when(F.col("i") != F.col("j"), F.col("v"))
    by = full.groupBy(F.col("i").alias("contig")).agg(
        F.sum(off).alias("signal"), F.max(off).alias("largest"), F.sum(F.when(F.col("i") == F.col("j"), F.col("v"))).alias("self")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return contigs.join(by, "contig", "left").select(*contigs.columns, zero("signal"), zero("largest"), zero("self"))


def restricted(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """Entries both of whose contigs are kept."""
    return edges.join(kept.select(F.col("contig").alias("i")), "i", "left_semi").join(kept.select(F.col("contig").alias("j")), "j", "left_semi").select("i", "j", "v")


def dual_counts(paired_by: DataFrame, first: Column, second: Column) -> DataFrame:
    """Two matrices under two match rules from one pass."""
    return paired_by.groupBy(F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).agg(
        F.count_if(first).alias("v_first"), F.count_if(second).alias("v_second")
    ).where("v_first > 0 or v_second > 0")


def map_weight(edges: DataFrame) -> DataFrame:
    """Total of the full matrix and whether it is empty."""
    total = F.coalesce(F.sum(F.when(F.col("i") == F.col("j"), F.col("v")).otherwise(2 * F.col("v"))), F.lit(0))
    return edges.agg(total.alias("weight"), (F.count("*") == 0).alias("is_empty"))


def quality_ratios(paired: DataFrame, informative: Column, inter: Column) -> DataFrame:
    """Pairs, informative share, and inter-contig against the other pairs (infinite without any)."""
    total, info, cross = F.count("*"), F.count_if(informative), F.count_if(inter)
    three = F.when(total - cross == 0, F.lit(float("inf"))).otherwise(cross / (total - cross))
    return paired.agg(total.alias("pairs"), info.alias("informative"), (info / total).alias("informative_ratio"), three.alias("three_d_ratio"))


def long_range(paired: DataFrame, share: float) -> DataFrame:
    """Intra n and inter m over each name's first pair; m / n and (n * share + m) / (n + m)."""
    once = paired.where("pair = 0")
    m, n = F.count_if(F.col("a") != F.col("b")), F.count_if(F.col("a") == F.col("b"))
    return once.agg(n.alias("intra"), m.alias("inter"), (m / n).alias("three_d"), ((n * share + m) / (n + m)).alias("long_range"))


def enrichment(paired: DataFrame, group: DataFrame) -> DataFrame:
    """Contacts inside and across groups of contigs (contig, grp), and their ratio."""
    g = lambda c: group.select(F.col("contig").alias(c), F.col("grp").alias(f"g_{c}"))
    both = paired.join(g("a"), "a").join(g("b"), "b")
    inside, across = F.count_if(F.col("g_a") == F.col("g_b")), F.count_if(F.col("g_a") != F.col("g_b"))
    ratio = F.when(across != 0, inside / across).when(inside != 0, F.lit(float("inf"))).otherwise(F.lit(0.0))
    return both.agg(inside.alias("inside"), across.alias("across"), ratio.alias("enrichment"))


def coverage_joined(info: DataFrame, coverage: DataFrame) -> DataFrame:
    """Left join on contig; repeated coverage rows fan out, a missing one is null."""
    return info.join(coverage, "contig", "left")
