"""Order-dependent operators: dense numbers, gap remaps, ranks, first-seen, cumulative order statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_numbers(df: DataFrame, order: str, name: str) -> DataFrame:
    """Rows numbered from 0 in a total order without a single task: rows are range-partitioned and stored with their
    partition, numbered within it, and shifted by the sizes of the partitions before (one number for each partition)."""
    from ..sources.tables import stored

    parts = stored(df.repartitionByRange(F.col(order)).withColumn("__part", F.spark_partition_id()))
    sizes = parts.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__before", F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))).drop("__n")
    rn = F.row_number().over(Window.partitionBy("__part").orderBy(order))
    return (
        parts.withColumn("__rn", rn)
        .join(F.broadcast(before), "__part")
        .withColumn(name, (F.col("__rn") - 1 + F.coalesce("__before", F.lit(0))).cast("long"))
        .drop("__part", "__rn", "__before")
    )


def running_offsets(df: DataFrame, group: str, order: list[str], size: str) -> DataFrame:
    """Sum of the sizes before each row of its group."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("offset", F.coalesce(F.sum(size).over(w), F.lit(0)))


def gap_shift(df: DataFrame, group: str, order: str, mask: Column) -> DataFrame:
    """Rows left out before each row, and each accepted row's place without gaps."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("shift", F.sum(F.when(mask, 0).otherwise(1)).over(w)).withColumn("gapless", F.when(mask, F.sum(F.when(mask, 1).otherwise(0)).over(w) - 1))


def repositioned(df: DataFrame, group: str, mask: str, pos: str) -> DataFrame:
    """Accepted rows first in their order, then the others."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(mask), pos)) - 1)


def ordered(contigs: DataFrame, order: DataFrame) -> DataFrame:
    """contigs with place (from 0, in the given order's) and orientation of (contig, at, orientation); contigs that the order
    leaves out are excluded by it. An order that names a contig twice, or one that is unknown, is an error."""
    wrong = order.groupBy("contig").agg(F.count("*").alias("n")).join(contigs.select("contig").withColumn("known", F.lit(True)).distinct(), "contig", "left").where("n > 1 or known is null").limit(1).collect()
    if wrong:
        raise ValueError(f"the order names {wrong[0].contig} {'twice' if wrong[0].n > 1 else 'although it is unknown'}")
    place = dense_numbers(order.select("contig", "orientation", "at"), "at", "place")
    return contigs.join(place.drop("at"), "contig", "left").withColumn("accepted", F.col("place").isNotNull())


def first_seen(df: DataFrame, key: str, *order: str) -> DataFrame:
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__rn = 1").drop("__rn")


def ranked(df: DataFrame, group: list[str], *order) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def n50(df: DataFrame, group: str, length: str, *ties: str, strict: bool = False) -> DataFrame:
    """group, n50, l50, m50, total and n: the length at which the running sum of descending lengths reaches (strict:
    passes) half; l50 its rank; m50 the other rows, one more if the running sum is not exactly half."""
    order = [F.desc(length), *ties]
    run = F.sum(length).over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    whole = Window.partitionBy(group)
    d = df.withColumns({"__run": run, "__total": F.sum(length).over(whole), "__rn": F.row_number().over(Window.partitionBy(group).orderBy(*order))})
    reached = 2 * F.col("__run") > F.col("__total") if strict else 2 * F.col("__run") >= F.col("__total")
    at = F.min(F.when(reached, F.col("__rn")))
    exact = F.min_by(2 * F.col("__run") == F.col("__total"), F.when(reached, F.col("__rn")))
    return d.groupBy(group).agg(
        F.max(F.when(reached, F.col(length))).alias("n50"), at.alias("l50"),
        (F.count("*") - at + F.when(exact, 0).otherwise(1)).alias("m50"), F.max("__total").alias("total"), F.count("*").alias("n"),
    )


def zscores(df: DataFrame, *columns: str, group: str | None = None) -> DataFrame:
    """Population z-scores; zeros where the deviation is zero. Without a group the two moments come by a one-row join."""
    if group is not None:
        w = Window.partitionBy(group)
        return df.withColumns({f"z_{c}": F.when(F.stddev_pop(c).over(w) == 0, 0.0).otherwise((F.col(c) - F.avg(c).over(w)) / F.stddev_pop(c).over(w)) for c in columns})
    one = df.agg(*[x for c in columns for x in (F.avg(c).alias(f"__m_{c}"), F.stddev_pop(c).alias(f"__s_{c}"))])
    z = {f"z_{c}": F.when(F.col(f"__s_{c}") == 0, 0.0).otherwise((F.col(c) - F.col(f"__m_{c}")) / F.col(f"__s_{c}")) for c in columns}
    return df.crossJoin(F.broadcast(one)).withColumns(z).drop(*one.columns)
