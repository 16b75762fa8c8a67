"""The driver's tables in the roles of alignments, contigs, bins and their statistics, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contacts

ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("qname"), F.col("l_suppkey").alias("contig"), F.col("l_quantity").alias("mapq"), *ORDER
    )


def paired(spark: SparkSession, sf_dir: str, mapq: int = 10) -> DataFrame:
    return contacts.pairs(records(spark, sf_dir), F.col("mapq") >= mapq, *ORDER)


def edges(spark: SparkSession, sf_dir: str, mapq: int = 10) -> DataFrame:
    return contacts.counts(paired(spark, sf_dir, mapq).where("ok"))


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.alias("contig"), (1000 + k * 7919 % 50000).alias("length"), (k * 31 % 17).alias("sites"), (F.abs("s_acctbal") / 100).alias("coverage")
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three clusterings of the parts: by brand, by type and by size."""
    p = table(spark, sf_dir, "part")
    length = (F.col("p_size") * 1000).cast("long").alias("length")
    one = lambda s, b: p.select(F.lit(s).alias("bin_set"), b.alias("bin"), F.col("p_partkey").alias("contig"), length)
    return one("A", F.col("p_brand")).union(one("B", F.col("p_type"))).union(one("C", F.concat(F.lit("size"), (F.col("p_size") % 7).cast("string"))))


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality figures of the bins of all three sets, from the discounts and taxes of the parts' line items."""
    m = members(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.avg("l_discount").alias("d"), F.avg("l_tax").alias("t"))
    return (
        m.join(li, m.contig == li.l_partkey)
        .groupBy("bin_set", "bin")
        .agg(
            F.round(F.avg("d") * 1500, 4).alias("completeness"), F.round(F.avg("t") * 100, 4).alias("contamination"), F.max("length").alias("n50"), F.sum("length").alias("extent"),
        )
    )


SQL_P = """r as (select l_orderkey qname, l_suppkey contig, l_quantity mapq, row_number() over (partition by l_orderkey
 order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) rn from lineitem),
p as (select qname, cast(floor((rn - 1) / 2) as bigint) pair, min(case when rn % 2 = 1 then contig end) a, min(case when rn % 2 = 0 then contig end) b,
 min(mapq) mapq from r group by 1, 2 having count(*) = 2)"""
SQL_E = SQL_P + """,
e as (select least(a, b) i, greatest(a, b) j, count(*) v from p where mapq >= 10 group by 1, 2),
full_e as (select i, j, v from e union all select j, i, v from e where i <> j)"""
SQL_V = """vert as (select s_suppkey contig, 1000 + s_suppkey * 7919 % 50000 length, s_suppkey * 31 % 17 sites, abs(s_acctbal) / 100 coverage from supplier)"""
SQL_M = """m as (select 'A' bin_set, p_brand bin, p_partkey contig, cast(p_size * 1000 as bigint) length from part
 union all select 'B', p_type, p_partkey, cast(p_size * 1000 as bigint) from part
 union all select 'C', 'size' || (p_size % 7), p_partkey, cast(p_size * 1000 as bigint) from part)"""
SQL_S = SQL_M + """,
li as (select l_partkey, avg(l_discount) d, avg(l_tax) t from lineitem group by 1),
s as (select bin_set, bin, round(avg(d) * 1500, 4) completeness, round(avg(t) * 100, 4) contamination, max(length) n50, cast(sum(length) as bigint) extent
 from m join li on contig = l_partkey group by 1, 2)"""
