"""Queries over alternative clusterings, their statistics and markers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bins, ordering
from .inputs import SQL_M, SQL_S, members, stats, table
from .registry import query


def own(spark, sf, name):
    return members(spark, sf).where(F.col("bin_set") == name)


@query("cluster_extents", f"with {SQL_M} select bin, cast(sum(length) as bigint) extent, count(*) size from m where bin_set = 'A' group by 1 having sum(length) >= 100000")
def cluster_extents(spark, sf):
    return bins.extents(own(spark, sf, "A"), 100000)


@query("large_cluster_count", f"with {SQL_M} select count(*) numcom from (select bin from m where bin_set = 'A' group by 1 having sum(length) >= 200000)")
def large_cluster_count(spark, sf):
    return bins.large_clusters(own(spark, sf, "A"), 200000)


SQL_RUN = """, d as (select bin, length, sum(length) over (partition by bin order by length desc, contig rows unbounded preceding) run, sum(length) over (partition by bin) total,
row_number() over (partition by bin order by length desc, contig) rn from m where bin_set = 'B')"""


@query("n50_l50_by_bin", f"""with {SQL_M} {SQL_RUN}, x as (select bin, min(rn) l50 from d where 2 * run >= total group by 1)
select d.bin, max(case when 2 * run >= total then length end) n50, any_value(l50) l50, count(*) - any_value(l50) + max(case when rn = l50 and 2 * run <> total then 1 else 0 end) m50,
cast(any_value(total) as bigint) total, count(*) n from d join x on x.bin = d.bin group by 1""")
def n50_l50_by_bin(spark, sf):
    return ordering.n50(own(spark, sf, "B"), "bin", "length", "contig").withColumns({c: F.col(c).cast("long") for c in ("l50", "m50")})


@query("n50_strict_by_bin", f"with {SQL_M} {SQL_RUN} select bin, max(case when 2 * run > total then length end) n50, min(case when 2 * run > total then rn end) l50 from d group by 1")
def n50_strict_by_bin(spark, sf):
    return ordering.n50(own(spark, sf, "B"), "bin", "length", "contig", strict=True).select("bin", "n50", F.col("l50").cast("long").alias("l50"))


@query("cluster_report", """select p_brand bin, count(*) size, cast(sum(p_size * 1000) as bigint) extent, round(sum(p_size * 1000 * p_retailprice) / sum(p_size * 1000), 4) expect,
round(avg(p_retailprice), 4) mean, round(quantile_cont(p_retailprice, 0.5), 4) median, round(stddev_pop(p_retailprice), 4) std from part group by 1""")
def cluster_report(spark, sf):
    m = table(spark, sf, "part").select(F.col("p_brand").alias("bin"), (F.col("p_size") * 1000).cast("long").alias("length"), F.col("p_retailprice").alias("value"))
    return bins.cluster_report(m, "value").withColumns({c: F.round(c, 4) for c in ("expect", "mean", "median", "std")})


@query("refine_intersection_2", f"""with {SQL_M} select a.bin "A", b.bin "B", count(*) contigs, cast(sum(a.length) as bigint) extent from m a join m b on a.contig = b.contig
where a.bin_set = 'A' and b.bin_set = 'B' group by 1, 2 having sum(a.length) >= 50000""")
def refine_intersection_2(spark, sf):
    return bins.intersections(members(spark, sf), ["A", "B"], 50000)


@query("refine_intersection_3", f"""with {SQL_M} select a.bin "A", b.bin "B", c.bin "C", count(*) contigs, cast(sum(a.length) as bigint) extent from m a join m b on a.contig = b.contig join m c on a.contig = c.contig
where a.bin_set = 'A' and b.bin_set = 'B' and c.bin_set = 'C' group by 1, 2, 3 having sum(a.length) >= 20000""")
def refine_intersection_3(spark, sf):
    return bins.intersections(members(spark, sf), ["A", "B", "C"], 20000)


SQL_OV = """, la as (select bin, sum(length) l from m where bin_set = 'A' group by 1), lb as (select bin, sum(length) l from m where bin_set = 'B' group by 1),
sh as (select a.bin bin_a, b.bin bin_b, sum(a.length) shared from m a join m b on a.contig = b.contig where a.bin_set = 'A' and b.bin_set = 'B' group by 1, 2),
ov as (select bin_a, bin_b, shared, 100.0 * greatest(shared / la.l, shared / lb.l) ratio from sh join la on la.bin = bin_a join lb on lb.bin = bin_b)"""


@query("bin_overlap", f"with {SQL_M} {SQL_OV} select bin_a, bin_b, cast(shared as bigint) shared, round(ratio, 6) ratio from ov")
def bin_overlap(spark, sf):
    return bins.overlaps(own(spark, sf, "A"), own(spark, sf, "B")).withColumn("ratio", F.round("ratio", 6))


@query("consolidate_best", f"""with {SQL_S} {SQL_OV}, a as (select bin, completeness - 5 * contamination score from s where bin_set = 'A'), b as (select bin, completeness - 5 * contamination score from s where bin_set = 'B'),
mt as (select a.bin bin_a, a.score sa, b.bin bin_b, b.score sb from ov join a on a.bin = bin_a join b on b.bin = bin_b where ratio >= 25),
best as (select bin_a, bin_b, sb from (select *, row_number() over (partition by bin_a order by sb desc, bin_b) r from mt) where r = 1)
select distinct case when sb > score then 'B' else 'A' end origin, case when sb > score then bin_b else a.bin end bin, round(case when sb > score then sb else score end, 4) score from a left join best on bin_a = a.bin
union all select 'B', bin, round(score, 4) from b where bin not in (select bin_b from mt)""")
def consolidate_best(spark, sf):
    s = stats(spark, sf)
    ov = bins.overlaps(own(spark, sf, "A"), own(spark, sf, "B"))
    return bins.consolidated(s.where("bin_set = 'A'"), s.where("bin_set = 'B'"), ov, 25.0).withColumn("score", F.round("score", 4))


SQL_RANK = "(select contig, m.bin, row_number() over (partition by contig order by completeness - 5 * contamination + 1e-10 * s.n50 desc, m.bin desc) r from m join s on s.bin_set = m.bin_set and s.bin = m.bin)"


@query("dereplicate_best", f"with {SQL_S} select contig, bin from {SQL_RANK} where r = 1")
def dereplicate_best(spark, sf):
    return bins.dereplicated(members(spark, sf).select("bin", "contig"), stats(spark, sf))


@query("dereplicate_remove", "with m as (select distinct l_returnflag bin, l_orderkey contig from lineitem) select contig, bin from m where contig in (select contig from m group by 1 having count(*) = 1)")
def dereplicate_remove(spark, sf):
    m = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("bin"), F.col("l_orderkey").alias("contig")).distinct()
    return bins.dereplicated(m, stats(spark, sf), remove=True)


@query("best_version", f"""with {SQL_S} select base, version, round(score, 4) score from (select substring(bin, 1, 8) base, bin version, completeness + 5 * (100 - contamination) score,
row_number() over (partition by substring(bin, 1, 8) order by completeness + 5 * (100 - contamination) desc, n50 desc, bin desc) r from s) where r = 1""")
def best_version(spark, sf):
    s = stats(spark, sf).withColumn("base", F.substring("bin", 1, 8)).withColumn("version", F.col("bin"))
    return bins.best_versions(s).withColumn("score", F.round("score", 4))


@query("good_bins", f"with {SQL_S} select bin_set, bin from s where completeness between 74 and 100 and contamination between 0 and 4.1")
def good_bins(spark, sf):
    return stats(spark, sf).where(bins.good(74, 4.1)).select("bin_set", "bin")


@query("good_bins_strict", f"with {SQL_S} select bin_set, bin from s where completeness > 74 and contamination < 4.1")
def good_bins_strict(spark, sf):
    return stats(spark, sf).where(bins.good(74, 4.1, strict=True)).select("bin_set", "bin")


@query("best_bin_set", f"with {SQL_S} select bin_set, count(*) n from s where completeness between 74 and 100 and contamination between 0 and 4.1 group by 1 order by n desc, bin_set limit 1")
def best_bin_set(spark, sf):
    return stats(spark, sf).where(bins.good(74, 4.1)).groupBy("bin_set").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "bin_set").limit(1)


@query("bin_byte_gate", f"with {SQL_M} select bin_set, bin, cast(sum(length + length(cast(contig as varchar)) + 2) as bigint) bytes from m group by 1, 2 having sum(length + length(cast(contig as varchar)) + 2) > 50000 and sum(length + length(cast(contig as varchar)) + 2) < 20000000")
def bin_byte_gate(spark, sf):
    size = F.sum(F.col("length") + F.length(F.col("contig").cast("string")) + 2)
    return members(spark, sf).groupBy("bin_set", "bin").agg(size.alias("bytes")).where("bytes > 50000 and bytes < 20000000")


@query("graded_score", f"""with {SQL_S} select bin_set, cast(sum(case when contamination <= 5 then case when completeness >= 90 then 3 when completeness >= 70 then 2 when completeness >= 50 then 1 else 0 end else 0 end) as bigint) score from s group by 1""")
def graded_score(spark, sf):
    return stats(spark, sf).groupBy("bin_set").agg(F.sum(bins.graded()).alias("score"))


@query("quality_grid", f"""with {SQL_S} select bin_set, count(case when completeness >= 90 and contamination <= 5 then 1 end) c90_x5, count(case when completeness >= 90 and contamination <= 10 then 1 end) c90_x10,
count(case when completeness >= 70 and contamination <= 5 then 1 end) c70_x5, count(case when completeness >= 70 and contamination <= 10 then 1 end) c70_x10 from s group by 1""")
def quality_grid(spark, sf):
    return bins.quality_grid(stats(spark, sf), [90, 70], [5, 10])


@query("rank_curves", f"""with {SQL_S} select bin_set, bin, row_number() over (partition by bin_set order by completeness desc, bin) rank_completeness, row_number() over (partition by bin_set order by contamination, bin) rank_contamination,
row_number() over (partition by bin_set order by n50 desc, bin) rank_n50 from s where completeness between 70 and 100 and contamination between 0 and 10""")
def rank_curves(spark, sf):
    return bins.rank_curves(stats(spark, sf), 70, 10).withColumns({c: F.col(c).cast("long") for c in ("rank_completeness", "rank_contamination", "rank_n50")})


@query("bin_stats_summary", f"""with {SQL_S} select bin, substring(cast(completeness as varchar), 1, 5) completeness, 'Unknown' lineage, n50, extent size, coalesce(k.binner, 'Unknown') binner
from s left join (values ('A', 'first'), ('B', 'second')) k(bin_set, binner) on k.bin_set = s.bin_set""")
def bin_stats_summary(spark, sf):
    from ..functions.columns import truncated

    k = spark.createDataFrame([("A", "first"), ("B", "second")], "bin_set string, binner string")
    return stats(spark, sf).join(k, "bin_set", "left").select("bin", truncated(F.col("completeness")).alias("completeness"), F.lit("Unknown").alias("lineage"), "n50", F.col("extent").alias("size"), F.coalesce("binner", F.lit("Unknown")).alias("binner"))


SQL_H = "h as (select p_type marker, l_suppkey contig, p_size qlen, l_partkey % 40 bin from lineitem join part on p_partkey = l_partkey)"


def hits(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return li.join(p, li.l_partkey == p.p_partkey).select(F.col("p_type").alias("marker"), F.col("l_suppkey").alias("contig"), F.col("p_size").alias("qlen"), (F.col("l_partkey") % 40).alias("bin"))


@query("marker_counts", f"with {SQL_H} select contigs, count(*) markers from (select marker, count(distinct contig) contigs from h group by 1) group by 1")
def marker_counts(spark, sf):
    return bins.marker_counts(hits(spark, sf))


@query("seed_marker_median", f"""with {SQL_H}, c as (select marker, count(distinct contig) contigs, min(qlen) qlen from h group by 1), o as (select *, row_number() over (order by contigs) - 1 k from c),
md as (select contigs median from o where k = (select count(*) // 2 from c)) select marker, qlen, median from c, md where contigs = median and median > 1 order by qlen, marker limit 1""")
def seed_marker_median(spark, sf):
    return bins.seed_marker(hits(spark, sf))


@query("seed_marker_contigs", f"""with {SQL_H}, c as (select marker, count(distinct contig) contigs, min(qlen) qlen from h group by 1), o as (select *, row_number() over (order by contigs) - 1 k from c),
md as (select contigs median from o where k = (select count(*) // 2 from c)), b as (select marker from c, md where contigs = median and median > 1 order by qlen, marker limit 1)
select count(distinct contig) num_gene from h where marker in (select marker from b)""")
def seed_marker_contigs(spark, sf):
    h = hits(spark, sf)
    return h.join(F.broadcast(bins.seed_marker(h).select("marker")), "marker", "left_semi").agg(F.count_distinct("contig").alias("num_gene"))


@query("marker_iteration_order", f"""with {SQL_H}, q as (select distinct marker, contig from h), o as (select contig, count(*) m from q group by 1) select marker, count(*) contigs, cast(sum(m) as bigint) load from q join o on o.contig = q.contig group by 1""")
def marker_iteration_order(spark, sf):
    return bins.marker_order(hits(spark, sf))


@query("marker_coverage", "select p_type marker, count(*) n from part where p_size - 1 > 40 * 0.9 group by 1")
def marker_coverage(spark, sf):
    return table(spark, sf, "part").where("p_size - 1 > 40 * 0.9").groupBy(F.col("p_type").alias("marker")).agg(F.count("*").alias("n"))


@query("marker_completeness", f"""with {SQL_H}, ms as (select distinct p_type marker, length(p_type) % 3 set_id from part), c as (select bin, marker, count(*) c from h group by 1, 2), z as (select set_id, count(*) size from ms group by 1),
p as (select bin, c.marker, set_id, c from c join ms on ms.marker = c.marker), g as (select bin, set_id, count(*) found, sum(c - 1) extra from p group by 1, 2)
select bin, round(100.0 * sum(found / size) / (select count(*) from z), 6) completeness, round(100.0 * sum(extra / size) / (select count(*) from z), 6) contamination from g join z on z.set_id = g.set_id group by 1""")
def marker_completeness(spark, sf):
    sets = table(spark, sf, "part").select(F.col("p_type").alias("marker"), (F.length("p_type") % 3).alias("set_id")).distinct()
    return bins.completeness(hits(spark, sf), sets).withColumns({c: F.round(c, 6) for c in ("completeness", "contamination")})


@query("marker_bin_matrix", f"with {SQL_H} select bin, count(*) total, count(distinct marker) found, round(count(distinct marker) / (select count(distinct p_type) from part), 6) completeness from h group by 1")
def marker_bin_matrix(spark, sf):
    n = table(spark, sf, "part").agg(F.count_distinct("p_type").alias("n"))
    by = hits(spark, sf).groupBy("bin").agg(F.count("*").alias("total"), F.count_distinct("marker").alias("found"))
    return by.crossJoin(F.broadcast(n)).select("bin", "total", "found", F.round(F.col("found") / F.col("n"), 6).alias("completeness"))


@query("gene_table", f"with {SQL_H} select bin, marker, count(*) copies, cast(sum(contig) as bigint) checksum from h group by 1, 2")
def gene_table(spark, sf):
    lists = hits(spark, sf).groupBy("bin", "marker").agg(F.collect_list("contig").alias("contigs"))  # one marker's copies in one bin
    return lists.select("bin", "marker", F.size("contigs").cast("long").alias("copies"), F.aggregate("contigs", F.lit(0).cast("long"), lambda a, x: a + x).alias("checksum"))


@query("quality_full_join", f"""with {SQL_S} select coalesce(a.n50, b.n50) n50, a.c ca, b.c cb from (select n50, count(*) c from s where bin_set = 'A' group by 1) a full join (select n50, count(*) c from s where bin_set = 'B' group by 1) b on a.n50 = b.n50""")
def quality_full_join(spark, sf):
    g = lambda n, c: stats(spark, sf).where(F.col("bin_set") == n).groupBy("n50").agg(F.count("*").alias(c))
    return g("A", "ca").join(g("B", "cb"), "n50", "full")


@query("top_longest", "select p_partkey contig, p_size * 1000 + p_partkey % 1000 length from part order by length desc, contig limit 100")
def top_longest(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("contig"), (F.col("p_size") * 1000 + F.col("p_partkey") % 1000).alias("length")).orderBy(F.desc("length"), "contig").limit(100)


@query("first_seen", "select l_orderkey k, l_partkey part from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) r from lineitem) where r = 1")
def first_seen(spark, sf):
    d = ordering.first_seen(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return d.select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("part"))


@query("gap_remap", """select p_brand grp, p_partkey k, cast(sum(case when p_size > 10 then 0 else 1 end) over w as bigint) shift, cast(case when p_size > 10 then sum(case when p_size > 10 then 1 else 0 end) over w - 1 end as bigint) gapless
from part window w as (partition by p_brand order by p_partkey rows unbounded preceding)""")
def gap_remap(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("grp"), F.col("p_partkey").alias("k"), "p_size")
    return ordering.gap_shift(p, "grp", "k", F.col("p_size") > 10).select("grp", "k", "shift", "gapless")


@query("mask_reposition", "select p_brand grp, p_partkey k, row_number() over (partition by p_brand order by p_size > 10 desc, p_partkey) - 1 place from part")
def mask_reposition(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("grp"), F.col("p_partkey").alias("k"), (F.col("p_size") > 10).alias("mask"))
    return ordering.repositioned(p, "grp", "mask", "k").select("grp", "k", F.col("place").cast("long").alias("place"))


@query("running_offset", "select p_brand grp, p_partkey k, cast(coalesce(sum(p_size) over (partition by p_brand order by p_partkey rows between unbounded preceding and 1 preceding), 0) as bigint) \"offset\" from part")
def running_offset(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("grp"), F.col("p_partkey").alias("k"), "p_size")
    return ordering.running_offsets(p, "grp", ["k"], "p_size").select("grp", "k", F.col("offset").cast("long").alias("offset"))


@query("dense_ids", "select s_suppkey contig, row_number() over (order by s_suppkey) - 1 localid from supplier")
def dense_ids(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("contig"))
    return ordering.dense_numbers(s, "contig", "localid")


@query("zscores", "select p_partkey k, round((p_size - avg(p_size) over ()) / stddev_pop(p_size) over (), 6) z from part")
def zscores(spark, sf):
    return ordering.zscores(table(spark, sf, "part").select(F.col("p_partkey").alias("k"), "p_size"), "p_size").select("k", F.round("z_p_size", 6).alias("z"))


@query("rank_clusters", f"""with {SQL_M}, x as (select bin, count(*) n from m where bin_set = 'B' group by 1) select bin, n, 'CL' || lpad(cast(row_number() over (order by n desc, bin) as varchar), 4, '0') name from x""")
def rank_clusters(spark, sf):
    from pyspark.sql import Window

    from ..functions.columns import padded

    x = own(spark, sf, "B").groupBy("bin").agg(F.count("*").alias("n"))  # one row a cluster: the ranks are of clusters
    return x.select("bin", "n", padded("CL", F.row_number().over(Window.orderBy(F.desc("n"), "bin"))).alias("name"))


@query("set_symmetric_difference", "(select p_size + 10 v, 'left' side from part except select cast(l_quantity as int), 'left' from lineitem) union all (select cast(l_quantity as int), 'right' from lineitem except select p_size + 10, 'right' from part)")
def set_symmetric_difference(spark, sf):
    a = table(spark, sf, "part").select((F.col("p_size") + 10).alias("v")).distinct()
    b = table(spark, sf, "lineitem").select(F.col("l_quantity").cast("int").alias("v")).distinct()
    return a.join(b, "v", "left_anti").withColumn("side", F.lit("left")).union(b.join(a, "v", "left_anti").withColumn("side", F.lit("right")))


@query("bipartite_weights", """with q as (select l_suppkey u, l_partkey % 7 b, l_quantity v from lineitem), s as (select distinct l_suppkey u from lineitem), t as (select unnest(range(7)) b)
select s.u, t.b, round(-coalesce(avg(v), 0), 6) w from s cross join t left join q on q.u = s.u and q.b = t.b group by 1, 2""")
def bipartite_weights(spark, sf):
    li = table(spark, sf, "lineitem")
    q = li.groupBy(F.col("l_suppkey").alias("u"), (F.col("l_partkey") % 7).alias("b")).agg(F.avg("l_quantity").alias("v"))
    # every pair of a contig and a bin is the result; the seven bins are the side of a known size
    every = li.select(F.col("l_suppkey").alias("u")).distinct().crossJoin(F.broadcast(spark.range(7).withColumnRenamed("id", "b")))
    return every.join(q, ["u", "b"], "left").select("u", "b", F.round(-F.coalesce("v", F.lit(0.0)), 6).alias("w"))


@query("greedy_ensemble")
def greedy_ensemble(spark, sf):
    m = members(spark, sf)

    def quality(left):
        g = left.groupBy("bin_set", "bin").agg(F.sum("length").alias("extent"), F.max("length").alias("n50"), F.count("*").alias("n"))
        return g.withColumn("completeness", F.least(F.lit(100.0), F.col("n") * 10.0)).withColumn("contamination", (F.col("n50") % 10000) / 2000.0)

    return bins.greedy_ensemble(m, quality)
