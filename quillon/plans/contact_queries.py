"""Queries over pairs and contact matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import contacts, matrix
from .inputs import ORDER, SQL_E, SQL_P, SQL_V, contigs, edges, paired, records, table
from .registry import query

MU = "exp(0.3 * ln(sites + 1) + 0.2 * ln(length) + 0.1 * ln(coverage + 1))"


@query("contact_pairs_raw", f"with {SQL_P} select least(a, b) i, greatest(a, b) j, count(*) v from p group by 1, 2")
def contact_pairs_raw(spark, sf):
    return contacts.counts(paired(spark, sf))


@query("contact_counts_filtered", f"with {SQL_E} select i, j, v from e")
def contact_counts_filtered(spark, sf):
    return edges(spark, sf)


@query("flagship_scaled_contacts", f"""with {SQL_E}, {SQL_V}, mu as (select contig, {MU} mu from vert),
w as (select i, j, (select max(mu) from mu) * v / sqrt(a.mu * b.mu) v from e join mu a on a.contig = i join mu b on b.contig = j where i <> j)
select i, j, round(v, 6) v from w where v >= (select quantile_cont(v, 0.05) from w)""")
def flagship(spark, sf):
    scaled = matrix.regression_scaled(edges(spark, sf), contigs(spark, sf), F.expr(MU))
    return matrix.above_percentile(scaled, 5, keep_equal=True).select("i", "j", F.round("v", 6).alias("v"))


@query("contact_signal", f"""with {SQL_E} select s_suppkey contig, cast(coalesce(sum(case when i <> j then v end), 0) as bigint) signal,
coalesce(max(case when i <> j then v end), 0) largest, cast(coalesce(sum(case when i = j then v end), 0) as bigint) self
from supplier left join full_e on i = s_suppkey group by 1""")
def contact_signal(spark, sf):
    return contacts.signal(edges(spark, sf), contigs(spark, sf).select("contig"))


@query("contig_table", f"""with {SQL_E}, {SQL_V}, g as (select i, sum(case when i <> j then v else 0 end) signal, sum(case when i = j then v else 0 end) self from full_e group by 1)
select contig, sites, length, cast(coalesce(self, 0) as bigint) covcc, cast(coalesce(signal, 0) as bigint) signal from vert left join g on i = contig""")
def contig_table(spark, sf):
    s = contacts.signal(edges(spark, sf), contigs(spark, sf).drop("coverage"))
    return s.select("contig", "sites", "length", F.col("self").alias("covcc"), "signal")


@query("contact_min_signal", f"""with {SQL_E}, keep as (select i contig from full_e where i <> j group by 1 having max(v) >= 4)
select i, j, v from e where i in (select contig from keep) and j in (select contig from keep)""")
def contact_min_signal(spark, sf):
    e = edges(spark, sf)
    return contacts.restricted(e, contacts.signal(e, contigs(spark, sf)).where("largest >= 4"))


@query("contact_strict_filter", f"""with {SQL_E}, {SQL_V}, g as (select i, sum(case when i <> j then v else 0 end) sig, sum(case when i = j then v else 0 end) diag from full_e group by 1)
select contig, cast(sig as bigint) signal from vert join g on i = contig where sig >= 2 and diag > 0 and sites > 0""")
def contact_strict_filter(spark, sf):
    s = contacts.signal(edges(spark, sf), contigs(spark, sf))
    return s.where("signal >= 2 and self > 0 and sites > 0").select("contig", "signal")


@query("acceptance_mask", f"""with {SQL_E}, {SQL_V}, g as (select i, max(v) top from full_e where i <> j group by 1)
select contig, length >= 5000 and coalesce(top, 0) >= 3 accepted from vert left join g on i = contig""")
def acceptance_mask(spark, sf):
    s = contacts.signal(edges(spark, sf), contigs(spark, sf))
    return s.select("contig", ((F.col("length") >= 5000) & (F.col("largest") >= 3)).alias("accepted"))


@query("pair_accounting", f"""with {SQL_P}, k as (select s_suppkey contig from supplier where abs(s_acctbal) >= 2000), c as (select l_orderkey q, count(*) % 2 odd from lineitem group by 1), g as (select sum(odd) - max_by(odd, q) n from c)
select case when ka.contig is null or kb.contig is null then 'ref_excluded' when mapq < 10 then 'poor_match' when a = b then 'same_contig' else 'different_contig' end status,
count(*) n from p left join k ka on ka.contig = a left join k kb on kb.contig = b group by 1 union all select 'single', cast(n as bigint) from g where n > 0""")
def pair_accounting(spark, sf):
    kept = contigs(spark, sf).where("coverage >= 20")
    return contacts.accounting(records(spark, sf), kept, F.col("mapq") >= 10, *ORDER)


@query("dual_contact_map", f"""with {SQL_P} select least(a, b) i, greatest(a, b) j, count(case when mapq >= 10 then 1 end) v_first, count(case when mapq >= 25 then 1 end) v_second
from p group by 1, 2 having count(case when mapq >= 10 then 1 end) > 0""")
def dual_contact_map(spark, sf):
    rec = contacts.numbered(records(spark, sf), *ORDER)
    first = F.col("rn") % 2 == 1
    p = rec.groupBy("qname", "pair").agg(F.min(F.when(first, F.col("contig"))).alias("a"), F.min(F.when(~first, F.col("contig"))).alias("b"), F.min("mapq").alias("mapq"), F.count("*").alias("n")).where("n = 2")
    return contacts.dual_counts(p, F.col("mapq") >= 10, F.col("mapq") >= 25)


@query("map_weight", f"with {SQL_E} select cast(coalesce(sum(v), 0) as bigint) weight, count(*) = 0 is_empty from full_e")
def map_weight(spark, sf):
    return contacts.map_weight(edges(spark, sf))


@query("hic_qc_ratios", f"""with {SQL_P} select count(*) pairs, count(case when mapq >= 10 then 1 end) informative, round(count(case when mapq >= 10 then 1 end) / count(*), 6) informative_ratio,
round(count(case when a <> b then 1 end) / (count(*) - count(case when a <> b then 1 end)), 6) three_d_ratio from p""")
def hic_qc_ratios(spark, sf):
    q = contacts.quality_ratios(paired(spark, sf), F.col("ok"), F.col("a") != F.col("b"))
    return q.withColumns({c: F.round(c, 6) for c in ("informative_ratio", "three_d_ratio")})


@query("long_range_ratio", f"""with {SQL_P}, o as (select * from p where pair = 0), c as (select count(case when a = b then 1 end) n, count(case when a <> b then 1 end) m from o)
select n intra, m inter, round(m / n, 6) three_d, round((n * 0.25 + m) / (n + m), 6) long_range from c""")
def long_range_ratio(spark, sf):
    q = contacts.long_range(paired(spark, sf), 0.25)
    return q.withColumns({c: F.round(c, 6) for c in ("three_d", "long_range")})


@query("enrichment_ratio", f"""with {SQL_P}, g as (select s_suppkey contig, s_nationkey grp from supplier)
select count(case when x.grp = y.grp then 1 end) inside, count(case when x.grp <> y.grp then 1 end) across,
round(count(case when x.grp = y.grp then 1 end) / count(case when x.grp <> y.grp then 1 end), 6) enrichment from p join g x on x.contig = a join g y on y.contig = b""")
def enrichment_ratio(spark, sf):
    g = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("contig"), F.col("s_nationkey").alias("grp"))
    return contacts.enrichment(paired(spark, sf), g).withColumn("enrichment", F.round("enrichment", 6))


@query("coverage_left_join", """select s_suppkey contig, s_name name, o.coverage from supplier left join
(select o_custkey ck, round(avg(o_totalprice), 4) coverage from orders group by 1) o on o.ck = s_suppkey""")
def coverage_left_join(spark, sf):
    info = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("contig"), F.col("s_name").alias("name"))
    cov = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("contig")).agg(F.round(F.avg("o_totalprice"), 4).alias("coverage"))
    return contacts.coverage_joined(info, cov)


@query("reference_joined", """select s_suppkey contig, c_name name, s_nationkey = c_nationkey same from supplier join customer on s_suppkey = c_custkey""")
def reference_joined(spark, sf):
    s, c = table(spark, sf, "supplier"), table(spark, sf, "customer")
    return s.join(c, s.s_suppkey == c.c_custkey).select(F.col("s_suppkey").alias("contig"), F.col("c_name").alias("name"), (F.col("s_nationkey") == F.col("c_nationkey")).alias("same"))


@query("flag_filtered", """select l_returnflag, count(*) n from lineitem where (l_linenumber & 1) = 1 and (l_linenumber & 4) = 0 and l_quantity >= 30 group by 1""")
def flag_filtered(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.where(C.has(F.col("l_linenumber"), 1, 4) & (F.col("l_quantity") >= 30)).groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("read_split", """with shot as (select distinct user_id from events where value <> 0 and value >= -50 and value <= 50)
select 'shotgun' part, count(*) n from shot union all select 'clean', count(*) from (select distinct user_id from events where user_id not in (select user_id from shot))""")
def read_split(spark, sf):
    e = table(spark, sf, "events").select("user_id", "value")
    shot = e.where("value <> 0 and value between -50 and 50").select("user_id").distinct()
    clean = e.select("user_id").distinct().join(shot, "user_id", "left_anti")
    n = lambda d, name: d.agg(F.lit(name).alias("part"), F.count("*").alias("n"))
    return n(shot, "shotgun").union(n(clean, "clean"))


@query("recruit_tiers", f"""with {SQL_P}, g as (select s_suppkey contig, s_nationkey bin from supplier), k as (select x.bin, mapq from p join g x on x.contig = a join g y on y.contig = b where x.bin = y.bin or a = b)
select bin, 'strict' tier, count(*) n from k where mapq < 10 group by 1 union all select bin, 'permissive', count(*) from k where mapq < 25 group by 1""")
def recruit_tiers(spark, sf):
    g = lambda c: table(spark, sf, "supplier").select(F.col("s_suppkey").alias(c), F.col("s_nationkey").alias(f"bin_{c}"))
    rec = contacts.numbered(records(spark, sf), *ORDER)
    first = F.col("rn") % 2 == 1
    p = rec.groupBy("qname", "pair").agg(F.min(F.when(first, F.col("contig"))).alias("a"), F.min(F.when(~first, F.col("contig"))).alias("b"), F.min("mapq").alias("mapq"), F.count("*").alias("n")).where("n = 2")
    kept = p.join(g("a"), "a").join(g("b"), "b").where("bin_a = bin_b or a = b")
    tiers = F.filter(F.array(F.when(F.col("mapq") < 10, "strict"), F.when(F.col("mapq") < 25, "permissive")), lambda t: t.isNotNull())
    return kept.select(F.col("bin_a").alias("bin"), F.explode(tiers).alias("tier")).groupBy("bin", "tier").agg(F.count("*").alias("n"))


@query("mge_host_contacts", f"""with {SQL_E}, k as (select s_suppkey contig, case when s_nationkey < 5 then 'mge' when s_nationkey < 15 then 'host' end kind from supplier)
select case when a.kind = 'mge' then i else j end mge, case when a.kind = 'mge' then j else i end host, v from e join k a on a.contig = i join k b on b.contig = j
where v > 0 and (a.kind = 'mge' and b.kind = 'host' or a.kind = 'host' and b.kind = 'mge')""")
def mge_host_contacts(spark, sf):
    kind = F.when(F.col("s_nationkey") < 5, "mge").when(F.col("s_nationkey") < 15, "host")
    k = lambda e: table(spark, sf, "supplier").select(F.col("s_suppkey").alias(e), kind.alias(f"k{e}"))
    both = edges(spark, sf).where("v > 0").join(k("i"), "i").join(k("j"), "j").where("ki = 'mge' and kj = 'host' or ki = 'host' and kj = 'mge'")
    own = F.col("ki") == "mge"
    return both.select(F.when(own, F.col("i")).otherwise(F.col("j")).alias("mge"), F.when(own, F.col("j")).otherwise(F.col("i")).alias("host"), "v")


@query("prefix_counts", """select count(*) total, count(case when starts_with(p_type, 'S') then 1 end) bins, count(case when starts_with(p_type, 'M') then 1 end) unmapped from part""")
def prefix_counts(spark, sf):
    t = F.col("p_type")
    return table(spark, sf, "part").agg(F.count("*").alias("total"), F.count_if(t.startswith("S")).alias("bins"), F.count_if(t.startswith("M")).alias("unmapped"))


@query("overlap_merge", """with o as (select l_orderkey k, l_linenumber s, l_linenumber + cast(round(l_quantity / 20) as int) e from lineitem), f as (select *, max(e) over (partition by k order by s, e rows between unbounded preceding and 1 preceding) pe from o),
g as (select *, sum(case when pe is null or s > pe then 1 else 0 end) over (partition by k order by s, e rows unbounded preceding) w from f)
select k, cast(w as bigint) w, min(s) s, max(e) e, count(*) n from g group by 1, 2""")
def overlap_merge(spark, sf):
    from pyspark.sql import Window

    o = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("s"), (F.col("l_linenumber") + F.expr("cast(round(l_quantity / 20) as int)")).alias("e"))
    # both windows are over one sort, so items alike in s and e may come in any order; nulls come last, as in the SQL
    w = Window.partitionBy("k").orderBy(F.asc_nulls_last("s"), F.asc_nulls_last("e"))
    f = o.withColumn("pe", F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    g = f.withColumn("w", F.sum(F.when(F.col("pe").isNull() | (F.col("s") > F.col("pe")), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return g.groupBy("k", "w").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n"))
