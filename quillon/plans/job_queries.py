"""Queries of whole jobs and of the smaller filters, names and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import bins, contacts, hits, jobs, models, ordering
from .bin_queries import SQL_H
from .bin_queries import hits as marker_hits
from .graph_queries import GAMMAS
from .inputs import SQL_E, SQL_M, SQL_P, SQL_V, contigs, edges, members, table
from .matrix_queries import rounded
from .registry import query

SQL_CUT = "where v > (select quantile_cont(v, 0.05) from n)"


@query("normalise_raw", f"with {SQL_E}, n as (select i, j, cast(v as double) v from e) select * from n {SQL_CUT}")
def normalise_raw(spark, sf):
    return jobs.normalised(edges(spark, sf), contigs(spark, sf), "raw")


@query("normalise_coverage", f"""with {SQL_E}, {SQL_V}, n as (select i, j, v / sqrt((a.coverage + 1e-9) * (b.coverage + 1e-9)) v from e join vert a on a.contig = i join vert b on b.contig = j where i <> j)
select i, j, round(v, 6) v from n {SQL_CUT}""")
def normalise_coverage(spark, sf):
    return rounded(jobs.normalised(edges(spark, sf), contigs(spark, sf), "coverage"))


@query("balanced_row_sums", f"with {SQL_E} select distinct i contig, 1.0 as total from full_e")
def balanced_row_sums(spark, sf):
    """Rows of the balanced matrix, with ones on empty diagonals, sum to one."""
    from ..operators import matrix

    e = edges(spark, sf)
    x, scaled = matrix.balanced(e, 200, 1e-7)
    full = contacts.symmetric(scaled)
    holes = x.join(e.where("i = j").select(F.col("i").alias("contig")), "contig", "left_anti").select("contig", (F.col("x") * F.col("x")).alias("v"))
    every = full.select(F.col("i").alias("contig"), "v").union(holes)
    return every.groupBy("contig").agg(F.round(F.sum("v"), 4).alias("total"))


@query("contact_binning")
def contact_binning(spark, sf):
    h = marker_hits(spark, sf)
    genes = h.join(F.broadcast(bins.seed_marker(h).select("marker")), "marker", "left_semi").agg(F.count_distinct("contig")).first()[0]
    return jobs.binned(edges(spark, sf), contigs(spark, sf), genes, GAMMAS, 150_000)


@query("length_accounting", "select count(case when length(text) >= 1000 then 1 end) kept, count(case when length(text) < 1000 or text is null then 1 end) too_short from documents")
def length_accounting(spark, sf):
    return contacts.length_accounting(table(spark, sf, "documents").select(F.length("text").alias("length")), 1000)


SQL_MATES = """mates as (select l_orderkey k, l_partkey % 7 = l_suppkey % 7 same, l_partkey * 17 - l_suppkey * 31 d, cast(l_quantity as int) % 40 qa, l_linenumber qb,
case when l_discount > 0.08 then 1024 else 0 end fa, case when l_tax > 0.07 then 4 else 0 end fb from lineitem)"""


def mates(spark, sf):
    k = F.col
    return table(spark, sf, "lineitem").select(
        k("l_orderkey").alias("k"), (k("l_partkey") % 7 == k("l_suppkey") % 7).alias("same"), (k("l_partkey") * 17 - k("l_suppkey") * 31).alias("d"), (k("l_quantity").cast("int") % 40).alias("qa"), k("l_linenumber").alias("qb"),
        F.when(k("l_discount") > 0.08, 1024).otherwise(0).alias("fa"), F.when(k("l_tax") > 0.07, 4).otherwise(0).alias("fb"),
    )


@query("informative_pairs", f"""with {SQL_MATES} select count(*) pairs, count(case when qa <> 0 and qb <> 0 and fa & 1028 = 0 and fb & 1028 = 0 and (not same or abs(d) >= 10000) then 1 end) informative,
count(case when qa <> 0 and qb <> 0 and fa & 1028 = 0 and fb & 1028 = 0 and not same then 1 end) strict from mates""")
def informative_pairs(spark, sf):
    m = mates(spark, sf)
    columns = [F.col(c) for c in ("same", "d", "qa", "qb", "fa", "fb")]
    return m.agg(F.count("*").alias("pairs"), F.count_if(contacts.informative(*columns)).alias("informative"), F.count_if(contacts.informative(*columns, strict=True)).alias("strict"))


@query("mate_gates", """select l_suppkey contig, count(*) n from lineitem where (l_linenumber & 13) = 1 and l_suppkey in (select s_suppkey from supplier where s_acctbal > 0)
and l_partkey in (select s_suppkey from supplier where s_acctbal > 0) group by 1""")
def mate_gates(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("contig"), F.col("l_partkey").alias("mate_contig"), F.col("l_linenumber").alias("flag"))
    kept = table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("contig"))
    return contacts.mate_gated(li, kept).groupBy("contig").agg(F.count("*").alias("n"))


@query("provirus_filter", "select p_partkey contig, p_type quality from part where p_brand <> 'Brand#1' and p_type in ('ECONOMY', 'STANDARD')")
def provirus_filter(spark, sf):
    """Elements whose topology is none of a host's own, of the better qualities."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("contig"), F.col("p_brand").alias("topology"), F.col("p_type").alias("quality"))
    return p.where((F.col("topology") != "Brand#1") & F.col("quality").isin("ECONOMY", "STANDARD")).select("contig", "quality")


@query("hits_of_known_contigs", f"with {SQL_H} select marker, count(*) n from h where contig in (select s_suppkey from supplier where s_acctbal > 2000) group by 1")
def hits_of_known_contigs(spark, sf):
    known = table(spark, sf, "supplier").where("s_acctbal > 2000").select(F.col("s_suppkey").alias("contig"))
    return hits.of_known(marker_hits(spark, sf), known).groupBy("marker").agg(F.count("*").alias("n"))


@query("longest_marker_contigs", f"""with {SQL_H}, {SQL_V}, t as (select contig from vert where contig in (select contig from h) order by length desc, contig limit 30) select contig, count(*) n from h where contig in (select contig from t) group by 1""")
def longest_marker_contigs(spark, sf):
    return hits.longest_markers(marker_hits(spark, sf), contigs(spark, sf), 30).groupBy("contig").agg(F.count("*").alias("n"))


@query("bin_proteins", f"with {SQL_H}, g as (select distinct bin, marker gene from h) select bin, count(*) n, string_agg(gene, ',' order by gene) genes from g group by 1")
def bin_proteins(spark, sf):
    return bins.marker_listing(marker_hits(spark, sf).withColumn("gene", F.col("marker")))


@query("bin_membership", f"with {SQL_M} select cast(contig as varchar) || chr(9) || bin as value from m where bin_set = 'A'")
def bin_membership(spark, sf):
    return bins.membership(members(spark, sf).where("bin_set = 'A'"))


@query("assembler_names", r"""select 'k' || p_size || '_' || p_partkey || ' flag=1' header, 'k' || p_size || '_' || p_partkey contig, p_brand || '_' || p_partkey named,
case when p_size % 3 = 0 then 'TIGR00389' else 'TIGR' || p_size end marker from part""")
def assembler_names(spark, sf):
    k, n = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    header = F.concat(F.lit("k"), n, F.lit("_"), k, F.lit(" flag=1"))
    raw = F.when(F.col("p_size") % 3 == 0, "TIGR00388").otherwise(F.concat(F.lit("TIGR"), n))
    return table(spark, sf, "part").select(header.alias("header"), C.kmer_contig(header).alias("contig"), C.prefixed(F.col("p_brand"), k).alias("named"), C.marker_alias(raw).alias("marker"))


@query("set_order", "select s_suppkey contig, place, orientation, place is not null accepted from supplier left join (select s_suppkey k, row_number() over (order by s_name desc) - 1 place, s_nationkey % 2 orientation from supplier where s_acctbal > 0) o on k = s_suppkey")
def set_order(spark, sf):
    s = table(spark, sf, "supplier")
    down = ordering.dense_numbers(s.select(F.col("s_suppkey").alias("contig"), "s_name"), "s_name", "up").select("contig", (-F.col("up")).alias("at"))
    order = s.where("s_acctbal > 0").select(F.col("s_suppkey").alias("contig"), (F.col("s_nationkey") % 2).alias("orientation")).join(down, "contig")
    return ordering.ordered(s.select(F.col("s_suppkey").alias("contig")), order)


@query("unmapped_pairs", f"with {SQL_P} select count(*) pairs, count(case when a not in (select s_suppkey from supplier where s_acctbal > 0) and b not in (select s_suppkey from supplier where s_acctbal > 0) then 1 end) outside from p")
def unmapped_pairs(spark, sf):
    from .inputs import paired

    k = lambda e: table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias(f"k{e}"))
    p = paired(spark, sf)
    p = p.join(k("a"), p.a == F.col("ka"), "left").join(k("b"), p.b == F.col("kb"), "left")
    return p.agg(F.count("*").alias("pairs"), F.count_if(F.col("ka").isNull() & F.col("kb").isNull()).alias("outside"))


@query("modularity_of_groups", f"""with {SQL_E}, o as (select i, j, v from e where i <> j), c as (select s_suppkey k, s_nationkey g from supplier), w as (select sum(case when x.g = y.g then v else 0 end) w_in, sum(v) m from o join c x on x.k = i join c y on y.k = j),
d as (select g, sum(v) k from (select i n, v from o union all select j, v from o) join c on c.k = n group by 1) select round(w_in / m - (select sum(cast(k as double) * k) from d) / (4.0 * m * m), 6) modularity from w""")
def modularity_of_groups(spark, sf):
    from ..operators import graph

    c = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_nationkey").alias("cluster"))
    return rounded(graph.modularity(edges(spark, sf), c), "modularity")


def _em_sql(steps: int) -> str:
    """So many steps of expectation maximisation as chained one-row tables."""
    pdf = lambda m, s: f"exp(-((x - {m}) ** 2) / (2 * {s} * {s})) / ({s} * sqrt(2 * pi()))"
    parts = [
        "x as materialized (select cast(value as double) x from events where value is not null and not isnan(value))",
        "c as (select quantile_cont(x, 0.8) q from x)",
        """s0 as materialized (select avg(x) filter (x <= q) mn, greatest(stddev_samp(x) filter (x <= q), 1) sn, avg(x) filter (x > q) mc, greatest(stddev_samp(x) filter (x > q), 1) sc,
 count(*) filter (x <= q) / count(*) pn, count(*) filter (x > q) / count(*) pc from x, c)""",
    ]
    for k in range(steps):
        n, c = f"pn * {pdf('mn', 'sn')}", f"pc * {pdf('mc', 'sc')}"
        parts += [
            f"g{k} as materialized (select x, {n} / greatest({n} + {c}, 1e-10) h, {c} / greatest({n} + {c}, 1e-10) g from x, s{k})",
            f"m{k} as materialized (select sum(h * x) / sum(h) mn, sum(g * x) / sum(g) mc, sum(h) / count(*) pn, sum(g) / count(*) pc from g{k})",
            f"s{k + 1} as materialized (select any_value(mn) mn, greatest(sqrt(sum(h * (x - mn) ** 2) / sum(h)), 1e-6) sn, any_value(mc) mc, greatest(sqrt(sum(g * (x - mc) ** 2) / sum(g)), 1e-6) sc, any_value(pn) pn, any_value(pc) pc from g{k}, m{k})",
        ]
    low, high = f"mc - {C.Z95} * sc", f"mn + {C.Z95} * sn"
    cut = f"greatest(case when {high} <= 0 then {low} when {low} <= 0 then {high} else least({low}, {high}) end, 100.0)"
    last = ", ".join(f"round({v}, 4) {k}" for k, v in (("mean_n", "mn"), ("std_n", "sn"), ("mean_c", "mc"), ("std_c", "sc"), ("share_c", "pc"), ("cutoff", cut)))
    return f"with {', '.join(parts)} select {last} from s{steps}"


@query("gaussian_em_3", _em_sql(3))
def gaussian_em_3(spark, sf):
    got = models.gaussian_mixture(table(spark, sf, "events"), "value", steps=3, tolerance=0.0)
    one = spark.createDataFrame([tuple(got.values())], ", ".join(f"{k} double" for k in got))
    return one.select(*[F.round(c, 4).alias(c) for c in one.columns])


def _regression_sql(steps: int) -> str:
    """So many reweighted steps for one covariate: the normal equations of two unknowns, solved in closed form."""
    parts = [
        f"""obs as (select cast(s as double) y, ln(sites + 1) x from vert join (select i, sum(v) s from full_e where i <> j group by 1) on i = contig where s > 0)""",
        "b0 as (select ln(avg(y)) p, cast(0.0 as double) q from obs)",
    ]
    for k in range(steps):
        parts += [
            f"e{k} as (select x, y, exp(p + q * x) m, p + q * x eta from obs, b{k})",
            f"w{k} as (select x, m / (1 + m) w, eta + (y - m) / m z from e{k})",
            f"n{k} as (select sum(w) a, sum(w * x) b, sum(w * x * x) c, sum(w * z) d, sum(w * x * z) e from w{k})",
            f"b{k + 1} as (select (c * d - b * e) / (a * c - b * b) p, (a * e - b * d) / (a * c - b * b) q from n{k})",
        ]
    return f"with {SQL_E}, {SQL_V}, {', '.join(parts)} select round(p, 5) intercept, round(q, 5) sites from b{steps}"


@query("regression_3", _regression_sql(3))
def regression_3(spark, sf):
    s = contacts.signal(edges(spark, sf), contigs(spark, sf)).where("signal > 0")
    beta = models.negative_binomial(s.select("signal", F.log(F.col("sites") + 1).alias("sites")), "signal", ["sites"], steps=3, tolerance=0.0)
    return spark.createDataFrame([tuple(round(b, 5) for b in beta)], "intercept double, sites double")
