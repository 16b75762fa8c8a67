"""Queries over graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bins, communities, contacts, graph, jobs
from ..sources.formats import cluster_tree
from ..sources.tables import shared_dir, stored
from .bin_queries import hits
from .inputs import SQL_E, SQL_V, contigs, edges, table
from .registry import query


@query("graph_edges", f"with {SQL_E} select i, j, v from e where i < j")
def graph_edges(spark, sf):
    return edges(spark, sf).where("i < j")


@query("connected_components", """with recursive l as (select distinct c_nationkey * 10 + c_custkey % 3 i, c_custkey % 97 + 1000 j from customer), b as (select i, j from l union select j, i from l),
r(node, reach) as (select i, i from b union select r.node, b.j from r join b on b.i = r.reach) select node, min(reach) component from r group by 1""")
def connected_components(spark, sf):
    c = table(spark, sf, "customer")
    l = c.select((F.col("c_nationkey") * 10 + F.col("c_custkey") % 3).alias("i"), (F.col("c_custkey") % 97 + 1000).alias("j")).distinct()  # noqa: E741
    return graph.components(l)


#: The resolutions of the reference's sweep.
GAMMAS = (1.0, *map(float, range(20, 501, 20)))


def links(spark, sf):
    """All contacts between different contigs."""
    return contacts.off_diagonal(edges(spark, sf))


def communities_of(spark, sf):
    return communities.clustered(links(spark, sf), 1.0, contigs(spark, sf))


@query("modularity_clusters")
def modularity_clusters(spark, sf):
    return communities_of(spark, sf)


@query("modularity_quality")
def modularity_quality(spark, sf):
    e = stored(links(spark, sf))  # pairing is the larger part of the work
    return graph.modularity(e, communities.clustered(e, 1.0, contigs(spark, sf)))


@query("modularity_invariants", """select count(*) nodes, true as named_by_least, 0 as unconnected, 0 as better_moves, true as above_nations from supplier""")
def modularity_invariants(spark, sf):
    """What holds of any good partition: every contig is in one cluster, named by its least contig and connected; no contig
    gains by moving to a cluster around it; the modularity is above that of the nations."""
    e = stored(links(spark, sf))
    c = stored(communities.clustered(e, 1.0, contigs(spark, sf)))
    m = lambda x, n: graph.modularity(e, x).select(F.col("modularity").alias(n))
    nations = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_nationkey").alias("cluster"))
    least = c.groupBy("cluster").agg(F.min("node").alias("least"), F.count("*").alias("n"))
    of = lambda end: c.select(F.col("node").alias(end), F.col("cluster").alias(f"c{end}"))
    both = e.join(of("i"), "i").join(of("j"), "j")
    inner = graph.components(both.where("ci = cj").select("i", "j"))
    pieces = c.join(inner, "node", "left").groupBy("cluster").agg(F.count_distinct(F.coalesce("component", "node")).alias("pieces"))
    seen = c.agg(F.count("*").alias("nodes"), F.count_distinct("node").alias("own"))
    named = least.agg(F.min(F.col("least") == F.col("cluster")).alias("named_by_least"))
    broken = pieces.agg(F.count_if(F.col("pieces") > 1).cast("int").alias("unconnected"))
    ends = both.select(F.col("i").alias("node"), "ci", F.col("cj").alias("c"), "v").union(both.select("j", "cj", "ci", "v"))
    degree = ends.groupBy("node").agg(F.sum("v").alias("k"), F.max("ci").alias("own"))
    total = e.agg(F.sum("v").alias("total"))
    held = degree.groupBy(F.col("own").alias("c")).agg(F.sum("k").alias("held"))
    w = ends.groupBy("node", "c").agg(F.sum("v").alias("w")).union(degree.select("node", "own", F.lit(0))).groupBy("node", "c").agg(F.sum("w").alias("w"))
    rows = w.join(degree, "node").join(held, "c").crossJoin(F.broadcast(total))
    gain = F.col("w") - F.col("k") * (F.col("held") - F.when(F.col("c") == F.col("own"), F.col("k")).otherwise(0)) / (2 * F.col("total"))
    best = rows.groupBy("node").agg(F.max(F.when(F.col("c") != F.col("own"), gain)).alias("other"), F.max(F.when(F.col("c") == F.col("own"), gain)).alias("here"))
    better = best.agg(F.count_if(F.col("other") > F.col("here") + 1e-6).cast("int").alias("better_moves"))
    above = m(c, "a").crossJoin(m(nations, "b")).select((F.col("a") > F.col("b")).alias("above_nations"))
    out = seen.where("nodes = own").select("nodes")
    for one in (named, broken, better, above):
        out = out.crossJoin(F.broadcast(one))
    return out


@query("modularity_pinned", """select s_suppkey node, s_suppkey % 2 as pin from supplier where s_suppkey <= 10""")
def modularity_pinned(spark, sf):
    """Pinned contigs stay together by pin: of those contigs, which of the two clusters they are in."""
    pins = table(spark, sf, "supplier").where("s_suppkey <= 10").select(F.col("s_suppkey").alias("node"), (F.col("s_suppkey") % 2).alias("cluster"))
    got = stored(communities.clustered(links(spark, sf), 1.0, contigs(spark, sf), pins))
    own = got.join(pins.select("node", F.col("cluster").alias("pin")), "node")
    ones = own.groupBy("pin").agg(F.count_distinct("cluster").alias("n"), F.min("cluster").alias("at")).where("n = 1")
    apart = ones.groupBy("at").agg(F.count("*").alias("pins"), F.max("pin").alias("pin")).where("pins = 1").select(F.col("at").alias("cluster"), "pin")
    return own.select("node", "cluster").join(apart, "cluster").select("node", "pin")


def seed_genes(spark, sf):
    h = hits(spark, sf)
    return h.join(F.broadcast(bins.seed_marker(h).select("marker")), "marker", "left_semi").agg(F.count_distinct("contig")).first()[0]


@query("resolution_sweep")
def resolution_sweep(spark, sf):
    """The first resolution with more clusters of enough length than seed genes, else the last."""
    every = stored(communities.swept(links(spark, sf), list(GAMMAS), contigs(spark, sf)))
    length = contigs(spark, sf).select(F.col("contig").alias("node"), "length")
    return jobs.seeded(every, length, seed_genes(spark, sf), 150_000)


@query("resolution_argmax")
def resolution_argmax(spark, sf):
    """The resolution whose clusters grade best by their markers' completeness and contamination."""
    every = stored(communities.swept(links(spark, sf), [1.0, 2.0, 5.0, 10.0], contigs(spark, sf)))
    h, sets = hits(spark, sf), table(spark, sf, "part").select(F.col("p_type").alias("marker"), (F.length("p_type") % 3).alias("set_id")).distinct()
    of = h.drop("bin").join(every, h.contig == every.node).select("marker", F.struct("gamma", "cluster").alias("bin"))
    graded = bins.completeness(of, sets).groupBy(F.col("bin.gamma").alias("gamma")).agg(F.sum(bins.graded()).alias("score"))
    return communities.best_resolution(every, graded).select("node", "cluster", "gamma")


@query("bin_resplit")
def bin_resplit(spark, sf):
    """Bins are the nations' regions; those whose line items have a large tax are cut."""
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("bin"))
    s = table(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("bin", F.col("s_suppkey").alias("contig"))
    m = s.join(contigs(spark, sf).select("contig", "length"), "contig").select("bin", "contig", "length")
    li = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("contig")).agg(F.avg("l_discount").alias("d"), F.avg("l_tax").alias("t"))
    stats = s.join(li, "contig").groupBy("bin").agg((F.avg("d") * 1500).alias("completeness"), (F.avg("t") * 300).alias("contamination"))
    return communities.resplit(links(spark, sf), m, stats, 2000)


@query("bin_resplit_whole", """with m as (select n_regionkey bin, s_suppkey contig from supplier join nation on s_nationkey = n_nationkey),
t as (select l_suppkey contig, avg(l_discount) d, avg(l_tax) t from lineitem group by 1), s as (select bin, avg(d) * 1500 c, avg(t) * 300 x from m join t using (contig) group by 1)
select m.bin, count(*) contigs, any_value(c >= 50 and x > 10) or min(contig) = 0 cut, true as same_contigs from m left join s using (bin) group by 1""")
def bin_resplit_whole(spark, sf):
    """With no least length, a cut bin's pieces are its contigs, each once."""
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("bin"))
    s = table(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("bin", F.col("s_suppkey").alias("contig"))
    m = s.withColumn("length", F.lit(1).cast("long"))
    li = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("contig")).agg(F.avg("l_discount").alias("d"), F.avg("l_tax").alias("t"))
    stats = s.join(li, "contig").groupBy("bin").agg((F.avg("d") * 1500).alias("completeness"), (F.avg("t") * 300).alias("contamination"))
    got = communities.resplit(links(spark, sf), m, stats, 0)
    # a bin that is cut has pieces named by their least contigs
    named = got.groupBy("bin", "piece").agg(F.min("contig").cast("string").alias("least"))
    cut = named.groupBy("bin").agg(F.min(F.col("piece") == F.col("least")).alias("cut"))
    by = got.groupBy("bin").agg(F.count("*").alias("contigs"), F.sort_array(F.collect_list("contig")).alias("a")).join(cut, "bin")
    want = s.groupBy("bin").agg(F.sort_array(F.collect_list("contig")).alias("b"))
    return by.join(want, "bin").select("bin", "contigs", "cut", (F.col("a") == F.col("b")).alias("same_contigs"))


@query("code_length_of_nations", f"""with {SQL_E}, c as (select s_suppkey k, s_nationkey g from supplier), o as (select i, j, cast(v as double) v from e where i <> j), m as (select 2 * sum(v) m from o),
ends as (select i n, j o, v from o union all select j, i, v from o), pe as (select n, x.g, sum(v) / any_value(m) p, sum(case when x.g <> y.g then v else 0 end) / any_value(m) q from ends join c x on x.k = n join c y on y.k = o, m group by 1, 2),
g as (select g, sum(p) p, sum(q) q from pe group by 1), h as (select sum(q) q from g)
select round((select case when q > 1e-15 then q * log2(q) else 0 end from h) - 2 * sum(case when q > 1e-15 then q * log2(q) else 0 end) + sum((q + p) * log2(q + p)) - (select sum(p * log2(p)) from pe), 6) bits from g""")
def code_length_of_nations(spark, sf):
    c = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_nationkey").alias("cluster"))
    bits = communities.code_length(edges(spark, sf), c)
    return spark.createDataFrame([(round(bits, 6),)], "bits double")


@query("flow_clusters")
def flow_clusters(spark, sf):
    return communities.flow_clustered(links(spark, sf), contigs(spark, sf), trials=3)[0]


@query("flow_invariants", """select count(*) nodes, true as no_longer_than_one_module, true as length_of_the_clusters, true as read_back from supplier""")
def flow_invariants(spark, sf):
    """Every contig is in a module, the code is no longer than that of one module, its length is that of the modules found,
    and the tree that is written gives the same modules when it is read."""
    e = stored(links(spark, sf))
    got, bits = communities.flow_clustered(e, contigs(spark, sf), trials=3)
    got = stored(got)
    one = communities.code_length(e, got.select("node", F.lit(0).alias("cluster")))
    path = shared_dir(spark)
    communities.tree_lines(e, got).write.text(path)
    tree = cluster_tree(spark, path).select("node", F.col("cluster").alias("module"))
    sizes = got.join(tree, "node").groupBy("cluster").agg(F.count_distinct("module").alias("n"), F.min("module").alias("module"))
    same = sizes.agg((F.max("n") == 1) & (F.count_distinct("module") == F.count("*"))).first()[0]
    flags = [bits <= one + 1e-9, abs(bits - communities.code_length(e, got)) < 1e-9, bool(same) and tree.count() == got.count()]
    return got.agg(F.count_distinct("node").alias("nodes")).select("nodes", *[F.lit(bool(x)).alias(n) for x, n in zip(flags, ("no_longer_than_one_module", "length_of_the_clusters", "read_back"), strict=True)])


for _hops in (1, 2):
    _sql = f"""with recursive {SQL_E}, {SQL_V}, top as materialized (select i, j from (select i, j, row_number() over (partition by i order by v desc, j) r from full_e where i <> j) where r <= 5),
reach(node, near, d) as (select i, j, 0 from top union select r.node, t.j, d + 1 from reach r join top t on t.i = r.near where d < {_hops}),
region as (select distinct node, near from reach), g as (select node, exp(avg(ln(coverage + 0.01))) m from region join vert on contig = near group by 1)
select contig, (coverage + 0.01) / m > 2 degenerate, round(coverage + 0.01, 6) coverage, round(m, 6) as "local", round((coverage + 0.01) / m, 6) fold from vert join g on node = contig where length >= 5000"""

    @query(f"degenerate_report_{_hops}", _sql)
    def degenerate_report(spark, sf, hops=_hops):
        """Contigs of high coverage against their region, which ends after so many hops from the nearest contigs."""
        v = contigs(spark, sf).withColumn("coverage", F.col("coverage") + 0.01)
        got = graph.degenerates(edges(spark, sf), v, 2.0, 5000, 5, hops)
        return got.withColumns({c: F.round(c, 6) for c in ("coverage", "local", "fold")})
