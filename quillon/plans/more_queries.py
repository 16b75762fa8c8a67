"""Queries of hits, further scans and report data."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import bins, contacts, graph, hits, matrix, ordering
from ..sources import formats, tables
from .bin_queries import hits as marker_hits
from .inputs import SQL_E, SQL_M, contigs, edges, members, table
from .registry import query

SQL_HITS = "h as (select l_partkey target, l_orderkey * 100 + l_linenumber hit, l_quantity / 50000 p, l_discount q, l_linenumber * 10 s, l_linenumber * 10 + cast(l_quantity as int) e from lineitem)"


def profile_hits(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("target"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("hit"), (F.col("l_quantity") / 50000).alias("p"), F.col("l_discount").alias("q"),
        (F.col("l_linenumber") * 10).alias("start"), (F.col("l_linenumber") * 10 + F.col("l_quantity").cast("int")).alias("end"),
    )


@query("filter_cascade", f"with {SQL_HITS} select case when p <= 0.0008 then case when q <= 0.05 then 2 else 1 end else 0 end passed, count(*) n from h group by 1")
def filter_cascade(spark, sf):
    return hits.staged(profile_hits(spark, sf), [("p", 0.0008), ("q", 0.05)]).groupBy("passed").agg(F.count("*").alias("n"))


@query("hit_thresholds", f"with {SQL_HITS}, t as (select target from h group by 1 having min(p) * 1000 <= 0.05) select target, count(*) n from h where target in (select target from t) and p * (select count(*) from t) <= 0.05 group by 1")
def hit_thresholds(spark, sf):
    return hits.thresholded(profile_hits(spark, sf), 1000.0, 0.05, 0.05).groupBy("target").agg(F.count("*").alias("n"))


@query("hits_without_twins", f"""with {SQL_HITS}, d as (select *, lag(s) over w ps, lag(e) over w pe from (select distinct target, hit, s, e from h) window w as (partition by target order by s, e, hit))
select target, count(*) n from d where ps is null or not coalesce((abs(s - ps) <= 3 and abs(e - pe) <= 3) or greatest(0, least(e, pe) - greatest(s, ps) + 1) >= 0.95 * (e - s + 1), false) group by 1""")
def hits_without_twins(spark, sf):
    d = profile_hits(spark, sf).select("target", "hit", "start", "end").distinct()
    return hits.without_twins(d).groupBy("target").agg(F.count("*").alias("n"))


@query("hit_order", f"with {SQL_HITS} select target, hit, p, rank from (select target, hit, p, row_number() over (partition by target order by p, s, hit, e) rank from h)")
def hit_order(spark, sf):
    return ordering.ranked(profile_hits(spark, sf), ["target"], "p", "start", "hit", "end").select("target", "hit", "p", F.col("rank").cast("long").alias("rank"))


@query("name_sorted_head", "select l_orderkey q, l_linenumber n, l_partkey p from lineitem order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice limit 50")
def name_sorted_head(spark, sf):
    d = table(spark, sf, "lineitem").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").limit(50)
    return d.select(F.col("l_orderkey").alias("q"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"))


@query("name_sorted", "select l_orderkey q, l_linenumber n, l_partkey p, row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 place from lineitem")
def name_sorted(spark, sf):
    """All records with their places in the order of names, numbered within ranges of it."""
    by = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("by")
    d = table(spark, sf, "lineitem").select(by)
    return ordering.dense_numbers(d, "by", "place").select(F.col("by.l_orderkey").alias("q"), F.col("by.l_linenumber").alias("n"), F.col("by.l_partkey").alias("p"), "place")


@query("kept_records", "select count(*) n from lineitem where l_partkey in (select p_partkey from part where p_size > 25)")
def kept_records(spark, sf):
    p = table(spark, sf, "part").where("p_size > 25")
    li = table(spark, sf, "lineitem")
    return li.join(p, li.l_partkey == p.p_partkey, "left_semi").agg(F.count("*").alias("n"))


@query("unmatched_bins", f"""with {SQL_M}, s as (select a.bin a, b.bin b, sum(a.length) s from m a join m b on a.contig = b.contig where a.bin_set = 'B' and b.bin_set = 'A' group by 1, 2), n as (select bin_set, bin, sum(length) n from m group by 1, 2),
x as (select s.b from s join n p on p.bin_set = 'B' and p.bin = s.a join n q on q.bin_set = 'A' and q.bin = s.b where 100.0 * greatest(s / p.n, s / q.n) >= 24) select distinct bin from m where bin_set = 'A' and bin not in (select b from x)""")
def unmatched_bins(spark, sf):
    m = members(spark, sf)
    return bins.unmatched(m.where("bin_set = 'B'"), m.where("bin_set = 'A'"), 24)


@query("tick_positions", f"with {SQL_M}, x as (select bin, count(*) n from m where bin_set = 'B' group by 1) select bin, cast(sum(n) over (order by bin rows unbounded preceding) as bigint) tick from x")
def tick_positions(spark, sf):
    x = members(spark, sf).where("bin_set = 'B'").groupBy("bin").agg(F.count("*").alias("n"))  # one row a bin
    return x.select("bin", F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)).alias("tick"))


@query("flow_between_sets", f"with {SQL_M} select a.bin a, c.bin c, round(sum(a.length) / 1048576, 2) mbp from m a join m c on a.contig = c.contig where a.bin_set = 'A' and c.bin_set = 'C' group by 1, 2")
def flow_between_sets(spark, sf):
    refined = bins.intersections(members(spark, sf), ["A", "C"], 0)
    return formats.flow_rows(refined, "A", "C").withColumnsRenamed({"A": "a", "C": "c"})


@query("subspace", f"""with {SQL_E}, k as (select s_suppkey contig, row_number() over (order by s_suppkey) - 1 place from supplier where abs(s_acctbal) >= 5000)
select least(a.place, b.place) // 5 i, greatest(a.place, b.place) // 5 j, cast(sum(v) as bigint) v from e join k a on a.contig = i join k b on b.contig = j group by 1, 2""")
def subspace(spark, sf):
    c = matrix.compressed(edges(spark, sf), contigs(spark, sf).where("coverage >= 50"))
    return c.groupBy(F.floor(F.col("i") / 5).alias("i"), F.floor(F.col("j") / 5).alias("j")).agg(F.sum("v").alias("v"))


@query("mge_summary", f"""with {SQL_E}, x as (select count(*) pairs, coalesce(cast(sum(v) as bigint), 0) contacts from e join supplier a on a.s_suppkey = i join supplier b on b.s_suppkey = j where i <> j and ((a.s_nationkey < 5 and b.s_nationkey >= 15) or (b.s_nationkey < 5 and a.s_nationkey >= 15)))
select pairs, contacts, (select count(*) from supplier where s_nationkey < 5) elements from x""")
def mge_summary(spark, sf):
    k = lambda e: table(spark, sf, "supplier").select(F.col("s_suppkey").alias(e), F.col("s_nationkey").alias(f"k{e}"))
    both = contacts.off_diagonal(edges(spark, sf)).join(k("i"), "i").join(k("j"), "j").where("ki < 5 and kj >= 15 or kj < 5 and ki >= 15")
    n = table(spark, sf, "supplier").where("s_nationkey < 5").agg(F.count("*").alias("elements"))
    return both.agg(F.count("*").alias("pairs"), F.coalesce(F.sum("v"), F.lit(0)).alias("contacts")).crossJoin(n)


@query("tree_scan", """with p as (select p_partkey node, '1:' || p_size as path from part), s as (select path, row_number() over (order by count(*) desc, path) - 1 as "cluster" from p group by path) select node, "cluster" from p join s on s.path = p.path""")
def tree_scan(spark, sf):
    path = tables.shared_dir(spark)
    p = table(spark, sf, "part")
    p.select(F.concat(F.lit("1:"), F.col("p_size").cast("string"), F.lit(":1 0.1 \"x\" "), F.col("p_partkey").cast("string")).alias("value")).write.text(path)
    return formats.cluster_tree(spark, path).select("node", F.col("cluster").cast("long").alias("cluster"))


@query("domain_table_scan", "select 'k' || p_partkey contig, p_size qlen from part where p_size - 1 > 20")
def domain_table_scan(spark, sf):
    path = tables.shared_dir(spark)
    k, n = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    line = F.concat_ws("  ", F.concat(F.lit("k"), k, F.lit("_1_90_+")), F.lit("-"), F.lit("30"), F.lit("m1"), F.lit("-"), n, F.lit("1e-9 50.0 0.1 1 1 1e-5 1e-5 40.0 0.1 1"), n, F.lit("1 9 1 9 0.9 -"))
    table(spark, sf, "part").select(line.alias("value")).write.text(path)
    return formats.domain_hits(spark, path).where("hmm_to - hmm_from > 20").select("contig", "qlen")


@query("dict_stats_scan", "select p_brand bin, cast(count(*) as varchar) n from part group by 1")
def dict_stats_scan(spark, sf):
    path = tables.shared_dir(spark)
    by = table(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    by.select(F.concat(F.col("p_brand"), F.lit("\t{'n': "), F.col("n").cast("string"), F.lit("}")).alias("value")).write.text(path)
    return formats.dict_stats(spark, path).select("bin", F.col("figures")["n"].alias("n"))


@query("json_roundtrip", "select event_id, event_type from events")
def json_roundtrip(spark, sf):
    path = tables.shared_dir(spark)
    table(spark, sf, "events").select("event_id", "event_type").write.json(path)
    return formats.json_lines(spark, path).select("event_id", "event_type")


@query("fanned_out", "select lang, source, count(*) n from documents group by 1, 2")
def fanned_out(spark, sf):
    path = tables.shared_dir(spark)
    formats.write_fanned(table(spark, sf, "documents").select("doc_id", "lang", "source"), path, "lang", "source")
    return spark.read.parquet(path).groupBy("lang", "source").agg(F.count("*").alias("n"))


@query("oriented_reads", "select l_returnflag || l_linenumber as seq, l_linenumber % 2 flag, case when l_linenumber % 2 = 1 then reverse(translate(l_returnflag || 'ACG' || l_linenumber, 'ACGT', 'TGCA')) else l_returnflag || 'ACG' || l_linenumber end read, count(*) n from lineitem group by 1, 2, 3")
def oriented_reads(spark, sf):
    n = F.col("l_linenumber").cast("string")
    d = table(spark, sf, "lineitem").select(F.concat("l_returnflag", n).alias("seq"), (F.col("l_linenumber") % 2).alias("flag"), F.concat("l_returnflag", F.lit("ACG"), n).alias("r"))
    return d.select("seq", "flag", C.oriented(F.col("r"), F.col("flag") * 16, True).alias("read")).groupBy("seq", "flag", "read").agg(F.count("*").alias("n"))


def drawn_sums(contacts_between):
    """sums(new, placed, n) as in graph.sums_of, of contacts (i, j, v) that are only asked for where a marker has new contigs: the
    driver gets their sums by bin, not the contacts."""
    held: list = []

    def sums(new: list, placed: dict, n: int) -> np.ndarray:
        out = np.zeros((len(new), n))
        if not held:
            held.append(tables.stored(contacts_between()))
        e, spark = held[0], held[0].sparkSession
        row = spark.createDataFrame(pa.table({"a": pa.array(new, pa.int64()), "row": pa.array(range(len(new)), pa.int64())}))
        at = spark.createDataFrame(pa.table({"b": pa.array(list(placed), pa.int64()), "bin": pa.array(list(placed.values()), pa.int64())}))
        ends = e.select(F.col("i").alias("a"), F.col("j").alias("b"), "v").union(e.select("j", "i", "v"))
        by = ends.join(row, "a").join(at, "b").groupBy("row", "bin").agg(F.sum("v").cast("double").alias("w")).toArrow()
        out[by["row"].to_numpy(), by["bin"].to_numpy()] = by["w"].to_numpy()
        return out

    return sums


@query("marker_matching")
def marker_matching(spark, sf):
    """Marker contigs matched to bins by contacts, over all markers, the longest-loaded first. The driver holds the marker
    contigs, their markers and bins; one marker's new contigs are matched at a time, by their sums of contacts to the bins."""
    h = tables.stored(marker_hits(spark, sf).select("marker", "contig").distinct())
    order = bins.marker_order(h)
    rows = h.join(order, "marker").orderBy(F.desc("contigs"), F.desc("load"), "marker", "contig").select("marker", "contig").toArrow()
    markers: dict[str, list] = {}
    own: dict = {}
    for part in rows.to_batches():
        for marker, contig in zip(part["marker"].to_pylist(), part["contig"].to_pylist(), strict=True):
            markers.setdefault(marker, []).append(contig)
    for marker, on in markers.items():
        for contig in on:
            own.setdefault(contig, set()).add(marker)
    sums = drawn_sums(lambda: contacts.restricted(contacts.off_diagonal(edges(spark, sf)), h.select("contig").distinct()))
    placed = graph.matched_bins(list(markers.items()), None, 1.0, 0.0, own, sums)
    found = sorted(placed.items())
    return spark.createDataFrame(pa.table({"contig": pa.array([c for c, _ in found], pa.int64()), "bin": pa.array([b for _, b in found], pa.int64())}))
