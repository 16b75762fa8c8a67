"""Queries of scalar expressions; texts stand in for sequences and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from .inputs import table
from .registry import query

SEQ = "translate(text, 'eioulnsrmdEIOULNSRMDacgt', 'AAACCGGGTTAAACCGGGTTACGT')"
SQL_D = f"d as (select doc_id, {SEQ} seq, text from documents)"


def seqs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.expr(SEQ).alias("seq"), "text")


@query("site_counts", f"with {SQL_D} select doc_id, cast((length(seq) - length(replace(seq, 'GATC', ''))) / 4 + (length(seq) - length(replace(seq, 'CATG', ''))) / 4 as bigint) sites from d")
def site_counts(spark, sf):
    return seqs(spark, sf).select("doc_id", C.site_count(F.col("seq"), "DpnII", "NlaIII").alias("sites"))


@query("revcomp", f"with {SQL_D} select doc_id, reverse(translate(seq, 'ACGT', 'TGCA')) rc from d")
def revcomp(spark, sf):
    return seqs(spark, sf).select("doc_id", C.reverse_complement(F.col("seq")).alias("rc"))


@query("gc_fraction", f"""with {SQL_D}, c as (select doc_id, length(seq) - length(translate(seq, 'GC', '')) gc, length(seq) - length(translate(seq, 'ACGT', '')) n from d)
select doc_id, round(case when n = 0 then 0 else gc / n end, 6) gc from c""")
def gc_fraction(spark, sf):
    return seqs(spark, sf).select("doc_id", F.round(C.gc_fraction(F.col("seq")), 6).alias("gc"))


@query("gc_bucket", f"with {SQL_D} select doc_id, cast(greatest(0, least(43, floor(100 * (length(seq) - length(translate(seq, 'GC', ''))) / length(seq)) - 26)) as int) bucket from d where length(seq) > 0")
def gc_bucket(spark, sf):
    return seqs(spark, sf).where("length(seq) > 0").select("doc_id", C.gc_bucket(F.col("seq")).alias("bucket"))


@query("bin_gc", f"""with s as (select lang, {SEQ} seq from documents) select lang, round(sum(length(seq) - length(translate(seq, 'GC', ''))) / sum(length(seq) - length(translate(seq, 'ACGT', ''))), 6) gc from s group by 1""")
def bin_gc(spark, sf):
    s = table(spark, sf, "documents").select("lang", F.expr(SEQ).alias("seq"))
    gc, n = F.regexp_count("seq", F.lit("[GC]")), F.regexp_count("seq", F.lit("[ACGT]"))
    return s.groupBy("lang").agg(F.round(F.sum(gc) / F.sum(n), 6).alias("gc"))


@query("segments", """select doc_id, 'd' || doc_id || '_seg_' || k segment, substring(text, cast((k - 1) * 1000 + 1 as bigint), 1000) part from (select doc_id, text, unnest(range(1, cast(ceil(length(text) / 1000) as bigint) + 1)) k from documents)""")
def segments(spark, sf):
    d = table(spark, sf, "documents")
    s = C.segments(F.concat(F.lit("d"), F.col("doc_id").cast("string")), F.col("text"), 1000)
    return d.select("doc_id", F.explode(s).alias("s")).select("doc_id", "s.segment", "s.part")


@query("segment_scaffold", "select split_part(name, '_seg_', 1) scaffold, count(*) n from (select 'd' || l_partkey || '_seg_' || l_linenumber as name from lineitem) group by 1")
def segment_scaffold(spark, sf):
    name = F.concat(F.lit("d"), F.col("l_partkey").cast("string"), F.lit("_seg_"), F.col("l_linenumber").cast("string"))
    return table(spark, sf, "lineitem").groupBy(C.scaffold_of(name).alias("scaffold")).agg(F.count("*").alias("n"))


@query("tip_sites", f"""with {SQL_D}, t as (select doc_id, seq, case when length(seq) < 1000 then length(seq) // 2 else 500 end n from d), s as (select doc_id, substring(seq, 1, n) l, substring(seq, length(seq) - n + 1, n) r from t)
select doc_id, cast((length(l) - length(replace(l, 'GATC', ''))) / 4 as bigint) sites_left, cast((length(r) - length(replace(r, 'GATC', ''))) / 4 as bigint) sites_right from s""")
def tip_sites(spark, sf):
    t = C.tip_sites(F.col("seq"), 500, "DpnII")
    return seqs(spark, sf).select("doc_id", t[0].alias("sites_left"), t[1].alias("sites_right"))


@query("length_filter", "select doc_id from documents where length(text) >= 1000")
def length_filter(spark, sf):
    return table(spark, sf, "documents").where(F.length("text") >= 1000).select("doc_id")


@query("strong_match", """with a as (select l_orderkey k, l_linenumber n, l_partkey p, l_suppkey s, l_extendedprice x, case when l_linenumber % 2 = 0 then 16 else 0 end flag, l_quantity mapq, case when l_partkey % 3 = 0 then cast(cast(l_quantity as int) as varchar) || 'M5S' when l_partkey % 3 = 1 then '5S' || cast(cast(l_quantity as int) as varchar) || 'M' else cast(cast(l_quantity as int) as varchar) || 'M' end cigar from lineitem)
select cigar, flag, count(*) n from a where mapq >= 30 and case when flag & 16 = 16 then coalesce(try_cast(regexp_extract(cigar, '(\\d+)M$', 1) as int), 0) else coalesce(try_cast(regexp_extract(cigar, '^(\\d+)M', 1) as int), 0) end >= 35 group by 1, 2""")
def strong_match(spark, sf):
    q = F.col("l_quantity").cast("int").cast("string")
    cigar = F.when(F.col("l_partkey") % 3 == 0, F.concat(q, F.lit("M5S"))).when(F.col("l_partkey") % 3 == 1, F.concat(F.lit("5S"), q, F.lit("M"))).otherwise(F.concat(q, F.lit("M")))
    a = table(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") % 2 == 0, 16).otherwise(0).alias("flag"), F.col("l_quantity").alias("mapq"), cigar.alias("cigar"))
    return a.where(C.strong_match(F.col("flag"), F.col("mapq"), F.col("cigar"), 30, 35)).groupBy("cigar", "flag").agg(F.count("*").alias("n"))


@query("means", "select p_partkey k, round(sqrt(p_size * p_retailprice), 6) g, round(2 * p_size * p_retailprice / (p_size + p_retailprice), 6) h, round((p_size + p_retailprice) / 2, 6) a from part")
def means(spark, sf):
    x, y = F.col("p_size"), F.col("p_retailprice")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), *[F.round(C.mean_of(m, x, y), 6).alias(m[0]) for m in ("geometric", "harmonic", "arithmetic")])


@query("names", "select p_partkey k, 'BIN' || lpad(cast(p_partkey % 10000 as varchar), 4, '0') bin, list_extract(string_split(p_type, '_'), -1) last, split_part(trim(p_name), ' ', 1) word, translate(p_type, '=', '_') clean from part")
def names(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("k"), C.padded("BIN", F.col("p_partkey") % 10000).alias("bin"), C.last_token(F.col("p_type")).alias("last"), C.first_word(F.col("p_name")).alias("word"), C.clean_header(F.col("p_type")).alias("clean")
    )


@query("gene_names", "select gene, regexp_replace(gene, '(_[^_]*){3}$', '') contig, regexp_extract(gene, '^(.+)_\\d+_\\d+_[+-]$', 1) hit from (select 'k' || l_partkey || '_' || l_suppkey || '_' || l_linenumber || '_' || l_orderkey || '_' || case when l_linenumber % 2 = 0 then '+' else '-' end gene from lineitem)")
def gene_names(spark, sf):
    s = [F.col(c).cast("string") for c in ("l_partkey", "l_suppkey", "l_linenumber", "l_orderkey")]
    gene = F.concat(F.lit("k"), F.concat_ws("_", *s, F.when(F.col("l_linenumber") % 2 == 0, "+").otherwise("-")))
    g = table(spark, sf, "lineitem").select(gene.alias("gene"))
    return g.select("gene", C.contig_of_gene(F.col("gene")).alias("contig"), C.contig_of_hit(F.col("gene")).alias("hit"))


@query("mate_mismatches", """with t as (select l_orderkey k, try_cast(regexp_extract('NM:i:' || cast(l_quantity as int) || ' AS:i:3', 'NM:i:(\\d+)', 1) as int) nm from lineitem)
select k, cast(sum(nm) as bigint) nm, sum(nm) < 40 strict, sum(nm) < 100 permissive from t group by 1""")
def mate_mismatches(spark, sf):
    tags = F.concat(F.lit("NM:i:"), F.col("l_quantity").cast("int").cast("string"), F.lit(" AS:i:3"))
    t = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), C.mismatches(tags).alias("nm")).groupBy("k").agg(F.sum("nm").alias("nm"))
    return t.select("k", "nm", (F.col("nm") < 40).alias("strict"), (F.col("nm") < 100).alias("permissive"))


@query("normal_density", "select p_partkey k, round(exp(-((p_size - 25.0) ** 2) / (2 * 10.0 * 10.0)) / (10.0 * sqrt(2 * pi())), 8) pdf, round(ln(p_size + 1e-9), 6) lg from part")
def normal_density(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.round(C.normal_pdf(F.col("p_size"), 25.0, 10.0), 8).alias("pdf"), F.round(C.log_plus(F.col("p_size"), 1e-9), 6).alias("lg"))


@query("bp_to_mbp", "select o_orderkey k, round(o_totalprice * 100 / 1048576, 2) mbp from orders")
def bp_to_mbp(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), C.mbp(F.col("o_totalprice") * 100).alias("mbp"))


@query("codon_translation", f"""with {SQL_D}, c as (select doc_id, regexp_extract_all(seq, '(?s)...') codons from d)
select doc_id, array_to_string(list_transform(codons, lambda c: case when regexp_full_match(c, '[ACGTacgt]{{3}}') then substring('{C.AMINO}',
cast(16 * strpos('ACGT', upper(substring(c, 1, 1))) + 4 * strpos('ACGT', upper(substring(c, 2, 1))) + strpos('ACGT', upper(substring(c, 3, 1))) - 20 as bigint), 1) else 'X' end), '') protein from c""")
def codon_translation(spark, sf):
    return seqs(spark, sf).select("doc_id", C.translated(F.col("seq")).alias("protein"))


@query("log_sum_exp", "select p_partkey k, round(greatest(p_size, p_retailprice / 100) + ln(1 + exp(-abs(p_size - p_retailprice / 100))), 6) l from part")
def log_sum_exp(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.round(C.log_sum_exp(F.col("p_size"), F.col("p_retailprice") / 100), 6).alias("l"))


@query("json_props", "select event_id, json_extract_string(props, '$.k') k from events")
def json_props(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("insert_sizes", "select event_id, abs(value) size from events where value <> 0 and value > -100 and value < 100")
def insert_sizes(spark, sf):
    return table(spark, sf, "events").where("value <> 0 and value > -100 and value < 100").select("event_id", F.abs("value").alias("size"))


@query("array_sets", """with a as (select l_orderkey k, list_distinct(list(l_linenumber)) x, list_distinct(list(l_suppkey % 7)) y from lineitem group by 1)
select k, len(list_intersect(x, y)) common, len(list_distinct(list_concat(x, y))) every, list_has_any(x, y) touch from a""")
def array_sets(spark, sf):
    a = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set(F.col("l_linenumber").cast("long")).alias("x"), F.collect_set(F.col("l_suppkey") % 7).alias("y"))
    return a.select("k", F.size(F.array_intersect("x", "y")).cast("long").alias("common"), F.size(F.array_union("x", "y")).cast("long").alias("every"), F.arrays_overlap("x", "y").alias("touch"))
