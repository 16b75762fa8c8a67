"""Round trips through the sources and sinks: a table is written in a format to the shared folder and scanned again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import bam, formats, keyed, npz, tables
from ..streaming import counts
from .inputs import SQL_E, SQL_P, contigs, edges, paired, table
from .registry import query


@query("fasta_roundtrip", r"select 'd' || doc_id contig, length(regexp_replace(replace(text, '>', ''), '\s', '', 'g')) length from documents where length(regexp_replace(replace(text, '>', ''), '\s', '', 'g')) >= 1000")
def fasta_roundtrip(spark, sf):
    path = tables.shared_dir(spark)
    d = table(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("contig"), F.regexp_replace(F.translate("text", ">", ""), r"\s", "").alias("seq"))
    formats.fasta_lines(d).select("value").write.text(path)
    return formats.fasta(spark, path, 1000).select("contig", F.col("length"))


@query("fasta_count", "select count(*) records from documents")
def fasta_count(spark, sf):
    path = tables.shared_dir(spark)
    d = table(spark, sf, "documents").select(F.concat(F.lit(">d"), F.col("doc_id").cast("string"), F.lit("\n"), F.regexp_replace("text", r"[>\s]", "")).alias("value"))
    d.write.text(path)
    return formats.fasta_count(spark, path)


@query("bin_folder_scan", r"select lang bin, count(*) contigs, cast(sum(length(regexp_replace(replace(text, '>', ''), '\s', '', 'g'))) as bigint) extent from documents where length(text) > 0 group by 1")
def bin_folder_scan(spark, sf):
    path = tables.shared_dir(spark)
    d = table(spark, sf, "documents").where("length(text) > 0").select(F.col("lang").alias("bin"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("contig"), F.regexp_replace(F.translate("text", ">", ""), r"\s", "").alias("seq"))
    formats.write_bins(d, path)
    got = formats.fasta(spark, f"{path}/*")
    return got.groupBy(F.regexp_extract("file", "bin=([^/]+)", 1).alias("bin")).agg(F.count("*").alias("contigs"), F.sum("length").alias("extent"))


@query("sam_roundtrip", "select count(*) n, cast(sum(l_linenumber) as bigint) flags, cast(sum(l_partkey) as bigint) pos from lineitem where (l_linenumber & 4) = 0")
def sam_roundtrip(spark, sf):
    path = tables.shared_dir(spark)
    li = table(spark, sf, "lineitem")
    f = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")]
    li.select(F.concat_ws("\t", *f, F.lit("60"), F.lit("50M"), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*"), F.lit("NM:i:1")).alias("value")).write.text(path)
    s = formats.sam(spark, path)
    return s.where(F.col("flag").bitwiseAND(F.lit(4)) == 0).agg(F.count("*").alias("n"), F.sum("flag").alias("flags"), F.sum("pos").alias("pos"))


@query("tsv_roundtrip", "select p_partkey contig, p_brand cluster from part")
def tsv_roundtrip(spark, sf):
    path = tables.shared_dir(spark)
    formats.write_clusters(table(spark, sf, "part").select(F.col("p_partkey").alias("contig"), F.col("p_brand").alias("cluster")), path)
    return spark.read.option("sep", "\t").schema("contig long, cluster string").csv(path)


@query("metrics_report", "select 'orders: ' || count(*) as value from orders union all select 'mean: ' || format('{:.4f}', avg(o_totalprice)) from orders union all select 'none: N/A'")
def metrics_report(spark, sf):
    one = table(spark, sf, "orders").agg(F.count("*").alias("orders"), F.avg("o_totalprice").alias("mean"), F.lit(None).cast("double").alias("none"))
    return formats.metrics_lines(one)


@query("streaming_pair_counts", f"with {SQL_P} select least(a, b) i, greatest(a, b) j, count(*) v from p group by 1, 2")
def streaming_pair_counts(spark, sf):
    source, out = tables.shared_dir(spark), tables.shared_dir(spark)
    p = paired(spark, sf).select("a", "b")
    p.write.parquet(source)
    stream = spark.readStream.schema(p.schema).parquet(source)
    counts.run_once(counts.pair_counts(stream), out, tables.shared_dir(spark))
    return spark.read.parquet(out)


@query("streaming_windows", """select cast(epoch(time_bucket(interval '1 day', ts, timestamp '1970-01-01')) as bigint) "day", event_type, count(*) v from events group by 1, 2""")
def streaming_windows(spark, sf):
    source, out = tables.shared_dir(spark), tables.shared_dir(spark)
    e = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    e.write.parquet(source)
    stream = spark.readStream.schema(e.schema).parquet(source)
    by = stream.withWatermark("ts", "1 day").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("v"))
    counts.run_once(by, out, tables.shared_dir(spark))
    return spark.read.parquet(out).select(F.unix_timestamp("w.start").alias("day"), "event_type", "v")


SQL_READS = """c as (select 's' || s_suppkey rname, 1000 + s_suppkey * 7919 % 50000 length from supplier),
a as (select 'r' || l_orderkey qname, cast(l_linenumber * 16 % 256 as int) flag, 's' || l_suppkey rname, 1 + l_partkey * 7919 % length pos, cast(l_quantity as int) mapq, (l_linenumber + 20) || 'M' cigar, l_partkey tlen, l_comment_or seq from
 (select l.*, length, substring('ACGTTGCAACGGTTAACCGGTATCGATCGAT', 1, cast(l_linenumber + 20 as int)) l_comment_or from lineitem l join c on c.rname = 's' || l_suppkey))"""


def reads(spark, sf):
    """Line items as alignments to their suppliers."""
    k = F.col
    v = contigs(spark, sf).select(k("contig").alias("l_suppkey"), "length")
    name, none = F.concat(F.lit("s"), k("l_suppkey").cast("string")), F.lit("*")
    bases = (k("l_linenumber") + 20).cast("int")
    return table(spark, sf, "lineitem").join(v, "l_suppkey").select(
        F.concat(F.lit("r"), k("l_orderkey").cast("string")).alias("qname"), (k("l_linenumber") * 16 % 256).cast("int").alias("flag"), name.alias("rname"), (1 + k("l_partkey") * 7919 % k("length")).alias("pos"),
        k("l_quantity").cast("int").alias("mapq"), F.concat(bases.cast("string"), F.lit("M")).alias("cigar"), none.alias("rnext"), F.lit(0).cast("long").alias("pnext"), k("l_partkey").cast("long").alias("tlen"),
        F.substring(F.lit("ACGTTGCAACGGTTAACCGGTATCGATCGAT"), F.lit(1), bases).alias("seq"), none.alias("qual"), F.array(F.concat(F.lit("NM:i:"), k("l_linenumber").cast("string"))).alias("tags"),
    )


def references(spark, sf):
    return contigs(spark, sf).select(F.concat(F.lit("s"), F.col("contig").cast("string")).alias("name"), "length")


@query("bam_roundtrip", f"with {SQL_READS} select qname, flag, rname, pos, mapq, cigar, tlen, seq, 'NM:i:' || (cast(substring(cigar, 1, 2) as int) - 20) tag from a")
def bam_roundtrip(spark, sf):
    """Written in the order of names, read in splits of 100 kB, none of which begins where a record does."""
    path = tables.shared_dir(spark)
    bam.write_bam(reads(spark, sf), path, references(spark, sf), "queryname")
    got = bam.bam(spark, path, "queryname", split=100_000)
    return got.select("qname", "flag", "rname", "pos", "mapq", "cigar", "tlen", "seq", F.element_at("tags", 1).alias("tag"))


@query("bam_references", "select row_number() over (order by 's' || s_suppkey) - 1 refid, 's' || s_suppkey as name, 1000 + s_suppkey * 7919 % 50000 length from supplier")
def bam_references(spark, sf):
    path = tables.shared_dir(spark)
    bam.write_bam(reads(spark, sf).where("mapq > 45"), path, references(spark, sf))
    return bam.bam_header(spark, path).select(F.col("refid").cast("long").alias("refid"), "name", "length")


@query("bam_mapped_order", f"with {SQL_READS} select rname, count(*) n, min(pos) first, max(pos) last, 0 as steps_back from a where flag & 4 = 0 group by 1")
def bam_mapped_order(spark, sf):
    """Mapped records in coordinate order: within a file none lies before the one ahead of it."""
    from pyspark.sql import Window

    path = tables.shared_dir(spark)
    bam.write_bam(reads(spark, sf), path, references(spark, sf), "coordinate")
    got = bam.mapped(spark, path, "file string, file_pos long, flag int, rname string, pos long")
    back = F.coalesce(F.lag("pos").over(Window.partitionBy("file", "rname").orderBy("file_pos")) > F.col("pos"), F.lit(False))
    return got.withColumn("back", back).groupBy("rname").agg(F.count("*").alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.count_if("back").cast("int").alias("steps_back"))


@query("bam_region", f"with {SQL_READS} select qname, pos from a where rname = 's7' and pos <= 20000 and pos + cast(substring(cigar, 1, 2) as int) - 1 >= 5000")
def bam_region(spark, sf):
    path = tables.shared_dir(spark)
    bam.write_bam(reads(spark, sf), path, references(spark, sf), "coordinate")
    return bam.bam(spark, path, region="s7:5000-20000", fields="qname string, pos long", split=20_000)


@query("bin_files", r"""select 'BIN' || format('{:04d}', p_size) || '.fa' as file, count(*) records, cast(sum(length(p_name)) as bigint) bases from (select p_size, regexp_replace(p_name, '[>\s]', '', 'g') p_name from part) where length(p_name) > 0 group by 1""")
def bin_files(spark, sf):
    """One file for each bin, with padded numbers in their names; all of them are read back as a bin set."""
    path = tables.shared_dir(spark)
    p = table(spark, sf, "part").select(F.col("p_size").alias("bin"), F.concat(F.lit("k"), F.col("p_partkey").cast("string")).alias("contig"), F.regexp_replace("p_name", r"[>\s]", "").alias("seq"))
    keyed.write_bin_files(p.where("length(seq) > 0"), path)
    got = formats.bin_set(spark, f"{path}/*.fa")
    return got.groupBy(F.concat("bin", F.lit(".fa")).alias("file")).agg(F.count("*").alias("records"), F.sum("length").alias("bases"))


@query("cluster_files", r"""with d as (select doc_id, 'CL' || substring(lang, 1, 2) c, regexp_replace(text, '[^ACGTacgt]', '', 'g') s from documents), k as (select * from d where length(s) > 0),
n as (select *, row_number() over (partition by c order by 'd' || doc_id) r, length(cast(count(*) over (partition by c) as varchar)) w from k)
select c || '_' || lpad(cast(r as varchar), cast(w as int), '0') header, 'd' || doc_id contig, 'UNKNOWN' ori, length(s) length, s seq from n
union all select c || '_' || lpad(cast(row_number() over (partition by c order by doc_id desc) as varchar), cast(length(cast(count(*) over (partition by c) as varchar)) as int), '0'), 'd' || doc_id, case when doc_id % 2 = 0 then '+' else '-' end, length(s),
 case when doc_id % 2 = 0 then s else reverse(translate(s, 'ACGTacgt', 'TGCAtgca')) end from k where doc_id % 3 = 0""")
def cluster_files(spark, sf):
    """Clusters as FASTA with new headers, and an ordered variant of some of their contigs, in one pass; read back."""
    path = tables.shared_dir(spark)
    d = table(spark, sf, "documents").select(F.concat(F.lit("CL"), F.substring("lang", 1, 2)).alias("cluster"), "doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("contig"), F.regexp_replace("text", "[^ACGTacgt]", "").alias("seq"))
    d = d.where("length(seq) > 0")
    order = d.where("doc_id % 3 = 0").select("cluster", "contig", (-F.col("doc_id")).alias("place"), (F.col("doc_id") % 2 == 0).alias("forward"))
    keyed.write_keyed(keyed.cluster_records(d, order), path, "n")
    part = lambda n: F.regexp_extract("header", rf"{n}:(\S+)", 1)
    return formats.fasta(spark, f"{path}/*.fna").select(F.col("contig").alias("header"), part("contig").alias("contig"), part("ori").alias("ori"), part("length").cast("long").alias("length"), "seq")


@query("table_scan", "select s_suppkey, s_name, s_acctbal, s_nationkey from supplier")
def table_scan(spark, sf):
    """A table with a header, its kinds found by the reader."""
    path = tables.shared_dir(spark)
    formats.write_table(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal", "s_nationkey"), path, "\t")
    got = formats.table(spark, path)
    return got.select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name", "s_acctbal", F.col("s_nationkey").cast("int").alias("s_nationkey"))


@query("marker_table_scan", "select p_brand bin, p_type marker, 's' || p_size || '_' || p_partkey gene, 's' || p_size scaffold from part")
def marker_table_scan(spark, sf):
    """Markers with the first of several genes, and the scaffold in its name."""
    path = tables.shared_dir(spark)
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    genes = F.concat(F.lit("s"), size, F.lit("_"), key, F.lit("&&x_"), key)
    formats.write_table(table(spark, sf, "part").select(F.col("p_brand").alias("Bin Id"), F.col("p_type").alias("Marker Id"), genes.alias("Gene Id")), path, "\t")
    return formats.marker_table(spark, path)


@query("extension_majority", "select case when n_regionkey % 2 = 0 then 'fa' else 'fna' end extension, count(*) n from nation group by 1 order by n desc, extension limit 1")
def extension_majority(spark, sf):
    """The commonest extension of a folder's files."""
    path = tables.shared_dir(spark)
    ext = F.when(F.col("n_regionkey") % 2 == 0, ".fa").otherwise(".fna")
    keyed.write_keyed(table(spark, sf, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), ext).alias("file"), F.col("n_name").alias("value")), path, "value")
    return formats.majority_extension(spark, f"{path}/n*")


@query("sparse_archive", f"with {SQL_E} select i, j, cast(v as double) v from e")
def sparse_archive(spark, sf):
    """The contact matrix as sparse array files and back, in splits of a thousand entries."""
    path = tables.shared_dir(spark)
    e = tables.stored(edges(spark, sf))
    size = int(contigs(spark, sf).agg(F.max("contig")).first()[0]) + 1
    npz.write_npz(e, path, size, size)
    return npz.npz(spark, path, 1000)


SQL_TRIM = f"""t as (select doc_id, translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'BDEFHIJKLMNOPQRSUVWXYZ', 'ACGTACGTACGTACGTACGTAC') s from documents where text is not null),
w as (select doc_id, unnest(p) s, generate_subscripts(p, 1) - 1 n from (select doc_id, regexp_extract_all(s, '.{{60}}') p from t)),
u as (select doc_id, n, s || case when (doc_id + n) % 3 = 0 then left('AGATCGGAAGAGCACACGTCTGAACTCCAGTCA', cast(12 + doc_id % 20 as int)) else '' end s from w),
m as (select doc_id, n, left(s, length(s) - length(s) % 5) s from u), k as (select doc_id, n, s, unnest(range(1, length(s) - 21)) i from m),
mers as (select distinct substring(a, j, 23) m from (select a, unnest(range(1, length(a) - 21)) j from (select unnest(['AGATCGGAAGAGCACACGTCTGAACTCCAGTCA', reverse(translate('AGATCGGAAGAGCACACGTCTGAACTCCAGTCA', 'ACGT', 'TGCA'))]) a))),
hit as (select doc_id, n, min(i) - 1 cut from k, mers where hamming(substring(s, i, 23), m) <= 1 group by 1, 2),
ends as (select doc_id, n, min(length(s) - z) cut from m, (select unnest(range(11, 23)) z), (select unnest(['AGATCGGAAGAGCACACGTCTGAACTCCAGTCA', reverse(translate('AGATCGGAAGAGCACACGTCTGAACTCCAGTCA', 'ACGT', 'TGCA'))]) a) where length(s) >= z and hamming(right(s, cast(z as int)), left(a, cast(z as int))) <= 1 group by 1, 2)"""


@query("trimmed_reads", f"with {SQL_TRIM} select doc_id, n, substring(s, 11, greatest(0, coalesce(hit.cut, ends.cut, length(s)) - 10)) seq from m left join hit using (doc_id, n) left join ends using (doc_id, n) where coalesce(hit.cut, ends.cut, length(s)) - 10 >= 35")
def trimmed_reads(spark, sf):
    """The letters of whole texts in reads of 60, some with the beginning of an adapter at their end; cut at adapters and at both ends."""
    from ..operators import reads as trimming

    letters = F.translate(F.upper(F.regexp_replace("text", "[^A-Za-z]", "")), "BDEFHIJKLMNOPQRSUVWXYZ", "ACGTACGTACGTACGTACGTAC")
    tiles = F.posexplode(F.regexp_extract_all(letters, F.lit(".{60}"), F.lit(0))).alias("n", "s")
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", tiles)
    adapter = "AGATCGGAAGAGCACACGTCTGAACTCCAGTCA"
    tail = F.when((F.col("doc_id") + F.col("n")) % 3 == 0, F.substring(F.lit(adapter), F.lit(1), (12 + F.col("doc_id") % 20).cast("int"))).otherwise("")
    seq = F.concat("s", tail)
    made = d.select("doc_id", F.col("n").cast("long").alias("n"), seq.alias("seq"), F.repeat(F.lit("I"), F.length(seq)).alias("qual"))
    return trimming.trimmed(made, [adapter], shortest=35).select("doc_id", "n", "seq")
