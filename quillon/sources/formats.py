"""Scans and sinks of the text formats: sequences, alignments, hits, trees and tables. All splitting is JVM-side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C


def fasta(spark: SparkSession, path: str, min_len: int = 0) -> DataFrame:
    """file, header, contig (up to the first blank) and seq. Records are split by the reader at a '>' that begins a line, so files
    split between tasks and headers may hold '>'; compressed files are opened by their suffix."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "^\\s*>", "").alias("value")).where(F.trim("value") != "")
    lines = F.split("value", "\r?\n", 2)
    return (
        rows.select("file", F.trim(lines[0]).alias("header"), F.regexp_replace(F.coalesce(F.get(lines, 1), F.lit("")), r"\s", "").alias("seq"))
        .withColumn("contig", C.first_word(F.col("header")))
        .withColumn("length", F.length("seq").cast("long"))
        .where(F.col("length") >= min_len)
    )


def fasta_count(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.col("value").startswith(">")).agg(F.count("*").alias("records"))


def bin_set(spark: SparkSession, path: str) -> DataFrame:
    """bin (the file's name without its extension), contig, length of a folder of FASTA files."""
    name = F.regexp_extract("file", r"([^/]+)\.[^./]+$", 1)
    return fasta(spark, path).select(name.alias("bin"), "contig", "length", "seq")


def majority_extension(spark: SparkSession, path: str) -> DataFrame:
    ext = F.regexp_extract("path", r"\.([^./]+)$", 1)
    files = spark.read.format("binaryFile").load(path).select(ext.alias("extension"))
    return files.groupBy("extension").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "extension").limit(1)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (where a task's part of the file begins), n (the line's number in the file from 0) and value. Lines are
    numbered within their part, and parts are shifted by the lines of those before them: one number for each part."""
    from pyspark.sql import Window

    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value"
    )
    sizes = rows.groupBy("file", "block").agg(F.count("*").alias("lines"))
    before = F.coalesce(F.sum("lines").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.select(F.col("file").alias("__file"), F.col("block").alias("__block"), before.alias("__before"))
    own = F.row_number().over(Window.partitionBy("file", "block").orderBy("at")) - 1
    made = rows.withColumn("n", own).join(parts, (F.col("file") == F.col("__file")) & (F.col("block") == F.col("__block")))
    return made.select("file", "block", (F.col("n") + F.col("__before")).alias("n"), "value")


def fastq(spark: SparkSession, path: str, mate: int) -> DataFrame:
    """qname, mate, seq, qual. Four lines are a record, by their numbers in the file."""
    n = numbered_lines(spark, path)
    four = n.groupBy("file", F.floor(F.col("n") / 4).alias("rec")).agg(*[F.max(F.when(F.col("n") % 4 == k, F.col("value"))).alias(c) for k, c in ((0, "name"), (1, "seq"), (3, "qual"))])
    return four.select(F.regexp_replace(C.first_word(F.expr("substring(name, 2)")), "/[12]$", "").alias("qname"), F.lit(mate).alias("mate"), "seq", "qual")


SAM = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment lines with file_pos (their order) and tags."""
    f = F.split("value", "\t")
    kinds = {"flag": "int", "pos": "long", "mapq": "int", "pnext": "long", "tlen": "long"}
    columns = [f[k].cast(kinds.get(c, "string")).alias(c) for k, c in enumerate(SAM)]
    return spark.read.text(path).withColumn("file_pos", F.monotonically_increasing_id()).where(~F.col("value").startswith("@")).select("file_pos", *columns, F.slice(f, F.lit(12), F.greatest(F.size(f) - 11, F.lit(0))).alias("tags"))


def sam_header(spark: SparkSession, path: str) -> DataFrame:
    """refid, name, length in header order."""
    from pyspark.sql import Window

    h = spark.read.text(path).withColumn("at", F.monotonically_increasing_id()).where(F.col("value").startswith("@SQ"))
    r = h.select("at", F.regexp_extract("value", r"SN:([^\t]+)", 1).alias("name"), F.regexp_extract("value", r"LN:(\d+)", 1).cast("long").alias("length"))
    return r.select((F.row_number().over(Window.orderBy("at")) - 1).alias("refid"), "name", "length")  # a header fits one task


def domain_hits(spark: SparkSession, path: str) -> DataFrame:
    """Whitespace columns of a per-domain table without comments."""
    f = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(
        f[0].alias("target"), f[3].alias("query"), f[5].cast("int").alias("qlen"), f[6].cast("double").alias("evalue"), f[7].cast("double").alias("score"),
        f[15].cast("int").alias("hmm_from"), f[16].cast("int").alias("hmm_to"), C.contig_of_gene(f[0]).alias("contig"),
    )


def marker_table(spark: SparkSession, path: str) -> DataFrame:
    """bin, marker, gene (the first of several) and its scaffold."""
    t = spark.read.option("sep", "\t").option("header", True).csv(path)
    gene = F.split(F.col(t.columns[2]), "&&")[0]
    return t.select(F.col(t.columns[0]).alias("bin"), F.col(t.columns[1]).alias("marker"), gene.alias("gene"), F.regexp_replace(gene, "_[^_]*$", "").alias("scaffold"))


def cluster_tree(spark: SparkSession, path: str) -> DataFrame:
    """node and cluster of a flow tree: the path without its last step, clusters numbered by size."""
    from ..operators.ordering import dense_numbers

    f = F.split(F.trim("value"), r"\s+")
    steps = F.split(f[0], ":")
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    r = rows.select(F.element_at(f, -1).cast("long").alias("node"), F.array_join(F.slice(steps, F.lit(1), F.size(steps) - 1), ":").alias("path"))
    size = r.groupBy("path").agg(F.count("*").alias("n")).select("path", F.struct((-F.col("n")).alias("n"), "path").alias("by"))
    return r.join(dense_numbers(size, "by", "cluster").select("path", "cluster"), "path").select("node", "cluster")


def table(spark: SparkSession, path: str, schema: str | None = None, sep: str = "\t") -> DataFrame:
    r = spark.read.option("header", True).option("sep", sep)
    return (r.schema(schema) if schema else r.option("inferSchema", True)).csv(path)


def dict_stats(spark: SparkSession, path: str) -> DataFrame:
    """bin and figures of lines `name<tab>{'key': value, ...}`."""
    f = F.split("value", "\t", 2)
    return spark.read.text(path).select(f[0].alias("bin"), F.from_json(F.translate(f[1], "'", '"'), "map<string,string>").alias("figures"))


def gene_calls(spark: SparkSession, path: str) -> DataFrame:
    """seqid, start, end, strand, frame, score: the header line is carried down to its calls."""
    from pyspark.sql import Window

    head = F.when(F.col("value").startswith(">"), C.first_word(F.expr("substring(value, 2)")))
    rows = numbered_lines(spark, path).withColumn("head", head)
    # a part that begins without a header goes on with the last one of the parts before it
    last = rows.groupBy("file", "block").agg(F.max_by("head", F.when(F.col("head").isNotNull(), F.col("n"))).alias("head"))
    given = F.last("head", ignorenulls=True).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    parts = last.select(F.col("file").alias("__file"), F.col("block").alias("__block"), given.alias("__given"))
    w = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    f = F.split(F.trim("value"), r"\s+")
    own = rows.withColumn("seqid", F.last("head", ignorenulls=True).over(w)).join(parts, (F.col("file") == F.col("__file")) & (F.col("block") == F.col("__block")))
    return own.where(F.col("head").isNull()).select(
        F.coalesce("seqid", "__given").alias("seqid"), f[0].cast("long").alias("start"), f[1].cast("long").alias("end"), f[2].alias("strand"), f[3].cast("int").alias("frame"), f[4].cast("double").alias("score")
    )


def index_sidecar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").schema("name string, length long, offset long, bases int, width int").csv(path).orderBy(F.desc("length"), "name")


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


# -- sinks -------------------------------------------------------------------------------------------------------------
def fasta_lines(df: DataFrame, name: str = "contig", seq: str = "seq", width: int = 100) -> DataFrame:
    """One text value for each record, the sequence wrapped."""
    wrapped = F.regexp_replace(F.regexp_replace(F.col(seq), f"(.{{{width}}})", "$1\n"), "\n$", "")
    return df.withColumn("value", F.concat(F.lit(">"), F.col(name), F.lit("\n"), wrapped))


def write_bins(df: DataFrame, path: str) -> None:
    """One folder of FASTA text for each bin."""
    fasta_lines(df).select("bin", "value").write.partitionBy("bin").text(path)


def write_clusters(df: DataFrame, path: str) -> None:
    df.select("contig", "cluster").write.option("sep", "\t").csv(path)


def write_table(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.option("header", True).option("sep", sep).csv(path)


def write_fanned(df: DataFrame, path: str, *keys: str) -> None:
    """Several outputs by key, for example bin, tier and mate."""
    df.write.partitionBy(*keys).parquet(path)


def metrics_lines(df: DataFrame) -> DataFrame:
    """`key: value` lines of a one-row frame: four decimals for floats, N/A for nulls."""
    parts = []
    for c, kind in df.dtypes:
        text = F.when(F.col(c).isNotNull(), F.format_string("%.4f", F.col(c))) if kind in ("double", "float") else F.col(c).cast("string")
        parts.append(F.concat(F.lit(f"{c}: "), F.coalesce(text, F.lit("N/A"))))
    return df.select(F.explode(F.array(*parts)).alias("value"))


def flow_rows(refined: DataFrame, a: str, b: str) -> DataFrame:
    """Flows between the bins of two sets, in millions of bases."""
    return refined.groupBy(a, b).agg(C.mbp(F.sum("extent")).alias("mbp"))
