"""Text files named by a column: a data source that writes any number of files in one pass, all of them or none.

Rows are dealt to tasks by their file and sorted, so a task has one file open at a time and holds no rows. A task writes to
a folder of its attempt; files move to their names when the job commits, so a task that fails and runs again leaves no
doubled file, and a job that fails leaves none.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter
from pyspark.sql.types import StructType

from ..functions import columns as C
from .files import Attempt, Written, cleared, committed, emptied, vacant


class KeyedWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.uri = options["path"]
        (emptied if overwrite else vacant)(self.uri)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        attempt, names, out = Attempt(self.uri), [], None
        for batch in iterator:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not names or name != names[-1]:
                    if out is not None:
                        out.close()
                    if not name or any(p in ("", ".", "..") for p in name.split("/")):
                        raise ValueError(f"no name of a file: {name!r}")
                    if "/" in name:
                        attempt.fs.create_dir(f"{attempt.folder}/{name.rpartition('/')[0]}", recursive=True)
                    out = attempt.opened(name)
                    names.append(name)
                out.write((value or "").encode() + b"\n")
        if out is not None:
            out.close()
        return Written(attempt.folder, tuple(names))

    def commit(self, messages: list[Written | None]) -> None:
        committed(self.uri, messages)

    def abort(self, messages: list[Written | None]) -> None:
        cleared(self.uri)


class KeyedFiles(DataSource):
    """df.write.format("keyed_files"): columns file (a name or a path below the target) and value (a line or several)."""

    @classmethod
    def name(cls) -> str:
        return "keyed_files"

    def schema(self) -> str:
        return "file string, value string"

    def writer(self, schema: StructType, overwrite: bool) -> KeyedWriter:
        return KeyedWriter(self.options, overwrite)


def write_keyed(df: DataFrame, path: str, *order: str, mode: str = "errorifexists") -> None:
    """Rows (file, value) as lines of the files that they name, each file's in the given order."""
    df.sparkSession.dataSource.register(KeyedFiles)
    rows = df.repartition("file").sortWithinPartitions("file", *order).select("file", "value")
    rows.write.format("keyed_files").mode("overwrite" if mode == "overwrite" else "append").save(path)


def record(header: F.Column, seq: F.Column, width: int = 60) -> F.Column:
    """A FASTA record as lines, the sequence wrapped."""
    wrapped = F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", "")
    return F.concat(F.lit(">"), header, F.lit("\n"), wrapped)


def write_bin_files(members: DataFrame, path: str, prefix: str = "BIN", digits: int = 4, mode: str = "errorifexists") -> None:
    """One FASTA file for each bin of (bin: a number, contig, seq), such as BIN0007.fa; contigs by name."""
    name = F.concat(F.lit(prefix), F.format_string(f"%0{digits}d", F.col("bin").cast("long")), F.lit(".fa"))
    write_keyed(members.select(name.alias("file"), "contig", record(F.col("contig").cast("string"), F.col("seq")).alias("value")), path, "contig", mode=mode)


def cluster_records(members: DataFrame, order: DataFrame | None = None, least: int = 0) -> DataFrame:
    """file, n and value of every cluster's records, in one pass: members (cluster: its name, contig, seq) and, of
    clusters that have one, an order (cluster, contig, place, forward).

    CL.fna holds all contigs by name, CL.ordered.fna those of the order in its direction; headers are `CL_07 contig:NAME
    ori:+ length:N`, numbered from 1 with as many digits as the last number has. Clusters shorter than `least` are left out.
    """
    from pyspark.sql import Window

    sized = members.select("cluster", "contig", "seq", F.length("seq").cast("long").alias("length"))
    if least:
        large = sized.groupBy("cluster").agg(F.sum("length").alias("extent")).where(F.col("extent") >= least).select("cluster")
        sized = sized.join(large, "cluster", "left_semi")
    none = F.lit(None)
    rows = sized.select(F.concat("cluster", F.lit(".fna")).alias("file"), "cluster", "contig", "seq", "length", none.cast("long").alias("place"), F.lit("UNKNOWN").alias("ori"))
    if order is not None:
        way = order.select("cluster", "contig", F.col("place").cast("long").alias("place"), "forward")
        both = sized.join(way, ["cluster", "contig"])
        turned = F.when(F.col("forward"), F.col("seq")).otherwise(C.reverse_complement(F.col("seq")))
        rows = rows.union(both.select(F.concat("cluster", F.lit(".ordered.fna")), "cluster", "contig", turned, "length", "place", F.when(F.col("forward"), "+").otherwise("-")))
    count = F.count("*").over(Window.partitionBy("file"))
    numbered = rows.withColumns({"n": F.row_number().over(Window.partitionBy("file").orderBy("place", "contig")), "of": F.length(count.cast("string"))})
    digits = F.when(F.length(F.col("n").cast("string")) >= F.col("of"), F.col("n").cast("string")).otherwise(F.lpad(F.col("n").cast("string"), F.col("of"), F.lit("0")))
    header = F.concat("cluster", F.lit("_"), digits, F.lit(" contig:"), F.col("contig").cast("string"), F.lit(" ori:"), "ori", F.lit(" length:"), F.col("length").cast("string"))
    return numbered.select("file", "n", record(header, F.col("seq")).alias("value"))
