"""Removal of later repeats of runs of lines, found by winnowing over line hashes.

A window is the shortest run of lines, from a line on or up to a line, that has MIN_WORDS words, so it depends on the
lines alone. Of each window only the line with the least hash is selected (the last of equal ones); neighbouring windows
mostly select the same one, and these few positions are a document's fingerprints. Every copy of a window selects the
same line of it, so a repeated run of MIN_WORDS words or more is guaranteed to hold a fingerprint that occurs twice.
Positions are joined on the fingerprint; where one has no partner, nothing near it is looked at again. From each joined
position the match is extended both ways by the windows that selected it: those that start at, and those that end at,
each line around it are compared by content, and together they cover any maximal run. All occurrences of a window but the
first (by id, then by line) are deleted. Which pairs of documents share it need not be known, so no pairs are made.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import StringType

from .common import held_for, mixed, pa_schema, pick, pieces, stored, tidy

MIN_WORDS = 50
BLANK = re.compile(r"[\x20\x09-\x0d]*\Z")
LAST = (1 << 63) - 1  # the place of a null id in the order of documents


def lines_of(text: str) -> list[str]:
    """Lines with a word; blank lines are neither counted nor deleted."""
    return [x for x in text.split("\n") if not BLANK.match(x)]


def windows(lines: list[str], least: int) -> list[tuple[int, int, list[tuple[int, int, int]]]]:
    """The selected lines: position, hash, and the windows that selected it, each with its content's hash, start and end
    (exclusive)."""
    n = len(lines)
    raw = [" ".join(x.encode("utf-8", "surrogatepass").decode("latin-1").split()).encode("latin-1") for x in lines]
    own = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in raw), np.uint64, n)
    total = np.concatenate(([0], np.cumsum([x.count(b" ") + 1 for x in raw])))
    if total[-1] < least:
        return []
    forth = np.searchsorted(total, total[:-1] + least)  # end of the window from each line on
    back = np.searchsorted(total, total[1:] - least, "right") - 1  # start of the window up to each line
    spans = {(i, int(j)) for i, j in enumerate(forth) if j <= n} | {(int(i), j + 1) for j, i in enumerate(back) if i >= 0}
    order = mixed(own)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for a, b in sorted(spans):
        at = b - 1 - int(order[a:b][::-1].argmin())
        found.setdefault(at, []).append((xxhash.xxh3_64_intdigest(own[a:b].tobytes(), b - a) - (1 << 63), a, b))
    return [(at, int(order[at]) - (1 << 63), w) for at, w in found.items()]


def fingerprints(docs: DataFrame, least: int) -> DataFrame:
    schema = "doc_id long, mark long, at int, fp long, windows array<struct<win: long, start: int, end: int>>"
    out = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_for()
        for batch in batches:
            for lo, hi in pieces(batch):
                rows = [
                    (i, mark, at, fp, [{"win": h, "start": a, "end": b} for h, a, b in w])
                    for i, text, mark in zip(*[c.slice(lo, hi - lo).to_pylist() for c in batch.columns], strict=True)
                    for at, fp, w in windows(lines_of(text or ""), least)
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)
        tidy()

    return docs.select("doc_id", "text", "mark").mapInArrow(run, schema)


def repeats(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """doc_id, mark, starts, ends: the deleted windows of each document (columns doc_id, text and mark) that has some.

    A hot fingerprint or window costs each task one partial count or minimum; the joins back have no aggregation above
    them on the same key, so Spark can split a large partition.
    """
    found = stored(fingerprints(docs, least), "fingerprints")
    twice = found.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp")
    found = found.join(twice, "fp").select("doc_id", "mark", "fp", F.explode("windows").alias("w"))
    found = stored(found.select("doc_id", "mark", "fp", "w.*").distinct(), "windows", True)  # a repeated row counts once
    place = F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("i"), "mark", "start")
    first = found.groupBy("fp", "win").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = stored(first, "first", True)  # joined from a table, so that a hot window's partition can be split
    return (
        found.join(first, ["fp", "win"])
        .where(place != F.col("first"))
        .groupBy("doc_id", "mark")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("own"))  # a document's own windows
        .select("doc_id", "mark", F.col("own.start").alias("starts"), F.col("own.end").alias("ends"))
    )


def marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.withColumn("__id", F.col(id_col).cast("long")).withColumn("__mark", F.xxhash64(F.col(text_col).cast("string")))


def with_repeats(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """docs with __starts and __ends, null where nothing is deleted."""
    own = marked(docs, id_col, text_col)
    gone = repeats(own.select(F.col("__id").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col("__mark").alias("mark")), least)
    gone = gone.select(F.col("doc_id").alias("__gid"), F.col("mark").alias("__gmark"), F.col("starts").alias("__starts"), F.col("ends").alias("__ends"))
    return own.join(gone, F.col("__id").eqNullSafe(F.col("__gid")) & (F.col("__mark") == F.col("__gmark")), "left")


def joined(starts: list[int] | None, ends: list[int] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in zip([] if starts is None else starts, [] if ends is None else ends, strict=True):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((int(a), int(b)))
    return out


def without(text: str, spans: list[tuple[int, int]]) -> str:
    if not spans:
        return text
    gone = {k for a, b in spans for k in range(a, b)}
    out, k = [], 0
    for line in text.split("\n"):
        if BLANK.match(line):
            out.append(line)
        else:
            if k not in gone:
                out.append(line)
            k += 1
    return "\n".join(out)


def report(docs: DataFrame, least: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs, runs (start:end of deleted lines, joined), kept_sha256 and, if asked for, the
    text that is left, for each row.

    Lines are compared with blanks squeezed. Null and empty texts have no lines. Rows equal in id and text are one
    document and delete nothing of each other; a null id comes last in the order. Texts are read twice and shuffled
    once; lines themselves are never shuffled, only hashes.
    """
    schema = "doc_id long, n_lines long, n_removed long, n_runs long, runs string, kept_sha256 string, kept_text string"
    out = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch):
                rows = []
                for i, text, starts, ends in zip(*[c.slice(lo, hi - lo).to_pylist() for c in batch.columns], strict=True):
                    spans = joined(starts, ends)
                    rest = without(text or "", spans)
                    rows.append((
                        i, len(lines_of(text or "")), sum(b - a for a, b in spans), len(spans), ",".join(f"{a}:{b}" for a, b in spans),
                        hashlib.sha256(rest.encode("utf-8", "surrogatepass")).hexdigest(), rest if with_text else None,
                    ))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    made = with_repeats(pick(docs, id_col, text_col), "doc_id", "text", least).select("doc_id", "text", "__starts", "__ends").mapInArrow(run, schema)
    return made if with_text else made.drop("kept_text")


@pandas_udf(StringType())
def _cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    return pd.Series([t if t is None or a is None else without(t, joined(a, b)) for t, a, b in zip(texts, starts, ends, strict=True)], dtype=object)


def removed(docs: DataFrame, least: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the repeated runs cut out of the text; rows whose every line is a repeat go. All columns stay."""
    made = with_repeats(docs, id_col, text_col, least).withColumn("__cut", _cut(F.col(text_col).cast("string"), "__starts", "__ends"))
    emptied = F.col("__starts").isNotNull() & (F.translate("__cut", " \t\n\x0b\x0c\r", "") == "")
    return made.where(~emptied).withColumn(text_col, F.col("__cut")).select(*docs.columns)
