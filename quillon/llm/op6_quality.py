"""Quality rules: how many documents of a host share a line, and what is left of a document without such lines.

A pass over the texts gives the base counts and, for each distinct normalised line, its hash and its words. Lines are
then counted by host and hash over distinct document ids, so exact copies count in full like near ones. Lines in more
documents of a host than the limits allow are removed, and documents that keep too little are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Hashes, mixed, pa_schema, pick, pieces, stored

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: A line is removed if it is in more documents of a host than both: this share of the host's, and a floor for small hosts.
LIMIT_DOCS = 5
LIMIT_SHARE = 0.01
#: A document is depleted if less than this share of its words, or fewer than LEAST_WORDS, are on other lines.
LEAST_SHARE = 0.5
LEAST_WORDS = 10

SCHEMA = (
    "rid long, doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, lines array<struct<line: long, words: int>>"
)


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside windows of five words that are found twice or more."""
    n = len(hashes) - WINDOW + 1
    if n < 2:
        return 0
    h = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        h = h * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    h = mixed(h)
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    cover = np.zeros(n + WINDOW, np.int32)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def counts(text: str, hashes: Hashes) -> tuple[int, int, int, int, int]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            dup += line in seen
            seen.add(line)
    return (
        len(words),
        len(text) - (len(raw) - len(raw.translate(None, SPACE))),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        dup,
        repeated_words(hashes.of(words)) if len(words) > WINDOW else 0,
    )


def lines_of(text: str) -> dict[int, int]:
    """Hash of each distinct normalised line (lowered, blanks squeezed, words that are numbers alike unless the line has no
    other words) -> words on such lines."""
    out: dict[int, int] = {}
    for line in text.encode("utf-8", "surrogatepass").lower().split(b"\n"):
        words = line.split()
        if words:
            plain = [b"0" if w.isdigit() else w for w in words]
            h = xxhash.xxh3_64_intdigest(b" ".join(plain if any(w != b"0" for w in plain) else words)) - (1 << 63)
            out[h] = out.get(h, 0) + len(words)
    return out


def measured(docs: DataFrame, host_col: str, id_col: str, text_col: str) -> DataFrame:
    out = pa_schema(SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(200_000)
        for batch in batches:
            for lo, hi in pieces(batch):
                rows = []
                for rid, doc_id, text, host in zip(*[c.slice(lo, hi - lo).to_pylist() for c in batch.columns], strict=True):
                    text = text or ""
                    lines = [{"line": k, "words": v} for k, v in lines_of(text).items()]
                    rows.append((rid, doc_id, host or "", *counts(text, hashes), lines))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    picked = pick(docs, id_col, text_col, F.col(host_col).cast("string").alias("host"))
    return picked.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text", "host").mapInArrow(run, SCHEMA)


def judged(
    docs: DataFrame,
    host_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    limit_docs: int = LIMIT_DOCS,
    limit_share: float = LIMIT_SHARE,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_removed_words.

    Null and empty texts have no words and fail the base rule; null hosts are one host. A hot line costs each task one
    partial count, and the join with the lines over the limits has nothing grouped by line above it, so Spark splits the
    partition of a line that a third of all documents hold. The measured table (no texts) is written to the shared folder and read twice.
    """
    base = stored(measured(docs, host_col, id_col, text_col), "measured")
    own = base.select("rid", "host", "doc_id", F.explode("lines").alias("x")).select("rid", "host", "doc_id", "x.line", "x.words")
    once = own.groupBy("host", "line", "doc_id").agg(F.lit(1).alias("one"))  # rows with one id count once
    hosts = base.select("host", "doc_id").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    often = once.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > limit_docs)
    over = often.join(hosts, "host").where(F.col("n") > limit_share * F.col("host_docs")).select("host", "line")
    removed = own.join(over, ["host", "line"]).groupBy("rid").agg(F.sum("words").alias("gone"))
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    depleted = (left < LEAST_WORDS) | (left < least_share * F.col("n_words"))
    return base.drop("lines").join(removed, "rid", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"), F.coalesce("gone", F.lit(0)).cast("long").alias("n_removed_words"),
    )
