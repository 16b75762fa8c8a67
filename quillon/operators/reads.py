"""Trimming of reads: adapters by k-mers with a mismatch, quality from the right, fixed ends, and exact duplicates.

Adapters become an index of numbers: every k-mer of theirs with every single change, and for the end of a read their
shorter beginnings down to `least` bases. The index is a broadcast whose size is checked; reads are looked up batch by
batch in numpy, all places of all reads of a batch at once, without a shuffle. The other steps are expressions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

K, LEAST, LEFT, MODULO, QUALITY, SHORTEST = 23, 11, 10, 5, 10, 50
#: Numbers of an index that is broadcast (8 bytes each).
MOST = 20_000_000
_CODE = np.full(256, 4, np.uint64)
for _i, _b in enumerate(b"ACGT"):
    _CODE[_b] = _CODE[ord(chr(_b).lower())] = _i


def _numbers(seq: str, k: int) -> np.ndarray:
    """The k-mers of a sequence as numbers of base 4; those with another letter are left out."""
    c = _CODE[np.frombuffer(seq.encode(), np.uint8)]
    if len(c) < k:
        return np.empty(0, np.uint64)
    windows = np.lib.stride_tricks.sliding_window_view(c, k)
    windows = windows[(windows < 4).all(axis=1)]
    return windows @ (np.uint64(4) ** np.arange(k - 1, -1, -1, dtype=np.uint64))


def _near(numbers: np.ndarray, k: int) -> np.ndarray:
    """The numbers and all that differ from one in a single base, in order."""
    out = [numbers]
    for place in range(k):
        unit = np.uint64(4) ** np.uint64(place)
        digit = numbers // unit % np.uint64(4)
        for other in range(1, 4):
            out.append(numbers + ((digit + np.uint64(other)) % np.uint64(4)) * unit - digit * unit)
    return np.unique(np.concatenate(out))


def adapter_index(adapters: Iterable[str], k: int = K, least: int = LEAST, mismatch: bool = True) -> dict[int, np.ndarray]:
    """For each length from `least` to k, the numbers that mark an adapter: all k-mers of both strands for k, and what an
    adapter begins with for the shorter ones. ValueError if that is more than a broadcast should hold."""
    turn = str.maketrans("ACGTacgt", "TGCAtgca")
    both = [s for a in adapters for s in (a, a.translate(turn)[::-1])]
    if sum(max(0, len(s) - k + 1) + max(0, k - least) for s in both) * (3 * k + 1 if mismatch else 1) > MOST:
        raise ValueError("the adapters' index is too large for a broadcast")
    out = {}
    for n in range(least, k + 1):
        own = [_numbers(s if n == k else s[:n], n) for s in both]
        own = np.unique(np.concatenate(own)) if own else np.empty(0, np.uint64)
        out[n] = _near(own, n) if mismatch else own
    return out


def adapter_starts(seqs: list[str | None], index: dict[int, np.ndarray]) -> np.ndarray:
    """Where an adapter begins in each read, its length if none does: the first k-mer that is in the index, else the longest
    end of fewer bases that an adapter begins with."""
    k, least = max(index), min(index)
    sizes = np.array([len(s or "") for s in seqs], np.int64)
    whole = _CODE[np.frombuffer("".join(s or "" for s in seqs).encode("ascii", "replace"), np.uint8)]
    first = np.cumsum(sizes) - sizes
    out = sizes.copy()
    if len(whole) >= k:
        number, bad = np.zeros(len(whole) - k + 1, np.uint64), np.zeros(len(whole) - k + 1, bool)
        for j in range(k):
            number = number * np.uint64(4) + (whole[j : j + len(number)] & np.uint64(3))
            bad |= whole[j : j + len(number)] > 3
        read = np.repeat(np.arange(len(sizes)), sizes)[: len(number)]
        inside = np.arange(len(number)) + k <= (first + sizes)[read]
        at = np.flatnonzero(inside & ~bad & _in(number, index[k]))
        np.minimum.at(out, read[at], at - first[read[at]])
    for n in range(k - 1, least - 1, -1):
        some = np.flatnonzero((sizes >= n) & (out == sizes))
        if not len(some) or not len(index[n]):
            continue
        tails = whole[(first + sizes)[some, None] - n + np.arange(n)]
        number = (tails & np.uint64(3)) @ (np.uint64(4) ** np.arange(n - 1, -1, -1, dtype=np.uint64))
        hit = some[(tails < 4).all(axis=1) & _in(number, index[n])]
        out[hit] = sizes[hit] - n
    return out


def _in(x: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(x), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x


def kept_by_quality(qual: Column, least: int = QUALITY) -> Column:
    """Bases left when the end goes whose qualities (letters from !) fall below `least` in sum: the place where the sum of
    quality - least from the right end is lowest, if that is below zero."""
    steps = F.transform(F.reverse(F.split(qual, "")), lambda c: F.ascii(c) - 33 - least)
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"), F.lit(0).alias("low"), F.lit(0).alias("cut"))

    def step(a: Column, x: Column) -> Column:
        s, n = a["sum"] + x, a["n"] + 1
        return F.struct(s.alias("sum"), n.alias("n"), F.least(a["low"], s).alias("low"), F.when(s < a["low"], n).otherwise(a["cut"]).alias("cut"))

    return F.when(F.length(qual) == 0, 0).otherwise(F.length(qual) - F.aggregate(steps, start, step)["cut"])


def trimmed(
    reads: DataFrame, adapters: Iterable[str], k: int = K, least: int = LEAST, left: int = LEFT, modulo: int = MODULO, quality: int = QUALITY, shortest: int = SHORTEST
) -> DataFrame:
    """Reads (columns seq and qual, others stay) cut in this order: at the right to a multiple of `modulo`, at an adapter, at the
    left by `left` bases, at the right by quality; those shorter than `shortest` go. A null sequence is an empty one."""
    index = adapter_index(adapters, k, least)
    held = reads.sparkSession.sparkContext.broadcast(index)
    own = reads.withColumns({"seq": F.coalesce("seq", F.lit("")), "qual": F.coalesce("qual", F.lit(""))})
    if modulo > 1:
        own = own.withColumn("__n", (F.length("seq") - F.length("seq") % modulo).cast("int"))
        own = own.withColumns({c: F.substring(c, F.lit(1), F.col("__n")) for c in ("seq", "qual")}).drop("__n")
    schema = StructType([*own.schema.fields, StructField("__cut", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = adapter_starts(batch.column("seq").to_pylist(), held.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cut, pa.int32())], names=[*batch.schema.names, "__cut"])

    own = own.mapInArrow(run, schema)
    own = own.withColumns({c: F.substring(c, F.lit(left + 1), F.greatest(F.lit(0), F.col("__cut") - left)) for c in ("seq", "qual")}).drop("__cut")
    own = own.withColumn("__n", F.when(F.length("qual") == F.length("seq"), kept_by_quality(F.col("qual"), quality)).otherwise(F.length("seq")).cast("int"))
    own = own.withColumns({c: F.substring(c, F.lit(1), F.col("__n")) for c in ("seq", "qual")}).drop("__n")
    return own.where(F.length("seq") >= shortest)


def without_duplicates(pairs: DataFrame, *seqs: str, name: str = "qname") -> DataFrame:
    """Pairs whose sequences are equal to an earlier pair's go (the first by name stays). Sequences are compared as they are,
    grouped by their hash and themselves; the pairs come back by name, so reads travel once."""
    first = pairs.groupBy(*seqs).agg(F.min(name).alias(name))
    return pairs.join(first.select(name).distinct(), name, "left_semi")
