"""Removal of repeated byte strings by distributed suffix arrays built with a difference cover.

Every string of `least` bytes has one minimiser: the least hash of the GRAM-byte strings inside it. Equal strings have
equal minimisers, so strings are dealt to buckets by minimiser, and a string whose minimiser no second document has
cannot be repeated and goes nowhere. Each bucket holds the stretches of text whose strings share its minimisers, sorts
their suffixes by difference cover (triples at two of three places are sorted and named, the names' own suffixes are
sorted by recursion, the remaining suffixes by one byte and a name, and both are merged), compares the prefixes of
neighbours, and answers with the smallest document of each run of equal ones.

Whole copies of a text are settled before: only the copy with the smallest id takes part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MULTIPLIER, dropped, mixed, pa_schema, pick, released, stored

LEAST = 50
GRAM = 24
BLOCK = 12_000_000  # bytes of a block, one document at least
CHUNK = 1_000_000  # strings whose hashes are in memory at once
SORT = 3_000_000  # bytes that a suffix array is built over, one minimiser's stretches at least
MOST = 64  # strings of one stretch
SPREAD = 1000  # a minimiser in more blocks than this is dealt by whole strings instead
LAST = (1 << 63) - 1  # a null id: smaller than none


# -- suffix arrays -----------------------------------------------------------------------------------------------------
def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of all suffixes of positive integers in order; the end of the text is less than anything."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate((s.astype(np.int64), np.zeros(3, np.int64)))
    wide = int(s.max()).bit_length()
    # the sampled places; one more ends the first third's names if the length is 3k + 1
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate((one, two))
    if 3 * wide <= 64:
        u = t.astype(np.uint64)
        key = (u[sample] << np.uint64(2 * wide)) | (u[sample + 1] << np.uint64(wide)) | u[sample + 2]
        order = np.argsort(key)
        k = key[order]
        new = k[1:] != k[:-1]
    else:
        a, b, c = t[sample], t[sample + 1], t[sample + 2]
        order = np.lexsort((c, b, a))
        a, b, c = a[order], b[order], c[order]
        new = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])
    name = np.empty(len(sample), np.int64)
    name[order] = np.concatenate(([1], 1 + np.cumsum(new)))
    if not new.all():
        order = suffix_array(name)
        name[order] = np.arange(1, len(sample) + 1)
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = name
    rank[n:] = 0
    sampled = sample[order]
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    size = int(rank.max()) + 1
    rest = rest[np.argsort(t[rest] * size + rank[rest + 1])]
    # merge: the sampled suffixes before each remaining one, counted apart for the two kinds of places, since a suffix is
    # compared with the first kind by one symbol and a rank, and with the second by two symbols and a rank
    ones, twos = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    low = np.searchsorted(t[ones] * size + rank[ones + 1], t[rest] * size + rank[rest + 1])
    if 2 * wide + size.bit_length() <= 62:
        pair = (t[:-1] << wide) | t[1:]
    else:
        _, pair = np.unique((t[:-1] << wide) | t[1:], return_inverse=True)
    low += np.searchsorted(pair[twos] * size + rank[twos + 2], pair[rest] * size + rank[rest + 2])
    out = np.empty(n, np.int64)
    place = low + np.arange(len(rest))
    taken = np.zeros(n, bool)
    taken[place] = True
    out[place] = rest
    out[~taken] = sampled
    return out


def least_owner(data: np.ndarray, sizes: np.ndarray, owners: np.ndarray, least: int) -> np.ndarray:
    """For each string of `least` bytes of each stretch, in order, the smallest owner of an equal string."""
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    # a mark of its own value 1 ends each stretch; bytes are 2 and more
    text = np.ones(len(data) + len(sizes), np.int64)
    shift = np.repeat(np.arange(len(sizes)), sizes)
    text[np.arange(len(data)) + shift] = data.astype(np.int64) + 2
    strings = sizes.astype(np.int64) - least + 1
    where = np.repeat(starts + np.arange(len(sizes)) - np.concatenate(([0], np.cumsum(strings)[:-1])), strings) + np.arange(strings.sum())
    number = np.full(len(text), -1, np.int64)
    number[where] = np.arange(len(where))
    order = suffix_array(text)
    order = order[number[order] >= 0]
    # neighbours with equal prefixes, eight bytes at a time
    same = np.ones(len(order) - 1, bool)
    packed = text[: len(text) - 7].astype(np.uint64)
    for k in range(1, 7):  # nine bits a byte, seven bytes a number
        packed = packed | text[k : len(text) - 7 + k].astype(np.uint64) << np.uint64(9 * k)
    for k in [*range(0, least - 6, 7), least - 7]:
        p = packed[np.minimum(order + k, len(packed) - 1)]
        same &= p[1:] == p[:-1]
    group = np.concatenate(([0], np.cumsum(~same)))
    owner = np.repeat(owners, strings)[number[order]]
    first = np.minimum.reduceat(owner, np.concatenate(([0], np.flatnonzero(~same) + 1)))
    out = np.empty(len(where), np.int64)
    out[number[order]] = first[group]
    return out


def judged(texts: list[bytes], owners: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the strings of distinct stretches, the smallest owners, where each stretch's begin, and how many it has.

    Strings with one minimiser that are all in one stretch have that stretch's owner; only minimisers with several
    stretches (the rims of repeats, and copies with changes) are sorted.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    strings = sizes - least + 1
    offset = np.concatenate(([0], np.cumsum(strings)[:-1]))
    out = np.repeat(owners, strings)
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    _, where, count = np.unique(minimisers(data, least)[begin], return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[where] > 1)
    if len(several):
        several = several[np.argsort(where[several], kind="stable")]
        of = where[several]
        total = np.cumsum(sizes[several])
        lo = 0
        while lo < len(several):  # whole minimisers, up to SORT bytes at a time
            hi = int(np.searchsorted(total, (total[lo - 1] if lo else 0) + SORT)) + 1
            hi = int(np.searchsorted(of, of[min(hi, len(of)) - 1], "right"))
            some = several[lo:hi]
            text = np.frombuffer(b"".join([texts[k] for k in some]), np.uint8)
            k = strings[some]
            out[np.repeat(offset[some], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)] = least_owner(text, sizes[some], owners[some], least)
            lo = hi
    return out, offset, strings


# -- minimisers --------------------------------------------------------------------------------------------------------
def runs_of(data: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of strings with one minimiser, at most MOST strings each, and the minimisers."""
    n = len(data) - least + 1
    parts = [_runs(data[lo : min(n, lo + CHUNK) + least - 1], lo, least) for lo in range(0, n, CHUNK)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))  # type: ignore[return-value]


def minimisers(data: np.ndarray, least: int) -> np.ndarray:
    """The least hash of the GRAM-byte strings inside each string of `least` bytes."""
    h = data[:-1].astype(np.uint64) | data[1:].astype(np.uint64) << np.uint64(8)
    h = h[:-2] | h[2:] << np.uint64(16)
    h = h[:-4] | h[4:] << np.uint64(32)
    h = mixed(h[:-16] * MULTIPLIER + mixed(h[8:-8] * MULTIPLIER + mixed(h[16:])))
    span = least - GRAM + 1
    width = 1
    while 2 * width <= span:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.minimum(h[: len(h) - (span - width)], h[span - width :]) if width < span else h


def _runs(data: np.ndarray, at: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = minimisers(data, least)
    starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    ends = np.append(starts[1:], len(h))
    long = ends - starts > MOST
    if long.any():  # cut long runs
        starts = np.concatenate([starts[~long], *[np.arange(a, b, MOST) for a, b in zip(starts[long], ends[long], strict=True)]])
        starts.sort()
        ends = np.append(starts[1:], len(h))
    return starts + at, ends + at, h[starts]


BLOCKS = "block long, ids binary, sizes binary, data binary"


def packed(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> bytes:
    return pa.decompress(data, decompressed_size=int(size), codec="zstd", asbytes=True) if size else b""


def blocked(texts: DataFrame) -> DataFrame:
    out = pa_schema(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held = TaskContext.get().partitionId(), 0, 0
        ids: list[int] = []
        raw: list[bytes] = []

        def flush() -> pa.RecordBatch:
            nonlocal made, held, ids, raw
            row = [(part << 32) + made, np.array(ids, np.int64).tobytes(), np.array([len(x) for x in raw], np.int64).tobytes(), packed(b"".join(raw))]
            made, held, ids, raw = made + 1, 0, [], []
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, out, strict=True)], schema=out)

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(i.as_py())
                raw.append(text.as_buffer().to_pybytes())
                held += len(raw[-1])
                if held >= BLOCK:
                    yield flush()
        if ids:
            yield flush()

    return texts.mapInArrow(run, BLOCKS)


def all_runs(ids: bytes, sizes: bytes, data: bytes, least: int) -> tuple[np.ndarray, ...]:
    """Starts, ends, minimisers and document numbers of a block's runs, and its data, ids and document starts."""
    own, size = np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64)
    raw = np.frombuffer(unpacked(data, size.sum()), np.uint8)
    begin = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)
    parts = [runs_of(raw[a : a + n], least) for a, n in zip(begin, size, strict=True)]
    counts = [len(p[0]) for p in parts]
    shift, doc = np.repeat(begin, counts), np.repeat(np.arange(len(own)), counts)
    return np.concatenate([p[0] for p in parts]) + shift, np.concatenate([p[1] for p in parts]) + shift, np.concatenate([p[2] for p in parts]), doc, raw, own, begin


def shared(blocks: DataFrame, buckets: int, least: int) -> DataFrame:
    """For each block, the minimisers that another document has too: in `often` those that very many blocks have."""
    ask = pa_schema("bucket int, block long, keys binary, many binary")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                _, _, keys, doc, *_ = all_runs(r["ids"], r["sizes"], r["data"], least)
                order = np.lexsort((doc, keys))
                k, d = keys[order], doc[order]
                new = np.append(True, k[1:] != k[:-1])
                at = np.flatnonzero(new)
                many = np.maximum.reduceat(d, at) != np.minimum.reduceat(d, at)
                own = k[at]
                bucket = (own % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for some in range(0, buckets, 64):
                    rows = []
                    for b in range(some, min(buckets, some + 64)):
                        o = order[edges[b] : edges[b + 1]]
                        if len(o):
                            rows.append((b, r["block"], own[o].tobytes(), many[o].tobytes()))
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), ask, strict=True)], schema=ask)

    def answer(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(group["keys"]), np.uint64)
        many = np.frombuffer(b"".join(group["many"]), bool)
        _, where, count = np.unique(keys, return_inverse=True, return_counts=True)
        fine = (count[where] > 1) | many
        often = count[where] > SPREAD
        sizes = np.cumsum([0, *[len(x) for x in group["many"]]])
        rows = []
        for block, a, b in zip(group["block"], sizes, sizes[1:], strict=False):
            f, o = fine[a:b], often[a:b]
            if f.any():
                rows.append((block, keys[a:b][f & ~o].tobytes(), keys[a:b][f & o].tobytes()))
        return pd.DataFrame(rows, columns=["block", "keys", "often"])

    return (
        blocks.mapInArrow(send, "bucket int, block long, keys binary, many binary")
        .groupBy("bucket").applyInPandas(answer, "block long, keys binary, often binary")
    )


def member(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(x), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)] == x


class Stretches:
    """A block's stretches that may repeat, distinct ones numbered by bucket, the same way whenever it is made."""

    def __init__(self, r, keys: np.ndarray, often: np.ndarray, buckets: int, least: int):
        starts, ends, minimisers, doc, self.raw, self.ids, self.begin = all_runs(r.ids, r.sizes, r.data, least)
        some, spread = member(np.sort(keys), minimisers), member(np.sort(often), minimisers)
        bucket = (minimisers % np.uint64(buckets)).astype(np.int64)
        if spread.any():  # one string each, dealt by its own hash
            a, n, d = starts[spread], (ends - starts)[spread], doc[spread]
            single = np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            own = np.array([int.from_bytes(hashlib.blake2b(self.raw[p : p + least].tobytes(), digest_size=6).digest()) for p in single.tolist()], np.int64)
            starts = np.concatenate((starts[some], single))
            ends = np.concatenate((ends[some], single + 1))
            doc = np.concatenate((doc[some], np.repeat(d, n)))
            bucket = np.concatenate((bucket[some], own % buckets))
        else:
            starts, ends, doc, bucket = starts[some], ends[some], doc[some], bucket[some]
        self.starts, self.strings, self.doc, self.bucket = starts, ends - starts, doc, bucket
        data = self.raw.tobytes()
        self.number = np.empty(len(starts), np.int64)  # of the distinct stretch, within its bucket
        self.own: list[dict[bytes, int]] = [{} for _ in range(buckets)]
        self.least_id: list[list[int]] = [[] for _ in range(buckets)]
        owner = self.ids[doc].tolist()
        for k, (a, b, to, who) in enumerate(zip(starts.tolist(), (ends + least - 1).tolist(), bucket.tolist(), owner, strict=True)):
            known, ids = self.own[to], self.least_id[to]
            at = known.setdefault(data[a:b], len(ids))
            if at == len(ids):
                ids.append(who)
            elif who < ids[at]:
                ids[at] = who
            self.number[k] = at


def frames(parts: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(parts["keys"]), np.uint64), np.frombuffer(b"".join(parts["often"]), np.uint64)


def sorted_out(blocks: DataFrame, told: DataFrame, buckets: int, least: int) -> DataFrame:
    """For each block and bucket, the smallest document of each string of the block's distinct stretches."""

    def send(key: tuple, own: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for r in own.itertuples():
            s = Stretches(r, *frames(parts), buckets, least) if len(parts) else None
            for b in range(buckets if s else 0):
                if s.own[b]:
                    texts = list(s.own[b])
                    rows.append((b, r.block, packed(b"".join(texts)), np.array([len(x) for x in texts], np.uint8).tobytes(), np.array(s.least_id[b], np.int64).tobytes()))
        return pd.DataFrame(rows, columns=["bucket", "block", "data", "sizes", "owners"])

    def answer(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        known: dict[bytes, int] = {}
        number, of_row = [], []
        for data, sizes in zip(group["data"], group["sizes"], strict=True):
            data, at = unpacked(data, sum(sizes)), 0
            for n in sizes:
                number.append(known.setdefault(data[at : at + n], len(known)))
                at += n
            of_row.append(len(sizes))
        where = np.array(number)
        owner = np.full(len(known), LAST)
        np.minimum.at(owner, where, np.frombuffer(b"".join(group["owners"]), np.int64))
        first, offset, strings = judged(list(known), owner, least)
        rows, done = [], 0
        for block, n in zip(group["block"], of_row, strict=True):
            own = where[done : done + n]
            done += n
            k = strings[own]
            f = first[np.repeat(offset[own], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)]
            at = np.flatnonzero(np.append(True, f[1:] != f[:-1]))  # runs of one owner
            rows.append((block, int(key[0]), f[at].tobytes(), np.diff(np.append(at, len(f))).astype(np.uint32).tobytes()))
        return pd.DataFrame(rows, columns=["block", "bucket", "owner", "times"])

    asked = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(send, "bucket int, block long, data binary, sizes binary, owners binary")
    return asked.groupBy("bucket").applyInPandas(answer, "block long, bucket int, owner binary, times binary")


def deduplicated(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row.

    A byte goes if a string of `least` bytes over it also starts in a document with a smaller id. Null and empty texts
    have no bytes; a null id is larger than any other; rows with one id never remove from each other. Texts are shuffled
    three times (to find those that take part, and twice to meet the answers) and never joined with each other.
    """
    spark = docs.sparkSession
    docs = pick(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(LAST)).alias("id"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    raw = F.col("text").cast("binary")
    rows = stored(docs.select("id", "doc_id", F.octet_length("text").cast("long").alias("n"), F.sha2(raw, 256).alias("sha")), "rows")
    first = stored(rows.groupBy("sha").agg(F.min("id").alias("first"), F.max("n").alias("n")), "first")
    long = first.where(F.col("n") >= least).select(F.col("first").alias("id"), F.col("sha"))
    texts = docs.select("id", "text").join(long, "id").where(F.sha2(raw, 256) == F.col("sha")).select("id", "text")
    blocks = stored(blocked(texts), "blocks")
    released(spark)
    size = first.where(F.col("n") >= least).agg(F.sum("n").alias("n")).first().n or 0
    buckets = max(16, size // 16_000_000)
    told = stored(shared(blocks, buckets, least), "told")
    released(spark)
    stretch_buckets = max(16, size // 8_000_000)
    answers = stored(sorted_out(blocks, told, stretch_buckets, least), "answers")
    released(spark)
    given = told.selectExpr("block", "-1 bucket", "keys", "often", "cast(null as binary) owner", "cast(null as binary) times").unionByName(
        answers.selectExpr("block", "bucket", "cast(null as binary) keys", "cast(null as binary) often", "owner", "times")
    )

    def finish(key: tuple, own: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        out = []
        asked, got = parts[parts["bucket"] < 0], parts[parts["bucket"] >= 0]
        for r in own.itertuples():
            sizes, ids = np.frombuffer(r.sizes, np.int64), np.frombuffer(r.ids, np.int64)
            data = np.frombuffer(unpacked(r.data, sizes.sum()), np.uint8)
            begin = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
            cover = np.zeros(len(data) + 1, np.int32)
            if len(got):
                s = Stretches(r, *frames(asked), stretch_buckets, least)
                for b, owner, times in zip(got["bucket"], got["owner"], got["times"], strict=True):
                    per = np.repeat(np.frombuffer(owner, np.int64), np.frombuffer(times, np.uint32))
                    length = np.array([len(x) - least + 1 for x in s.own[b]], np.int64)
                    offset = np.concatenate(([0], np.cumsum(length)[:-1]))
                    mine = np.flatnonzero(s.bucket == b)
                    n = s.strings[mine]
                    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    where = np.repeat(s.starts[mine], n) + inner
                    gone = per[np.repeat(offset[s.number[mine]], n) + inner] < np.repeat(s.ids[s.doc[mine]], n)
                    np.add.at(cover, where[gone], 1)
                    np.add.at(cover, where[gone] + least, -1)
            gone = np.cumsum(cover[:-1]) > 0
            for i, a, n in zip(ids.tolist(), begin.tolist(), sizes.tolist(), strict=True):
                g = gone[a : a + n]
                rest = data[a : a + n][~g].tobytes()
                spans = int(np.count_nonzero(np.diff(g.view(np.int8), prepend=0) == 1))
                out.append((i, hashlib.sha256(data[a : a + n].tobytes()).hexdigest(), int(g.sum()), spans, hashlib.sha256(rest).hexdigest()))
        return pd.DataFrame(out, columns=["rep", "own", "n_removed", "n_spans", "kept_sha256"])

    done = blocks.groupBy("block").cogroup(given.groupBy("block")).applyInPandas(finish, "rep long, own string, n_removed long, n_spans long, kept_sha256 string")
    done = done.dropDuplicates(["rep", "own"])  # rows that repeat an id and its text have one answer
    copy = (F.col("n") >= least) & (F.col("id") != F.col("first"))
    empty = hashlib.sha256(b"").hexdigest()
    return (
        rows.join(first.drop("n"), "sha").join(done, (F.col("own") == F.col("sha")) & (F.col("rep") == F.col("id")), "left").select(
            "doc_id", F.col("n").alias("n_bytes"),
            F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(copy, empty).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        )
    )
