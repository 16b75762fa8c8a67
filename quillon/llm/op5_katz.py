"""Katz backoff scores of any order: Good-Turing discounted n-gram counts with exactly normalised backoff weights.

Documents become blocks of numbered words (a table); blocks send their distinct words to buckets, which count them and
answer with numbers and counts. Then each block sends its distinct n-grams, with how often they occur in training, to the
bucket of the word before the last. That one bucket holds every history that ends with this word, of every length, so
p(w | h), its backoff weight and the shorter histories that it backs off to are all at hand, and the recursion needs no
further exchange. The buckets' counts by order are a table in the shared folder (grams). Once its counts of counts are
known, each bucket evaluates its n-grams and answers each block, which adds the logarithms up by document.

A word that ends more histories than a bucket should hold is dealt by the word before it as well, over as many buckets
as its count asks for; its pairs are then counted apart, by pair, and sent to all of these buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hashes, dropped, lowered, mixed, pa_schema, pick, released, stored

ORDER = 3  # words of the longest n-grams
K = 5  # counts up to this one are discounted
BLOCK = 500_000  # tokens of a block
BUCKET = 1_000_000  # tokens of a bucket
MOST = 2_000_000  # occurrences of a history's last word before it is dealt further
SLICES = 4  # of the buckets; they are worked on in turn, so that only a share of the messages is on disk at a time
UNKNOWN, START = 0, 1  # numbers of what is no word of the training documents
END = xxhash.xxh3_64_intdigest(b"\n")  # no word holds a line feed

BLOCKS = (
    "block long, n_docs int, n_keys long, n_all long, keys binary, train binary, docs binary, nulls binary, held binary, "
    "sizes binary, tokens binary"
)


def fold(doc_id: int | None) -> int:
    return crc32(b"" if doc_id is None else str(doc_id).encode()) % 5


def blocked(docs: DataFrame) -> DataFrame:
    out = pa_schema(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, part, made = Hashes(300_000), TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        texts: list[np.ndarray] = []
        held_tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal made, held_tokens, ids, texts
            sizes = np.fromiter(map(len, texts), np.uint32, len(texts))
            keys, local = np.unique(np.concatenate(texts), return_inverse=True)
            out_fold = np.array([fold(i) == 1 for i in ids])
            train = np.bincount(local, np.repeat(~out_fold, sizes), len(keys)).astype(np.uint32)
            numbers = np.array([0 if i is None else i for i in ids], np.int64)
            row = [
                (part << 32) + made, len(ids), len(keys), len(local), keys.tobytes(), train.tobytes(), numbers.tobytes(),
                np.array([i is None for i in ids]).tobytes(), out_fold.tobytes(), sizes.tobytes(), wrapped(local.astype(np.uint32)),
            ]
            made, held_tokens, ids, texts = made + 1, 0, [], []
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, out, strict=True)], schema=out)

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                h = np.append(hashes.of(lowered(text.as_py()).split()), np.uint64(END))
                ids.append(i.as_py())
                texts.append(h)
                held_tokens += len(h)
                if held_tokens >= BLOCK:
                    yield flush()
        if ids:
            yield flush()

    return docs.mapInArrow(run, BLOCKS)


def discounts(n: np.ndarray) -> np.ndarray:
    """d[r] for r up to K from counts of counts n[1..K+1]; 1 beyond. Where they give no ratio between 0 and 1 for an r (too
    few counts, or many copies), half an occurrence is taken."""
    d = np.ones(K + 2)
    r = np.arange(1, K + 1)
    with np.errstate(all="ignore"):
        common = (K + 1) * n[K + 1] / n[1]
        got = ((r + 1) * n[2 : K + 2] / (n[1 : K + 1] * r) - common) / (1 - common)
    plain = (r - 0.5) / r
    ok = np.isfinite(got) & (got > 0) & (got < 1) if n[1] and common < 1 else np.zeros(K, bool)
    d[1 : K + 1] = np.where(ok, got, plain)
    return d


class Unigrams:
    """Discounted probabilities of words by their counts; what is left is the one unknown word's."""

    def __init__(self, total: int, n: np.ndarray):
        self.total, self.d, self.shrink = total, discounts(n), 1.0
        self.unknown = sum(n[r] * r * (1 - self.d[r]) for r in range(1, K + 1)) / total if total else 1.0
        if not self.unknown:  # no word is rare enough to be discounted: the unknown word gets half an occurrence
            self.unknown, self.shrink = 0.5 / (total + 0.5), total / (total + 0.5)

    def p(self, count: np.ndarray) -> np.ndarray:
        if not self.total:
            return np.ones(len(count))
        c = count.astype(np.float64)
        return np.where(count > 0, self.d[np.minimum(count, K + 1).astype(np.int64)] * c * (self.shrink / self.total), self.unknown)


def counted(blocks: DataFrame, buckets: int) -> DataFrame:
    """For each block and bucket of keys: where its keys begin, their numbers and counts; a row of block -1 for each
    bucket has words, tokens and counts of counts."""
    ask = "bucket int, block long, at long, keys binary, train binary"
    tell = "block long, bucket int, at long, numbers binary, counts binary"
    schema = pa_schema(ask)
    cuts = np.array([(1 << 64) // buckets * k for k in range(1, buckets)], np.uint64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, train in zip(*batch.columns, strict=True):
                k, t = np.frombuffer(keys.as_py(), np.uint64), np.frombuffer(train.as_py(), np.uint32)
                edges = [0, *np.searchsorted(k, cuts).tolist(), len(k)]
                rows = [(b, block.as_py(), lo, k[lo:hi].tobytes(), t[lo:hi].tobytes()) for b, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)) if lo < hi]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def answer(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(group["keys"]), np.uint64)
        train = np.frombuffer(b"".join(group["train"]), np.uint32)
        own, where = np.unique(keys, return_inverse=True)
        total = np.bincount(where, train, len(own)).astype(np.int64)
        number = np.where(total > 0, np.cumsum(total > 0), 0)  # from 1 on in the order of the keys
        sizes = np.cumsum([0, *[len(x) // 8 for x in group["keys"]]])
        numbers, counts = number[where].astype(np.uint64), total[where]
        rows = [
            (block, int(key[0]), at, numbers[a:b].tobytes(), counts[a:b].tobytes())
            for block, at, a, b in zip(group["block"], group["at"], sizes, sizes[1:], strict=False)
        ]
        of = [np.count_nonzero(total), total.sum(), *[np.count_nonzero(total == r) for r in range(1, K + 2)]]
        rows.append((-1, int(key[0]), 0, np.array(of, np.int64).tobytes(), b""))
        return pd.DataFrame(rows, columns=["block", "bucket", "at", "numbers", "counts"])

    return blocks.select("block", "keys", "train").mapInArrow(send, ask).groupBy("bucket").applyInPandas(answer, tell)


CODED = "block long, docs binary, nulls binary, held binary, sizes binary, known binary, base binary, numbers binary, counts binary, tokens binary"


def as_table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def coded(blocks: DataFrame, told: DataFrame, total: int, vocabulary: int, before: np.ndarray, ids: type, counts_type: type) -> DataFrame:
    """Blocks with the numbers (after all those of the buckets before) and counts of their words, and each document's known tokens and base score."""
    schema = pa_schema(CODED)

    def put(own: pa.Table, parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("at")
        given = [np.frombuffer(x, np.uint64) for x in parts["numbers"].to_pylist()]
        after = np.repeat(before[parts["bucket"].to_numpy()], list(map(len, given))) + START
        numbers = np.concatenate(given)
        numbers = np.where(numbers > 0, numbers + after.astype(np.uint64), UNKNOWN)
        counts = np.frombuffer(b"".join(parts["counts"].to_pylist()), np.int64)
        rows = []
        for r in own.to_pylist():
            (tokens,), sizes = unwrapped(r["tokens"], np.uint32), np.frombuffer(r["sizes"], np.uint32)
            starts = begins(sizes)
            base = np.log10((counts + 0.5) / (total + 0.5 * (vocabulary + 1)))[tokens]
            known = np.add.reduceat((counts > 0)[tokens].astype(np.int64), starts)
            rows.append((
                r["block"], r["docs"], r["nulls"], r["held"], r["sizes"], known.tobytes(), np.add.reduceat(base, starts).tobytes(),
                wrapped(numbers.astype(ids)), wrapped(counts.astype(counts_type)), r["tokens"],
            ))
        return as_table(rows, schema)

    own = blocks.select("block", "docs", "nulls", "held", "sizes", "tokens")
    return own.groupBy("block").cogroup(told.where("block >= 0").groupBy("block")).applyInArrow(put, CODED)


def begins(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)[:-1]))


def wrapped(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, compressed: numbers that are alike in size share their high bytes."""
    raw = b"".join([np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays if len(a)])
    head = np.array([len(raw), *map(len, arrays)], np.int64).tobytes()
    return head + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unwrapped(data: bytes, *types: type) -> list[np.ndarray]:
    head = np.frombuffer(data, np.int64, len(types) + 1)
    raw = pa.decompress(data[8 * len(head) :], decompressed_size=int(head[0]), codec="zstd", asbytes=True) if head[0] else b""
    out, at = [], 0
    for n, kind in zip(head[1:].tolist(), types, strict=True):
        size = np.dtype(kind).itemsize
        plane = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(plane.T).view(kind).ravel())
        at += n * size
    return out


def runs(x: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)


def lengths(starts: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.append(starts, total)).astype(np.uint32)


class Plan:
    """What decides the bucket of an n-gram; the same for all blocks."""

    def __init__(self, order: int, buckets: int, most: int, slices: int, ids: type, counts_type: type):
        self.order, self.buckets, self.most, self.slices, self.ids, self.counts_type = order, buckets, most, slices, ids, counts_type

    def places(self, last: np.ndarray, often: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Buckets of histories by their last word and its count; a frequent one's also by the word before it."""
        sub = mixed(before.astype(np.uint64) + np.uint64(0x51ED)) % (1 + often.astype(np.uint64) // np.uint64(self.most))
        return (mixed(last.astype(np.uint64) * np.uint64(31) + sub) % np.uint64(self.buckets)).astype(np.int32)


class Words:
    """A block's words by rank: 0 is the unknown word, 1 the start, then come the known words in the order of their numbers."""

    def __init__(self, r: dict, plan: Plan):
        self.sizes = np.frombuffer(r["sizes"], np.uint32).astype(np.int64)
        (numbers,), (counts,) = unwrapped(r["numbers"], plan.ids), unwrapped(r["counts"], plan.counts_type)
        (tokens,) = unwrapped(r["tokens"], np.uint32)
        self.starts, self.train = begins(self.sizes), np.repeat(~np.frombuffer(r["held"], bool), self.sizes)
        ends = counts[tokens[self.sizes[0] - 1]]  # documents in training start as often as they end
        self.ids = np.concatenate((np.array([UNKNOWN, START], plan.ids), numbers))
        self.counts = np.concatenate((np.array([0, 0], plan.counts_type), counts))
        self.often = np.concatenate((np.array([0, ends], plan.counts_type), counts))
        rank = np.where(numbers > 0, np.arange(2, len(numbers) + 2), UNKNOWN)
        self.columns = [rank[tokens]]  # the word, then the words before it from the nearest on
        for _ in range(plan.order - 1):
            h = np.empty_like(self.columns[0])
            h[1:] = self.columns[-1][:-1]
            h[self.starts] = START
            self.columns.append(h)


class Grams:
    """A block's distinct n-grams after known words that go to one slice of the buckets, in the order of these."""

    def __init__(self, r: dict, plan: Plan, part: int):
        self.words = own = Words(r, plan)
        n = len(own.ids)
        last = own.columns[1]
        place = plan.places(own.ids[last], own.often[last], own.ids[own.columns[2 if plan.order > 2 else 0]])
        self.asked = np.flatnonzero((last > 0) & (place % plan.slices == part))
        columns, place = [c[self.asked] for c in own.columns], place[self.asked]
        key = columns[1] * n + columns[0]
        for c in columns[2:]:
            if int(key.max(initial=0)) >= (1 << 62) // n:
                key = np.unique(key, return_inverse=True)[1]
            key = key * n + c
        order = np.argsort(key)
        new = runs(key[order])
        which = np.empty(len(key), np.int64)
        which[order] = np.repeat(np.arange(len(new)), lengths(new, len(key)))
        at = order[new]
        times = np.bincount(which, own.train[self.asked], len(at)).astype(np.uint32)
        place = place[at]
        dealt = np.argsort(place, kind="stable")
        self.buckets, edges = np.unique(place[dealt], return_index=True)
        self.edges = np.append(edges, len(dealt))
        back = np.empty(len(dealt), np.int64)
        back[dealt] = np.arange(len(dealt))
        self.which = back[which]  # of each asked token
        self.columns, self.times = [c[at][dealt] for c in columns], times[dealt]


MESSAGE = "bucket int, block long, data binary"


def sent(table: DataFrame, plan: Plan, part: int) -> DataFrame:
    """For each block and bucket: last words of histories, words after them with their counts, the words before them
    from the second on, and how often each n-gram is in training."""
    schema = pa_schema(MESSAGE)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                g = Grams(r, plan, part)
                own = g.words
                for some in range(0, len(g.buckets), 64):
                    rows = []
                    for b, lo, hi in zip(g.buckets[some : some + 64].tolist(), g.edges[some:].tolist(), g.edges[some + 1 :].tolist(), strict=False):
                        w, v, *more = [c[lo:hi] for c in g.columns]
                        pair = runs(v * len(own.ids) + w)
                        first = runs(v[pair])
                        rows.append((b, r["block"], wrapped(
                            own.ids[v[pair[first]]], (own.often[v[pair[first]]] >= plan.most).view(np.uint8), lengths(first, len(pair)),
                            own.ids[w[pair]], own.counts[w[pair]], lengths(pair, hi - lo), g.times[lo:hi], *[own.ids[c] for c in more],
                        )))
                    yield from as_table(rows, schema).to_batches()

    return table.select("block", "sizes", "held", "numbers", "counts", "tokens").mapInArrow(send, MESSAGE)


def frequent(table: DataFrame, plan: Plan, words: Unigrams) -> tuple[DataFrame, DataFrame]:
    """Counts of the pairs that begin with a word dealt over several buckets, and the sums of each such word: rows
    (bucket, first, second, n, sums) for every bucket that holds some of its histories; and counts of their counts."""
    schema = pa_schema("first long, second long, p double, n long")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                if not (unwrapped(r["counts"], plan.counts_type)[0] >= plan.most).any():
                    continue
                own = Words(r, plan)
                mine = np.flatnonzero((own.often[own.columns[1]] >= plan.most) & own.train)
                key, n = np.unique(own.columns[1][mine] * len(own.ids) + own.columns[0][mine], return_counts=True)
                v, w = np.divmod(key, len(own.ids))
                columns = own.ids[v].astype(np.int64), own.ids[w].astype(np.int64), words.p(own.counts[w]), n
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=schema)

    pairs = table.select("block", "sizes", "held", "numbers", "counts", "tokens").mapInArrow(send, "first long, second long, p double, n long")
    pairs = stored(pairs.groupBy("first", "second").agg(F.first("p").alias("p"), F.sum("n").alias("n")), "pairs", True)
    names = [F.sum("n").cast("double"), *[F.count_if(F.col("n") == r).cast("double") for r in range(1, K + 1)], F.sum("p")]
    sums = pairs.groupBy("first").agg(F.array(*names).alias("sums"))
    every = pairs.select("first", "second", "n", F.lit(None).cast("array<double>").alias("sums")).unionByName(sums.selectExpr("first", "0L second", "cast(sums[0] as long) n", "sums"))
    wide = every.join(sums.selectExpr("first", "cast(sums[0] as long) total"), "first")
    places = "bucket int, first long, second long, n long, sums array<double>"
    out = pa_schema(places)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("total").to_numpy()
            times = 1 + total // plan.most
            at = np.repeat(np.arange(len(times)), times)
            sub = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            first = batch.column("first").to_numpy()[at].astype(np.uint64)
            bucket = (mixed(first * np.uint64(31) + sub.astype(np.uint64)) % np.uint64(plan.buckets)).astype(np.int32)
            rest = [batch.column(c).take(pa.array(at)) for c in ("first", "second", "n", "sums")]
            yield pa.RecordBatch.from_arrays([pa.array(bucket), *rest], schema=out)

    wide = wide.select("first", "second", "n", "sums", "total").mapInArrow(spread, places)
    return stored(wide, "frequent", True), pairs


GRAMS = "bucket int, grams binary, frequent binary, blocks binary, sizes binary, at binary, stats array<long>"


def gathered(messages: DataFrame, wide: DataFrame, plan: Plan) -> DataFrame:
    """One row for each bucket: its distinct n-grams with their counts, the pairs of frequent words that it may need,
    for each block which n-grams it asks for, and counts of counts for each order from two on."""
    schema = pa_schema(GRAMS)
    types = [plan.ids, np.uint8, np.uint32, plan.ids, plan.counts_type, np.uint32, np.uint32, *[plan.ids] * (plan.order - 2)]

    def gather(asked: pa.Table, often: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return as_table([], schema)
        parts = [unwrapped(x.as_py(), *types) for x in asked["data"]]
        sizes = np.array([len(x[6]) for x in parts], np.int64)
        first, flag, n_first, second, count, n_pair, times, *more = [np.concatenate(x) for x in zip(*parts, strict=True)]
        del parts
        first, flag = np.repeat(first, n_first), np.repeat(flag, n_first)
        first, flag, second, count = (np.repeat(x, n_pair) for x in (first, flag, second, count))
        columns = [first, second, *more]
        order = sorting(columns)
        new = np.zeros(len(order), bool)
        new[:1] = True
        for c in columns:
            x = c[order]
            new[1:] |= x[1:] != x[:-1]
        at = np.empty(len(order), np.uint32)
        at[order] = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        total = np.add.reduceat(times[order].astype(np.int64), begin)
        one = order[begin]
        columns = [c[one] for c in columns]
        stats, flag = [], flag[one]
        for k in range(2, plan.order + 1):
            c = total if k == plan.order else np.add.reduceat(total, changes(columns[:k]))
            if k == 2:
                c = c[flag[changes(columns[:2])] == 0]
            stats += [int(np.count_nonzero(c == r)) for r in range(K + 2)]
        f = often["first"].to_numpy(), often["second"].to_numpy(), often["n"].to_numpy()
        sums = np.array([x for x in often["sums"].to_pylist() if x is not None], np.float64).reshape(-1, K + 2)
        is_sum = np.array([x is not None for x in often["sums"].to_pylist()], np.uint8)
        row = (
            asked["bucket"][0].as_py(), wrapped(columns[0], flag, columns[1], count[one], total.astype(np.uint64), *columns[2:]),
            wrapped(*f, is_sum, sums.ravel()), asked["block"].to_numpy().tobytes(), sizes.tobytes(), wrapped(np.diff(at, prepend=np.uint32(0))), stats,
        )
        return as_table([row], schema)

    return messages.groupBy("bucket").cogroup(wide.groupBy("bucket")).applyInArrow(gather, GRAMS)


def sorting(columns: list[np.ndarray]) -> np.ndarray:
    """An order by the columns, the first one first."""
    bits = [int(c.max(initial=0)).bit_length() for c in columns]
    if sum(bits) > 64:
        return np.lexsort(columns[::-1])
    key = np.zeros(len(columns[0]), np.uint64)
    for c, b in zip(columns, bits, strict=True):
        key = (key << np.uint64(b)) | c.astype(np.uint64)
    return np.argsort(key)


def changes(columns: list[np.ndarray]) -> np.ndarray:
    """Starts of runs of rows that are equal in all columns."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def sums_of(count: np.ndarray, lower: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """For each history, from what is seen after it in training: occurrences, words seen r times (r = 1 to K), and the
    probability that the shorter history gives to the words seen."""
    parts = [count, *[count == r for r in range(1, K + 1)], np.where(count > 0, lower, 0.0)]
    return np.stack([np.bincount(group, x, n) for x in parts])


def backoff(sums: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights that make the seen and the unseen words' probabilities after a history add up to 1, and what the seen
    ones are multiplied by: where nothing was discounted, for all was seen often, half an occurrence is set aside."""
    total, mass = sums[0], sums[-1]
    left = sum(sums[r] * r * (1 - d[r]) for r in range(1, K + 1))
    with np.errstate(all="ignore"):
        weight = np.where(left > 0, left / total, 0.5 / (total + 0.5)) / (1 - mass)
        shrink = np.where(left > 0, 1.0, total / (total + 0.5))
    return np.where(total > 0, weight, 1.0), shrink


def evaluated(row: dict, plan: Plan, words: Unigrams, d: list[np.ndarray]) -> np.ndarray:
    """log10 of the probability of each n-gram of a bucket, by recursion over the length of its history."""
    types = [plan.ids, np.uint8, plan.ids, plan.counts_type, np.uint64, *[plan.ids] * (plan.order - 2)]
    first, flag, second, count, total, *more = unwrapped(row["grams"], *types)
    f_first, f_second, f_n, is_sum, f_sums = unwrapped(row["frequent"], np.int64, np.int64, np.int64, np.uint8, np.float64)
    columns, lower = [first, second, *more], words.p(count)
    for k in range(2, plan.order + 1):
        begin = changes(columns[:k])  # distinct n-grams of k words
        c = np.add.reduceat(total.astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64)
        history = [columns[j][begin] for j in range(k) if j != 1]
        if k == 2:
            group = np.cumsum(np.append(True, history[0][1:] != history[0][:-1])) - 1 if len(begin) else begin
            mine = np.flatnonzero(flag[begin] > 0)
            if len(mine):  # pairs of a word that is dealt over several buckets
                pair = is_sum == 0
                known = pd.Series(f_n[pair], pd.MultiIndex.from_arrays([f_first[pair], f_second[pair]]))
                known = known[~known.index.duplicated()]
                asked = pd.MultiIndex.from_arrays([first[begin][mine].astype(np.int64), second[begin][mine].astype(np.int64)])
                c[mine] = known.reindex(asked, fill_value=0).to_numpy()
        else:
            order = sorting(history)
            group = np.empty(len(order), np.int64)
            x = np.zeros(len(order), np.int64)
            x[changes([h[order] for h in history])[1:]] = 1
            group[order] = np.cumsum(x)
        n = int(group.max(initial=-1)) + 1
        sums = sums_of(c, lower[begin], group, n)
        if k == 2 and len(mine):
            given = pd.DataFrame(f_sums.reshape(-1, K + 2), index=f_first[is_sum > 0])
            given = given[~given.index.duplicated()].reindex(first[begin][mine].astype(np.int64), fill_value=0.0)
            sums[:, group[mine]] = given.to_numpy().T
        weight, shrink = backoff(sums, d[k])
        with np.errstate(all="ignore"):
            seen = d[k][np.minimum(c, K + 1)] * c * shrink[group] / sums[0][group]
        p = np.where(c > 0, seen, weight[group] * lower[begin])
        lower = np.repeat(p, lengths(begin, len(first)))
    return np.log10(lower)


def answered(grams: DataFrame, plan: Plan, words: Unigrams, d: list[np.ndarray]) -> DataFrame:
    """For each bucket and block: the logarithms for the n-grams that the block asked for, in its order."""
    out = pa_schema("block long, bucket int, value binary")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                value = evaluated(r, plan, words, d)
                at = np.cumsum(unwrapped(r["at"], np.uint32)[0], dtype=np.uint32)
                edges = np.cumsum([0, *np.frombuffer(r["sizes"], np.int64)])
                rows = [
                    (b, r["bucket"], wrapped(value[at[lo:hi]]))
                    for b, lo, hi in zip(np.frombuffer(r["blocks"], np.int64).tolist(), edges, edges[1:], strict=False)
                ]
                yield from as_table(rows, out).to_batches()

    return grams.select("bucket", "grams", "frequent", "blocks", "sizes", "at").mapInArrow(answer, "block long, bucket int, value binary")


def scored(docs: DataFrame, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row.

    Null and empty texts have the end token alone. Rows with crc32(id as text) mod 5 = 1 are held out of training; a
    null id counts as an empty text. Without training rows every token is unknown with probability 1. Before a document's
    first word stands a start symbol as often as the order asks for; a history with an unknown word was never seen, so it
    backs off with weight 1. Tables in the shared folder carry the work from step to step.
    """
    if order < 2:
        raise ValueError("the order is 2 at least")
    spark = docs.sparkSession
    blocks = stored(blocked(pick(docs, id_col, text_col)), "blocks")
    size = blocks.agg(F.sum("n_keys").alias("keys"), F.sum("n_all").alias("tokens")).first()
    key_buckets = max(16, (size.keys or 0) // 500_000)
    told = stored(counted(blocks, key_buckets), "told")
    of, known = np.zeros(K + 3, np.int64), np.zeros(key_buckets, np.int64)
    for row in told.where("block < 0").select("bucket", "numbers").toLocalIterator():  # a few numbers for each bucket of words
        own = np.frombuffer(row.numbers, np.int64)
        known[row.bucket] = own[0]
        of += own
    vocabulary, total = int(of[0]), int(of[1])
    words = Unigrams(total, np.concatenate(([0], of[2:])).astype(float))
    ids = np.uint32 if vocabulary + 2 < 1 << 32 else np.uint64
    counts_type = np.uint32 if total < 1 << 32 else np.uint64
    table = stored(coded(blocks, told, total, vocabulary, np.cumsum(known) - known, ids, counts_type), "coded")
    dropped(blocks)
    dropped(told)
    released(spark)

    plan = Plan(order, max(16, (size.tokens or 0) // BUCKET), MOST, SLICES, ids, counts_type)
    wide, pairs = frequent(table, plan, words)
    grams = []
    for part in range(plan.slices):
        mine = wide.where(F.col("bucket") % plan.slices == part)
        grams.append(stored(gathered(sent(table, plan, part), mine, plan), "grams"))
        released(spark)
    n = np.zeros((order - 1, K + 2))
    for g in grams:
        for row in g.select("stats").toLocalIterator():  # a few numbers for each bucket
            n += np.array(row.stats, float).reshape(order - 1, K + 2)
    n[0] += np.array(pairs.agg(*[F.count_if(F.col("n") == r) for r in range(K + 2)]).first(), float)
    d = [np.zeros(0), np.zeros(0), *map(discounts, n)]
    sums = []
    for part, g in enumerate(grams):
        sums.append(stored(added(table, answered(g, plan, words, d), plan, part, words), "sums"))
        dropped(g)
        released(spark)
    schema = pa_schema(SCORES)

    def finish(own: pa.Table, given: pa.Table) -> pa.Table:
        frames = []
        for r in own.to_pylist():
            sizes = np.frombuffer(r["sizes"], np.uint32).astype(np.int64)
            score = np.sum([np.frombuffer(x, np.float64) for x in given["score"].to_pylist()], axis=0)
            columns = [
                pa.array(np.frombuffer(r["docs"], np.int64), mask=np.frombuffer(r["nulls"], bool)), pa.array(np.frombuffer(r["held"], bool)),
                pa.array(sizes), pa.array(np.frombuffer(r["known"], np.int64)), pa.array(np.full(len(sizes), total, np.int64)),
                pa.array(np.frombuffer(r["base"], np.float64)), pa.array(score),
            ]
            frames.append(pa.Table.from_arrays(columns, schema=schema))
        return pa.concat_tables(frames) if frames else schema.empty_table()

    every = sums[0]
    for x in sums[1:]:
        every = every.union(x)
    own = table.select("block", "docs", "nulls", "held", "sizes", "known", "base")
    return own.groupBy("block").cogroup(every.groupBy("block")).applyInArrow(finish, SCORES)


def added(table: DataFrame, answers: DataFrame, plan: Plan, part: int, words: Unigrams) -> DataFrame:
    """block, score: the sums by document of the logarithms for the tokens that a slice of the buckets answered; those
    after an unknown word, where there is nothing to back off from, count with the first slice."""
    schema = pa_schema("block long, score binary")

    def add(own: pa.Table, given: pa.Table) -> pa.Table:
        rows = []
        for r in own.to_pylist():
            g = Grams(r, plan, part)
            value = np.zeros(len(g.times))
            for b, x in zip(given["bucket"].to_pylist(), given["value"], strict=True):
                k = int(np.searchsorted(g.buckets, b))
                value[g.edges[k] : g.edges[k + 1]] = unwrapped(x.as_py(), np.float64)[0]
            w = g.words
            each = np.zeros(len(w.columns[0]))
            if part == 0:
                lone = np.flatnonzero(w.columns[1] == UNKNOWN)
                each[lone] = np.log10(words.p(w.counts))[w.columns[0][lone]]
            each[g.asked] = value[g.which]
            rows.append((r["block"], np.add.reduceat(each, w.starts).tobytes()))
        return as_table(rows, schema)

    own = table.select("block", "sizes", "held", "numbers", "counts", "tokens")
    return own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add, "block long, score binary")


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
