"""Periodic runs of words: for each period p, the pairs (jp, (j+1)p) of a grid are extended both ways by LCE queries.

A run of period p and length 2p or more holds two neighbouring multiples of p, so the grids of all periods (n log n pairs
for n words) meet every run. Extensions are queries to a suffix array of the words, one of the reversed words, and range
minima over their common prefixes. A grid pair is queried only if words around it agree: the words that a run of 12
words or more repeats are 6 in a row at least, so three in a row agree at the pair or right before it. That drops pairs
that no run can meet, and most texts need no suffix array at all.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MULTIPLIER, mapped, mixed, pick

LEAST = 12  # words of a run
COPIES = 2  # times its period that a run is long, at least
GRAM = 3
BLOCK = 16  # entries of a range minimum block
MOST = 1_000_000  # grid pairs that are extended at once

SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Minima:
    """Range minima: a sparse table over blocks, and running minima inside them."""

    def __init__(self, values: np.ndarray):
        n = -(-len(values) // BLOCK) * BLOCK
        self.values = np.full(n, np.iinfo(np.int32).max, np.int32)
        self.values[: len(values)] = values
        blocks = self.values.reshape(-1, BLOCK)
        self.before = np.minimum.accumulate(blocks, axis=1).ravel()
        self.after = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
        self.table = [blocks.min(axis=1)]
        while 2 << (len(self.table) - 1) <= len(self.table[0]):
            half = 1 << (len(self.table) - 1)
            self.table.append(np.minimum(self.table[-1][:-half], self.table[-1][half:]))

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of values[lo..hi], both ends included."""
        a, b = lo // BLOCK, hi // BLOCK
        out = np.minimum(self.after[lo], self.before[hi])
        inner = b - a - 1
        level = np.frexp(np.maximum(inner, 1).astype(np.float64))[1] - 1
        for k in np.unique(level[inner > 0]):
            at = np.flatnonzero((inner > 0) & (level == k))
            own = self.table[k]
            out[at] = np.minimum(out[at], np.minimum(own[a[at] + 1], own[b[at] - (1 << int(k))]))
        same = np.flatnonzero(a == b)
        if len(same):
            out[same] = self.values[lo[same]]
            for step in range(1, BLOCK):
                same = same[lo[same] + step <= hi[same]]
                out[same] = np.minimum(out[same], self.values[lo[same] + step])
        return out


class Extensions:
    """Longest common extensions of places of one sequence, by its suffix array and range minima."""

    def __init__(self, codes: np.ndarray):
        self.n = n = len(codes)
        rank, levels, k = codes.astype(np.int64), [], 1
        rank = np.unique(rank, return_inverse=True)[1]
        while True:
            levels.append(rank.astype(np.int32))  # equal for places that agree in 2 ** level words
            if rank.max(initial=0) == n - 1:
                break
            key = rank * (n + 1)
            key[: n - k] += rank[k:] + 1
            order = np.argsort(key, kind="stable")
            new = np.empty(n, np.int64)
            new[order] = np.concatenate(([0], np.cumsum(key[order[1:]] != key[order[:-1]])))
            rank, k = new, 2 * k
        self.rank = levels[-1].astype(np.int64)
        suffixes = np.empty(n, np.int64)
        suffixes[self.rank] = np.arange(n)
        x, y = suffixes[:-1].copy(), suffixes[1:].copy()
        common = np.zeros(n, np.int32)
        for level in range(len(levels) - 1, -1, -1):  # words that neighbouring suffixes share, in powers of two
            inside = np.flatnonzero((x < n) & (y < n))
            inside = inside[levels[level][x[inside]] == levels[level][y[inside]]]
            inside = inside[np.maximum(x[inside], y[inside]) + (1 << level) <= n]
            for z in (x, y):
                z[inside] += 1 << level
            common[inside + 1] += 1 << level
        self.minima = Minima(common)

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that follow alike from places i and j (i < j), those included."""
        out = np.zeros(len(i), np.int64)
        at = np.flatnonzero(j < self.n)
        a, b = self.rank[i[at]], self.rank[j[at]]
        out[at] = self.minima.of(np.minimum(a, b) + 1, np.maximum(a, b))
        return out


def grams(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each stretch of `width` words; equal stretches have equal hashes."""
    out = np.zeros(len(codes) - width + 1, np.uint64)
    for k in range(width):
        out = out * MULTIPLIER + mixed(codes[k : k + len(out)] + 1)
    return out


def grid(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid pairs (jp, p) with p up to half the words that a run of `least` words or more may meet."""
    n = len(codes)
    repeated = least // COPIES  # words in a row that a run shares with itself a period later, at least
    whole = np.sort(grams(codes, repeated))
    if not (whole[1:] == whole[:-1]).any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    width = min(GRAM, repeated // 2)
    none = mixed(np.arange(n, 2 * n)) | np.uint64(1)  # for places without a stretch: no two are alike
    at, own = none.copy(), grams(codes, width)
    at[: len(own)] = own
    before = none.copy()
    before[width : width + len(own)] = own[: n - width]
    most, places, periods = n // COPIES, [], []
    by_period = min(most, int(n**0.5))
    for p in range(1, by_period + 1):
        m = (n - 1) // p  # pairs
        a, b = at[::p], before[::p]
        j = np.flatnonzero((a[:m] == a[1 : m + 1]) | (b[:m] == b[1 : m + 1]))
        if len(j):
            places.append(j * p)
            periods.append(np.full(len(j), p))
    first = by_period + 1
    j = 0
    while first <= most and (j + 1) * first < n:  # longer periods: all of them for each j
        last = min(most, (n - 1) // (j + 1))
        x = slice(j * first, j * last + 1, j) if j else np.zeros(last - first + 1, np.int64)
        y = slice((j + 1) * first, (j + 1) * last + 1, j + 1)
        found = np.flatnonzero((at[x] == at[y]) | (before[x] == before[y])) + first
        if len(found):
            places.append(j * found)
            periods.append(found)
        j += 1
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def runs_of(codes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """start, length and smallest period of every run, a row each, by start and period; 4 or more words in a run."""
    n = len(codes)
    none = np.empty((0, 3), np.int64)
    if n < least:
        return none
    place, period = grid(codes, least)
    if not len(place):
        return none
    forward = np.concatenate([e.of(place[k : k + MOST], (place + period)[k : k + MOST]) for e in [Extensions(codes)] for k in range(0, len(place), MOST)])
    # the word before place i is the one at n - i of the reversed words
    x, y = n - place - period, n - place
    backward = np.concatenate([e.of(x[k : k + MOST], y[k : k + MOST]) for e in [Extensions(codes[::-1])] for k in range(0, len(place), MOST)])
    start, end = place - backward, place + period + forward
    keep = np.flatnonzero(end - start >= np.maximum(least, COPIES * period))
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, end, start))  # stretches that several periods meet have the smallest one
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return np.stack((start, end - start, period), axis=1)[order]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(edge)[:-1] == 0)])


def altered(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's test: in a tenth of the documents, by id, the words from some place on repeat a stretch. A null id has
    no decimal, its document stays as it is."""
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (1 + (n - a) // p))[: n - a]


def found(docs: DataFrame, least: int = LEAST, repeat_some: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli; of equal lengths the first, then that of the
    smallest period), all runs by start and period, and the text without what runs repeat (words joined by one space).

    A run is a stretch of `least` words or more and twice its smallest period or more, which no neighbouring word extends.
    Words are told apart by ASCII white space. Null and empty texts have no words, no runs and an empty text; without a
    run the four fields are null. Rows that repeat an id get a row each, a null id is carried through. One map without a
    shuffle: a document is one task's, in memory proportional to its words times the logarithm of its longest repeat.
    """
    if least < 4:
        raise ValueError("a run has 4 words or more")

    def row(_: object, doc_id: int | None, text: str | None) -> tuple:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if repeat_some:
            words = altered(doc_id, words)
        if len(words) < least:
            return doc_id, 0, None, None, None, None, [], b" ".join(words).decode("utf-8", "replace")
        numbers: dict[bytes, int] = {}
        codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
        runs = runs_of(codes, least)
        best = (None, None, None, None)
        if len(runs):
            start, length, period = map(int, runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]])
            best = start, length, period, 1000 * length // period
        listed = [{"start": s, "length": m, "period": q} for s, m, q in runs.tolist()]
        return doc_id, len(runs), *best, listed, collapsed(words, runs).decode("utf-8", "replace")

    return mapped(pick(docs, id_col, text_col), row, SCHEMA)


def digested(runs: DataFrame) -> DataFrame:
    """The listing and the text as SHA-256 digests."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listing = F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n"))))
    return runs.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(listing.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
