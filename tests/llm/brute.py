"""Plain versions of the contracts, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text: str | None, lower: bool = True) -> list[str]:
    text = text or ""
    return WORD.findall(text.translate(ASCII_LOWER) if lower else text)


def near_duplicates(docs: list[tuple[int, str | None]], k: int = 2) -> dict[int, tuple[int, int]]:
    """id -> (size of the set, smallest id reachable); every pair that can be similar enough is compared."""
    sets = {}
    for i, text in docs:
        w = words(text)
        m = min(k, len(w))
        sets[i] = {tuple(w[j : j + m]) for j in range(len(w) - m + 1)} if m else set()
    often = Counter(s for own in sets.values() for s in own)
    parent = {i: i for i in sets}

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    index = defaultdict(list)
    for i, own in sorted(sets.items(), key=lambda x: len(x[1])):
        prefix = sorted(own, key=lambda s: (often[s], s))[: len(own) - (8 * len(own) + 9) // 10 + 1]
        for j in {j for s in prefix for j in index[s]}:
            both = len(own & sets[j])
            if 100 * both >= 80 * (len(own) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for s in prefix:
            index[s].append(i)
    return {i: (len(own), root(i)) for i, own in sets.items()}


def quality(text: str | None) -> tuple[int, int, int, int, int, bool]:
    text = text or ""
    w = words(text, lower=False)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    found = defaultdict(list)
    for j in range(len(w) - 4):
        found[tuple(w[j : j + 5])].append(j)
    cover = {p + j for at in found.values() if len(at) > 1 for p in at for j in range(5)}
    failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), failed


def split(text: str | None) -> list[str]:
    """ASCII letters and digits, lowered, and longer characters make words."""
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(ASCII_LOWER))


def contamination(docs: list[tuple[int, str | None]], items: list[tuple[str, str | None]], k: int = 13) -> dict[int, tuple[int, int, int, str, bool]]:
    """id -> words, hit words, items, digest of the items, contaminated."""
    of = defaultdict(set)
    for i, text in items:
        w = split(text)
        n = min(k, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            of[tuple(w[a : a + n])].add(i)
    sizes = {len(x) for x in of}
    out = {}
    for i, text in docs:
        w, hit, who = split(text), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if found := of.get(tuple(w[a : a + n])):
                    hit.update(range(a, a + n))
                    who |= found
        digest = hashlib.sha256(",".join(sorted(who)).encode()).hexdigest()
        out[i] = len(w), len(hit), len(who), digest, bool(hit) and 20 * len(hit) >= len(w)
    return out


def repeated_bytes(docs: list[tuple[int, str | None]], k: int = 50) -> dict[int, tuple[int, int, int, str]]:
    """id -> bytes, removed, removed runs, digest of the rest."""
    first: dict[bytes, int] = {}
    raw = {i: (t or "").encode() for i, t in docs}
    for i, b in raw.items():
        for p in range(len(b) - k + 1):
            s = b[p : p + k]
            first[s] = min(first.get(s, i), i)
    out = {}
    for i, b in raw.items():
        gone = bytearray(len(b))
        for p in range(len(b) - k + 1):
            if first[b[p : p + k]] < i:
                gone[p : p + k] = b"\1" * k
        rest = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[i] = len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()
    return out


def repeated_lines(docs: list[tuple[int, str | None]], least: int = 50) -> dict[int, list[int]]:
    """id -> indices of deleted lines: those in any run of `least` words or more that occurs earlier. Every line is held
    against every earlier equal one, and matches are extended from where they begin."""
    lines = {i: [" ".join(words(x, lower=False)) for x in (t or "").split("\n") if WORD.search(x)] for i, t in docs}
    out: dict[int, set[int]] = {i: set() for i in lines}
    at = defaultdict(list)
    for i in sorted(lines):
        own = lines[i]
        for a, x in enumerate(own):
            for j, b in at[x]:
                other = lines[j]
                if a and b and own[a - 1] == other[b - 1]:
                    continue
                n = k = 0
                while a + k < len(own) and b + k < len(other) and own[a + k] == other[b + k]:
                    n += len(own[a + k].split())
                    k += 1
                if n >= least:
                    out[i].update(range(a, a + k))
            at[x].append((i, a))
    return {i: sorted(x) for i, x in out.items()}


class Katz:
    """Backoff with dictionaries: Good-Turing discounts for counts up to 5, half an occurrence where nothing is discounted."""

    def __init__(self, docs: list[tuple[int, str | None]], order: int, most: int = 5):
        self.order, self.most = order, most
        self.one: Counter = Counter()
        self.seen: dict[int, dict[tuple, Counter]] = {n: defaultdict(Counter) for n in range(2, order + 1)}
        for i, text in docs:
            if zlib.crc32(str(i).encode()) % 5 != 1:
                for h, w in self.steps(text):
                    self.one[w] += 1
                    for n in self.seen:
                        self.seen[n][h[order - n :]][w] += 1
        self.d = {1: self.discounts(self.one.values())}
        for n, own in self.seen.items():
            self.d[n] = self.discounts(c for h in own.values() for c in h.values())
        self.total = sum(self.one.values())
        self.unknown = 1 - sum(self.d[1].get(c, 1) * c for c in self.one.values()) / self.total
        self.known: dict[tuple, tuple] = {}

    def steps(self, text: str | None):
        padded = ["<s>"] * (self.order - 1) + [*words(text), "\n"]
        for j in range(self.order - 1, len(padded)):
            yield tuple(padded[j - self.order + 1 : j]), padded[j]

    def discounts(self, counts) -> dict[int, float]:
        n, k, out = Counter(counts), self.most, {}
        common = (k + 1) * n[k + 1] / n[1] if n[1] else 1
        for r in range(1, k + 1):
            x = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common < 1 else 0
            out[r] = x if 0 < x < 1 else (r - 0.5) / r
        return out

    def p(self, h: tuple, w: str | None) -> float:
        if not h:
            return self.d[1].get(self.one[w], 1) * self.one[w] / self.total if self.one[w] else self.unknown
        n = len(h) + 1
        if h not in self.seen[n]:
            return self.p(h[1:], w)
        if h not in self.known:
            own = self.seen[n][h]
            c = sum(own.values())
            given = {x: self.d[n].get(v, 1) * v / c for x, v in own.items()}
            left = 1 - sum(given.values())
            if left < 1e-12:
                given, left = {x: v * c / (c + 0.5) for x, v in given.items()}, 0.5 / (c + 0.5)
            self.known[h] = given, left / (1 - sum(self.p(h[1:], x) for x in own))
        given, weight = self.known[h]
        return given[w] if w in given else weight * self.p(h[1:], w)

    def score(self, text: str | None) -> float:
        return sum(math.log10(self.p(h, w)) for h, w in self.steps(text))
