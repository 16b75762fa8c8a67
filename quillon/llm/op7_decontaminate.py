"""Benchmark decontamination with a generalised suffix automaton of normalised test items.

The automaton's alphabet is the items' words. Documents are streamed through it; at each word it knows the longest
stretch of words, ending there, that some item holds. Where that reaches a window's length, the window is in the
document. Stretches of the document whose word pairs no item holds cannot reach a state of two words, so only the runs
between them are streamed: that is found by array look-ups for a whole text at once.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_for, mapped, pick, stored

#: ASCII letters lowered; other ASCII characters but digits become blanks; all bytes of longer characters stay.
NORMAL = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
WINDOW = 13
#: Words of the items that one automaton holds (about half a kilobyte each), and those that a pass over the documents
#: holds in all its automata. More items are dealt to more passes, so no task and no broadcast ever holds more.
BLOCK_WORDS = 200_000
PASS_WORDS = 400_000


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


class Automaton:
    """Generalised suffix automaton of items (id, words) with the items of each window at the window's state."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        coded = []
        for item, ws in items:
            if ws:
                code = [self.ids.setdefault(w, len(self.ids) + 1) for w in ws]
                coded.append((item, code))
                self._add(code)
        # windows end at states; a window that is an item of fewer words is found at an ancestor of longer matches
        self.windows: dict[tuple[int, int], set[int]] = {}
        for item, code in coded:
            k = min(window, len(code))
            for end, (state, size) in enumerate(self._walk(code)):
                if end + 1 >= k:
                    self.windows.setdefault((self._at(state, k), k), set()).add(item)
        self.lengths = sorted({k for _, k in self.windows})
        self.least = self.lengths[0] if self.lengths else 0
        pairs = {a << 32 | b for _, code in coded for a, b in zip(code, code[1:], strict=False)}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.found: dict[tuple[int, int], tuple[int, frozenset]] = {}

    def _add(self, code: list[int]) -> None:
        last = 0
        for c in code:
            nxt, link, size = self.next, self.link, self.size
            if (q := nxt[last].get(c)) is not None:
                last = q if size[last] + 1 == size[q] else self._clone(last, c, q)
                continue
            new = len(nxt)
            nxt.append({})
            size.append(size[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                link[new] = q if size[p] + 1 == size[q] else self._clone(p, c, q)
            last = new

    def _clone(self, p: int, c: int, q: int) -> int:
        made = len(self.next)
        self.next.append(dict(self.next[q]))
        self.size.append(self.size[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = made
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = made
            p = self.link[p]
        return made

    def _step(self, state: int, size: int, c: int) -> tuple[int, int]:
        nxt = self.next[state].get(c)
        if nxt is not None:
            return nxt, size + 1
        while state and nxt is None:
            state = self.link[state]
            nxt = self.next[state].get(c)
            size = self.size[state]
        return (0, 0) if nxt is None else (nxt, size + 1)

    def _walk(self, code: list[int]):
        state = size = 0
        for c in code:
            state, size = self._step(state, size, c)
            yield state, size

    def _at(self, state: int, k: int) -> int:
        """The ancestor that holds the last k words of a match."""
        while self.size[self.link[state]] >= k:
            state = self.link[state]
        return state

    def ending(self, state: int, size: int) -> tuple[int, frozenset]:
        """The longest window among the suffixes of a match, and the items of all of them."""
        size = min(size, self.window)
        key = (state, size)
        if key not in self.found:
            if len(self.found) > 1_000_000:
                self.found.clear()
            longest, items = 0, set()
            for k in self.lengths:
                if k <= size and (got := self.windows.get((self._at(state, k), k))):
                    longest = k
                    items |= got
            self.found[key] = longest, frozenset(items)
        return self.found[key]

    def hits(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of words (start, end) inside windows, joined, and the items with windows."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        if not self.least or len(ws) < self.least:
            return spans, items
        code = np.fromiter(map(self.ids.get, ws, repeat(0, len(ws))), np.int64, len(ws))
        for lo, hi in self._runs(code):
            state = size = 0
            for at, c in enumerate(code[lo:hi].tolist(), lo + 1):
                state, size = self._step(state, size, c)
                if size >= self.least:
                    k, who = self.ending(state, size)
                    if k:
                        items |= who
                        if spans and at - k <= spans[-1][1]:
                            while len(spans) > 1 and at - k <= spans[-2][1]:
                                spans.pop(-2) if spans[-2][0] >= at - k else spans.pop()
                            spans[-1] = min(spans[-1][0], at - k), at
                        else:
                            spans.append((at - k, at))
        return spans, items

    def _runs(self, code: np.ndarray) -> list[tuple[int, int]]:
        """Runs of at least the shortest window whose word pairs all occur in items."""
        if self.least == 1:
            inside = code > 0
            edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
            return [(int(a), int(b)) for a, b in edges.reshape(-1, 2)]
        both = np.flatnonzero((code[:-1] > 0) & (code[1:] > 0))
        if not len(both) or not len(self.pairs):
            return []
        pair = code[both] << 32 | code[both + 1]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        good = both[self.pairs[at] == pair]
        if not len(good):
            return []
        cut = np.flatnonzero(np.diff(good) != 1)
        lo = good[np.concatenate(([0], cut + 1))]
        hi = good[np.concatenate((cut, [len(good) - 1]))] + 2
        long = hi - lo >= self.least
        return list(zip(lo[long].tolist(), hi[long].tolist(), strict=True))


Block = list[tuple[str, list[bytes]]]


def passes_of(items: DataFrame, item_id: str, item_text: str, block_words: int, pass_words: int) -> Iterator[list[Block]]:
    """Items in blocks of at most block_words words (one item at least), and blocks in passes. Test items are a stated query set; equal
    items, null ids and null texts may occur, and neither an empty item nor one without an id is a query. Ids may be of
    any type; they are told apart as strings."""
    blocks: list[Block] = [[]]
    held = every = 0
    own = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("string").alias("text"))
    for item, text in own.where(F.col("item").isNotNull() & F.col("text").isNotNull()).distinct().toLocalIterator():
        ws = words(text)
        if every + len(ws) > pass_words and every:
            yield blocks
            blocks, held, every = [[]], 0, 0
        if held + len(ws) > block_words and blocks[-1]:
            blocks.append([])
            held = 0
        if ws:
            blocks[-1].append((item, ws))
            held, every = held + len(ws), every + len(ws)
    yield blocks


def matcher(docs: DataFrame, blocks: list[Block], window: int) -> Callable[[], Callable]:
    """setup() for mapped(): a function from words to joined spans and items. A Python worker builds its automata once."""
    held, name = docs.sparkSession.sparkContext.broadcast(blocks), uuid.uuid4().hex

    def setup() -> Callable:
        own = held_for("op7")
        if name not in own:
            own.clear()
            own[name] = [Automaton(block, window) for block in held.value if block]
        machines = own[name]

        def found(ws: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
            every = [m.hits(ws) for m in machines]
            return joined([x for spans, _ in every for x in spans]), {i for _, who in every for i in who}

        return machines[0].hits if len(machines) == 1 else found

    return setup


def searched(docs: DataFrame, items: DataFrame, window: int, sizes: tuple[int, int], item_id: str, item_text: str) -> tuple[Callable[[], Callable], DataFrame]:
    """docs (doc_id, text and others) with __found, the spans and items of all passes but the last, and the last one's setup:
    one pass alone needs no table and no join."""
    last: list[Block] | None = None
    before: list[DataFrame] = []
    for blocks in passes_of(items, item_id, item_text, *sizes):
        if last is not None:
            setup = matcher(docs, last, window)
            own = mapped(docs.select("doc_id", "text", F.xxhash64("text")), noted, NOTED, setup, True)
            before.append(stored(own.where("size(spans) > 0").distinct(), "found"))
        last = blocks
    kind = "array<struct<spans: array<struct<start: int, end: int>>, items: array<string>>>"
    if not before:
        return matcher(docs, last or [], window), docs.withColumn("__found", F.lit(None).cast(kind))
    every = before[0]
    for x in before[1:]:
        every = every.union(x)
    every = every.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("spans", "items")).alias("__found")).withColumnRenamed("doc_id", "__id")
    own = docs.withColumn("__mark", F.xxhash64("text"))
    made = own.join(every, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("mark")), "left")
    return matcher(docs, last or [], window), made.drop("__id", "__mark", "mark")


NOTED = "doc_id long, mark long, spans array<struct<start: int, end: int>>, items array<string>"


def noted(found: Callable, doc_id: int | None, text: str | None, mark: int) -> tuple:
    spans, who = found(words(text))
    return doc_id, mark, [{"start": a, "end": b} for a, b in spans], sorted(who)


def together(found: Callable, ws: list[bytes], before: list | None) -> tuple[list[tuple[int, int]], set[str]]:
    spans, who = found(ws)
    if before is None or not len(before):
        return spans, who
    for x in before:
        spans = spans + [(s["start"], s["end"]) for s in x["spans"]]
        who = who | set(x["items"])
    return joined(spans), who


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    share: float = 0.05,
    block_words: int = BLOCK_WORDS,
    pass_words: int = PASS_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (of words) and items of each row.

    A window is `window` words in a row of an item, or the whole of an item with fewer. A word is hit if it is inside a
    window's occurrence; a document is contaminated if a share of at least `share` of its words is hit. Null and empty
    texts have no words and are clean. Two items with one id count as one. Nothing is shuffled if one automaton holds all
    items; otherwise each further one is a pass whose hits (few rows) are joined with the documents.
    """
    schema = (
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
        "spans array<struct<start: int, end: int>>, items array<string>"
    )
    limit = Fraction(str(share))

    def row(found: Callable, doc_id: int | None, text: str | None, before: list | None) -> tuple:
        ws = words(text)
        spans, who = together(found, ws, before)
        n = sum(b - a for a, b in spans)
        names = sorted(who)
        return (
            doc_id, len(ws), n, len(who), hashlib.sha256(",".join(names).encode("utf-8", "surrogatepass")).hexdigest(),
            n > 0 and limit.denominator * n >= limit.numerator * len(ws), [{"start": a, "end": b} for a, b in spans], names,
        )

    setup, own = searched(pick(docs, id_col, text_col), items, window, (block_words, pass_words), item_id, item_text)
    return mapped(own.select("doc_id", "text", "__found"), row, schema, setup, True)


def removed(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, share: float = 0.05, block_words: int = BLOCK_WORDS,
    pass_words: int = PASS_WORDS,
    id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """docs without their contaminated rows; in the other rows the hit spans are cut out of the text.

    Cut spans run from the first to the last character of the hit words. Rows without a hit keep their text as it is,
    a null text stays null. All columns stay.
    """
    limit = Fraction(str(share))
    named = docs.withColumns({"__text": F.col(text_col).cast("string"), "__id": F.col(id_col).cast("long")})
    own = named.select(F.col("__id").alias("doc_id"), F.col("__text").alias("text"), F.struct(*docs.columns).alias("__row"))
    setup, own = searched(own, items, window, (block_words, pass_words), item_id, item_text)
    kind = own.schema["__row"].dataType.simpleString()

    def row(found: Callable, text: str | None, before: list | None, whole: dict) -> tuple:
        ws = words(text)
        spans = together(found, ws, before)[0]
        n = sum(b - a for a, b in spans)
        if not n:
            return False, text, whole
        gone = limit.denominator * n >= limit.numerator * len(ws)
        return gone, "" if gone else without(text, spans), whole

    made = mapped(own.select("text", "__found", "__row"), row, f"__gone boolean, __cut string, __row {kind}", setup, True).where("not __gone")
    return made.select(*[F.col("__cut").alias(c) if c == text_col else F.col(f"__row.{c}").alias(c) for c in docs.columns])


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters from the first to the last of each span of words."""
    raw = text.encode("utf-8", "surrogatepass")
    plain = np.frombuffer(raw.translate(NORMAL), np.uint8) != 0x20
    edge = np.diff(np.concatenate(([0], plain.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    keep = np.ones(len(raw), bool)
    for a, b in spans:
        keep[starts[a] : ends[b - 1]] = False
    return np.frombuffer(raw, np.uint8)[keep].tobytes().decode("utf-8", "surrogatepass")
