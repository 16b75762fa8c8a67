"""Toxicity by subword-bag embeddings averaged into a linear softmax, both trained together in numpy.

A word is the bag of its own hash and those of its character n-grams with word edges, so a misspelling that was never
seen shares most of its vectors with the words that were. A document is the average over its distinct words' subwords.
The model is linear after the average: once trained, every vector is one number (times the difference of the softmax's
columns), so a text's score needs one look-up for each word, however long it is.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_for, lowered, mapped, pick

#: The model is fitted on a bounded sample of the labelled rows: so many, in the order of a hash of their ids, none with
#: a text of more than TRAIN_CHARS characters, and no more rows once TRAIN_TOTAL characters are reached.
TRAIN_DOCS = 8000
TRAIN_CHARS = 200_000
TRAIN_TOTAL = 50_000_000
GRAMS = (3, 4, 5, 6)
BITS = 18  # subwords share 2 to this power vectors, by hash
LEAST = 2  # texts of the sample, counted by word, that a vector needs; a subword of one text alone tells nothing of others
WIDTH = 16
RATE = 0.1
EXAMPLES = 25_000  # that training sees: the sample in several rounds, more of them if it is small
SCALE = np.float32(300)  # of averages before the softmax: a few words among hundreds must be able to decide
MARKS = b".,;:!?\"'()[]{}|#*$%&<>-"
LONGEST = 48  # bytes of a word that subwords are taken from; longer words are cut into pieces of this size


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text leaves 0 when divided by 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def subwords(word: bytes, bits: int = BITS) -> np.ndarray:
    """Places of the vectors of the word with its edges and of its character n-grams."""
    return np.array(sorted(hashed(word, (1 << bits) - 1)), np.int32)


def hashed(word: bytes, mask: int) -> set[int]:
    whole = f"<{word.decode('utf-8', 'replace')}>".encode("utf-32-le")  # four bytes a character
    out = {crc32(whole[i : i + 4 * n]) & mask for n in GRAMS for i in range(0, len(whole) - 4 * n + 1, 4)}
    out.add(crc32(whole) & mask)
    return out


def words(text: str | None) -> set[bytes]:
    """Distinct lowered words without marks at their edges."""
    out = set()
    for w in set(lowered(text).split()):
        w = w.strip(MARKS)
        if len(w) <= LONGEST:
            out.add(w)
        else:
            out.update(w[i : i + LONGEST] for i in range(0, len(w), LONGEST))
    out.discard(b"")
    return out


class Model:
    """Vectors of subwords and a two-column softmax over their average, trained by mini-batches with adaptive steps."""

    def __init__(self, texts: Iterable[str], labels: list[int], width: int = WIDTH, bits: int = BITS, examples: int = EXAMPLES, seed: int = 1):
        number: dict[bytes, int] = {}
        docs = [np.array([number.setdefault(w, len(number)) for w in sorted(words(t))], np.int32) for t in texts]
        often = np.bincount(np.concatenate(docs), minlength=len(number)) if docs else np.zeros(0, np.int64)
        own = [subwords(w, bits) for w in number]
        count = np.zeros(1 << bits, np.int64)
        for k, x in enumerate(own):
            count[x] += often[k]
        self.used = count >= LEAST
        own = [x[self.used[x]] for x in own]
        some = np.array([len(x) > 0 for x in own], bool)
        docs = [d[some[d]] for d in docs]
        rng = np.random.default_rng(seed)
        self.vectors = rng.normal(0, 0.05, (1 << bits, width)).astype(np.float32)
        self.softmax = rng.normal(0, 0.5, (width, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)
        y = np.array(labels, np.int64)
        share = float(y.mean()) if len(y) else 0.0
        if 0 < share < 1:
            self.bias[1] = np.log(share / (1 - share))  # the odds of a text without known subwords; not trained
            self._fit(docs, y, Bags(own), max(1, examples // len(docs)), rng)
        else:  # nothing to tell apart: every text gets the labels' share
            self.vectors[:] = 0
            self.bias[1] = np.log(max(share, 1e-4) / max(1 - share, 1e-4))

    def _fit(self, docs: list[np.ndarray], labels: np.ndarray, bags: Bags, epochs: int, rng, batch: int = 32) -> None:
        seen, seen_softmax = np.full(len(self.vectors), 1e-8, np.float32), np.full(self.softmax.shape, 1e-8, np.float32)
        total, step = epochs * (len(docs) // batch + 1), 0
        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for lo in range(0, len(order), batch):
                rate = RATE * (1 - step / total)
                step += 1
                some = [k for k in order[lo : lo + batch] if len(docs[k])]
                if not some:
                    continue
                # each word of the batch is looked up once, however many of its documents hold it
                sizes = np.array([len(docs[k]) for k in some])
                own, place = np.unique(np.concatenate([docs[k] for k in some]), return_inverse=True)
                ids, starts, n = bags.of(own)
                vectors = np.add.reduceat(self.vectors[ids], starts, axis=0) / n[:, None]
                scale = (SCALE / sizes)[:, None]
                mean = np.add.reduceat(vectors[place], np.cumsum(sizes) - sizes, axis=0) * scale
                z = mean @ self.softmax + self.bias
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(some)), labels[some]] -= 1
                back = (p @ self.softmax.T) * scale
                g = mean.T @ p / len(some)
                seen_softmax += g * g
                self.softmax -= 0.2 * rate * g / np.sqrt(seen_softmax)
                of_words = summed(np.repeat(back, sizes, axis=0), place)[1] / n[:, None]
                at, g = summed(np.repeat(of_words, n, axis=0), ids)
                seen[at] += (g * g).mean(1)
                self.vectors[at] -= rate * g / np.sqrt(seen[at])[:, None]

    def numbers(self) -> tuple[np.ndarray, float]:
        """What each subword's vector adds to the log odds (not a number where it has none), and the constant."""
        d = (self.vectors @ (self.softmax[:, 1] - self.softmax[:, 0])) * SCALE
        return np.where(self.used, d, np.nan).astype(np.float32), float(self.bias[1] - self.bias[0])


class Bags:
    """Subwords of numbered words, end to end."""

    def __init__(self, own: list[np.ndarray]):
        self.size = np.fromiter(map(len, own), np.int64, len(own))
        self.flat = np.concatenate(own) if own else np.zeros(0, np.int32)
        self.begin = np.cumsum(self.size) - self.size

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words' subwords, where each word's begin, and how many they are."""
        n = self.size[which]
        starts = np.cumsum(n) - n
        return self.flat[np.repeat(self.begin[which] - starts, n) + np.arange(n.sum())], starts, n


def summed(rows: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of each one's rows."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    cut = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return k[cut], np.add.reduceat(rows[order], cut, axis=0)


class Scores(dict):
    """word -> mean of its subwords' numbers, remembered for a bounded number of words."""

    def __init__(self, numbers: np.ndarray, most: int = 250_000):
        super().__init__()
        self.numbers, self.most, self.mask = [None if x != x else x for x in numbers.tolist()], most, len(numbers) - 1

    def __missing__(self, word: bytes) -> float:
        own = self.numbers
        known = [x for g in hashed(word, self.mask) if (x := own[g]) is not None]
        if len(self) >= self.most:
            self.clear()
        got = self[word] = sum(known) / len(known) if known else 0.0
        return got


def score_of(scores: Scores, constant: float, text: str | None) -> float:
    ws = words(text)
    z = constant + (sum(map(scores.__getitem__, ws)) / len(ws) if ws else 0.0)
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def trained(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, label_col: str = "toxic") -> Model:
    """The model of a bounded sample: labelled ids outside the held-out fifth, one label each (the highest)."""
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_docs)
    )
    rows = (
        docs.where(F.length("text") <= TRAIN_CHARS)
        .join(F.broadcast(ids), "doc_id")  # train_docs rows at most
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
    )
    own: list[int] = []

    def texts() -> Iterator[str]:
        chars = 0
        for r in rows.toLocalIterator():  # texts become word numbers one by one
            own.append(r.label)
            yield r.text
            chars += len(r.text)
            if chars >= TRAIN_TOTAL:
                return

    return Model(texts(), own)


def scored(
    docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 up) of each row.

    Null and empty texts have no words; the softmax's bias alone scores them, as it scores words without any known
    subword. Without usable labels every score is that of a share of 1 in 10,000. Labels with other values than 0 and 1
    are not used. Only the bounded sample is shuffled; the model that is shipped is a number for each of the 2 ** BITS vectors.
    """
    docs = pick(docs, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, train_docs).numbers())

    def setup() -> tuple[Scores, float]:
        return Scores(held.value[0]), held.value[1]

    def row(state: tuple[Scores, float], doc_id: int | None, text: str | None, out: bool) -> tuple:
        s = score_of(*state, text)
        return doc_id, out, s, int(s >= 0.5)

    return mapped(
        docs.withColumn("out", held_out(F.col("doc_id"))), row, "doc_id long, held_out boolean, score double, predicted int", setup
    )


def kept(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, text_col: str = "text") -> DataFrame:
    """docs without the rows whose text is predicted to be toxic; all columns stay."""
    from pyspark.sql.pandas.functions import pandas_udf

    model = trained(pick(docs, "doc_id", text_col), labels, train_docs).numbers()
    held = docs.sparkSession.sparkContext.broadcast(model)
    state: list = []

    @pandas_udf("double")
    def toxicity(texts: pd.Series) -> pd.Series:
        if not state:
            held_for()
            state.append(Scores(held.value[0]))
        return pd.Series([score_of(state[0], held.value[1], t) for t in texts], dtype="float64")

    return docs.where(toxicity(F.col(text_col).cast("string")) < 0.5)
