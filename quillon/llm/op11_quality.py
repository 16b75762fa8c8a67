"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

One pass over the texts measures each document; everything after it works on that narrow table. Random cosines of the
standardised statistics approximate a Gaussian kernel. Every partition sums its normal equations, the sums meet row by
row of the matrix, and the driver solves a system whose size is a parameter. Each half of the training rows is scored by
the weights of the other half; those scores, counted by fine bins, give the isotonic curve from score to share of good
documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, pa_schema, pick, stored, tidy

COSINES = 256  # random Fourier features
WIDTH = 0.6  # of the kernel, times the square root of the number of statistics
RIDGE = 1e-4  # times the number of training rows
HELD = 4.0  # deviations at which a standardised statistic is held
BINS = 2048  # of scores from LOW to HIGH for the calibration
LOW, HIGH = -0.5, 1.5
STRETCH = 512  # bytes of the stretches whose worst one counts
SYMBOLS, CALLS, STOPS = b"#*$%&|<>@^~_=+\\/{}[]", b"!?", b".,;:"
NAMES = (
    "log_bytes", "log_words", "word_bytes", "word_bytes_spread", "log_longest_word", "upper", "digits", "symbols", "calls", "stops", "high_bytes",
    "lines", "distinct_words", "equal_neighbours", "commonest_word", "equal_lines", "one_byte_words", "entropy", "worst_symbols", "worst_upper",
    "longest_repeat",
)
_SYMBOL, _UPPER = np.zeros(256, np.float32), np.zeros(256, np.float32)
_SYMBOL[list(SYMBOLS + CALLS)] = 1
_UPPER[ord("A") : ord("Z") + 1] = 1


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text leaves 1 when divided by 3; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def statistics(text: str | None) -> list[float]:
    """The numbers of NAMES; those of a text without words are zeros but for its size."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, m = len(raw), len(words)
    if not m:
        return [math.log1p(n)] + [0.0] * (len(NAMES) - 1)
    codes = np.frombuffer(raw, np.uint8)
    count = np.bincount(codes, minlength=256)
    of = lambda marks: int(count[list(marks)].sum())
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    sizes = np.fromiter(map(len, words), np.int64, m)
    often = Counter(words)
    same = np.fromiter(map(eq, words, words[1:]), bool, m - 1)
    breaks = np.flatnonzero(np.concatenate(([True], ~same, [True])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = count[count > 0] / n
    starts = np.arange(0, max(n - STRETCH // 2, 1), STRETCH)  # a short rest belongs to the stretch before it
    length = np.diff(np.append(starts, n))
    return [
        math.log1p(n), math.log1p(m), float(sizes.mean()), float(sizes.std()), math.log1p(int(sizes.max())), upper / max(upper + lower, 1),
        int(count[48:58].sum()) / n, of(SYMBOLS) / m, of(CALLS) / m, of(STOPS) / m, int(count[128:].sum()) / n,
        len(lines) / m, len(often) / m, int(same.sum()) / m, max(often.values()) / m, 1 - len(set(lines)) / len(lines), int((sizes == 1).sum()) / m,
        float(-(share * np.log2(share)).sum()), float((np.add.reduceat(_SYMBOL[codes], starts) / length).max()),
        float((np.add.reduceat(_UPPER[codes], starts) / length).max()), math.log1p(int(np.diff(breaks).max())),
    ]


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out and the statistics of each row."""
    docs = pick(docs, id_col, text_col).withColumn("out", held_out(F.col("doc_id")))

    def row(_: object, doc_id: int | None, text: str | None, out: bool) -> tuple:
        return doc_id, out, statistics(text)

    return mapped(docs, row, "doc_id long, held_out boolean, x array<double>")


class Cosines:
    """Random Fourier features: cosines of random directions and phases, the same for every run."""

    def __init__(self, middle: np.ndarray, spread: np.ndarray, cosines: int = COSINES, width: float = WIDTH, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.middle, self.spread = middle, np.where(spread > 1e-12, spread, 1.0)
        self.directions = rng.normal(0, 1 / (width * math.sqrt(len(middle))), (len(middle), cosines))
        self.phases = rng.uniform(0, 2 * np.pi, cosines)

    def of(self, x: np.ndarray) -> np.ndarray:
        """A row of features for each row of statistics, and a one."""
        z = np.clip((x - self.middle) / self.spread, -HELD, HELD)
        waves = np.cos(z @ self.directions + self.phases) * math.sqrt(2 / len(self.phases))
        return np.concatenate((waves, np.ones((len(x), 1))), axis=1)


def rows_of(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    column = batch.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, len(NAMES)))


def equations(train: DataFrame, cosines: Cosines) -> np.ndarray:
    """The normal equations of each half (half, row, column): features by features, then features by label.

    Partitions send a row of sums for each feature, so the largest group has as many rows as there are partitions, and
    the driver gets a matrix for each half, whatever the number of documents."""
    held = train.sparkSession.sparkContext.broadcast(cosines)
    size = len(cosines.phases) + 1
    out = pa_schema("row int, sums binary")

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size, size + 1))
        for batch in batches:
            x, y, half = rows_of(batch, "x"), batch.column("y").to_numpy(), batch.column("half").to_numpy()
            for k in (0, 1):
                z = held.value.of(x[half == k])
                total[k, :, :size] += z.T @ z
                total[k, :, size] += z.T @ y[half == k]
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([total[:, k].tobytes() for k in range(size)], pa.binary())], schema=out)
        tidy()

    def add(key: tuple, own: pa.Table) -> pa.Table:
        total = np.zeros(2 * (size + 1))
        for x in sorted(own["sums"].to_pylist()):  # in one order, so that a rerun gives the same bits
            total += np.frombuffer(x)
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], schema=out)

    found = train.mapInArrow(part, "row int, sums binary").groupBy("row").applyInArrow(add, "row int, sums binary").collect()
    total = np.zeros((2, size, size + 1))
    for r in found:
        total[:, r["row"]] = np.frombuffer(r["sums"]).reshape(2, -1)
    return total


def solved(sums: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Ridge weights; the one is not held back. Its column counts the rows."""
    size = len(sums)
    own = np.full(size, ridge * max(sums[-1, size - 1], 1.0))
    own[-1] = 1e-9
    return np.linalg.solve(sums[:, :size] + np.diag(own), sums[:, size])


def isotonic(places: np.ndarray, totals: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the curve: places in order, pooled until their means rise; a pool's knot is its mean place."""
    pools: list[list[float]] = []
    for p, t, c in zip(places, totals, counts, strict=True):
        pools.append([p * c, t, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    x, t, c = np.array(pools).T
    return x / c, t / c


class Model:
    def __init__(self, cosines: Cosines, weights: np.ndarray, knots: tuple[np.ndarray, np.ndarray]):
        self.cosines, self.weights, self.knots = cosines, weights, knots

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.cosines.of(x) @ self.weights, *self.knots), 0.0, 1.0)


def trained(measures: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", cosines: int = COSINES) -> Model | None:
    """The model of all labelled rows that are not held out; None without any. Labels other than 0 and 1 are not used, an
    id with several has their mean."""
    label = F.col(label_col).cast("double")
    known = labels.where(label.isin(0.0, 1.0)).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.avg(label).alias("y"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")
    train = stored(measures.where("not held_out").join(known, "doc_id").select("x", "y", half), "train", narrow=True)
    each = [f(F.col("x")[k]).alias(f"{n}{k}") for k in range(len(NAMES)) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    seen = train.agg(F.count("*").alias("n"), *each).first()
    if not seen.n:
        return None
    waves = Cosines(*[np.array([seen[f"{n}{k}"] for k in range(len(NAMES))]) for n in "ms"], cosines)
    sums = equations(train, waves)
    held = train.sparkSession.sparkContext.broadcast((waves, np.stack([solved(sums[1]), solved(sums[0])])))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waves, weights = held.value
            s = (waves.of(rows_of(batch, "x")) * weights[batch.column("half").to_numpy()]).sum(axis=1)
            place = ((np.clip(s, LOW, HIGH) - LOW) / (HIGH - LOW) * (BINS - 1)).round().astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column("y")], names=["bin", "y"])

    rows = train.mapInArrow(binned, "bin int, y double").groupBy("bin").agg(F.sum("y"), F.count("*")).collect()  # BINS at most
    place, total, count = np.array(sorted(rows), float).T
    return Model(waves, solved(sums[0] + sums[1]), isotonic(LOW + place / (BINS - 1) * (HIGH - LOW), total, count))


def scored(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: good likelier) and predicted (1 from 0.5 up) of each row.

    Null and empty texts have no words; their statistics are zeros, and the model scores these as any others. Without
    usable labels every score is 0.5. Rows that repeat an id are scored and trained on one by one; a null id is carried
    through. Texts are read once; the table of their statistics is stored and read for the fit and for the scores.
    """
    measures = stored(measured(docs, id_col, text_col), "measures")
    held = docs.sparkSession.sparkContext.broadcast(trained(measures, labels, label_col))
    schema = "doc_id long, held_out boolean, score double, predicted int"
    out = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = rows_of(batch, "x")
            s = held.value.scores(x) if held.value else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], schema=out)

    return measures.mapInArrow(run, schema)
