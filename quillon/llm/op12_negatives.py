"""Hard negatives by ball trees: branch and bound over inner products, from above and from below.

Rows are dealt to blocks by a hash of their id, and each block's tree (balls with a centre and a radius) is a row of a
stored table. Anchors are packed in chunks; every chunk meets every block, one task for each pair. A ball with centre c
and radius r holds inner products with q between qc - |q|r and qc + |q|r: it is left out if that lies outside the score
window, strictly beneath what the anchor has as its k-th best already, or if its labels cannot match. Each block gives
its first k, and a window function that limits groups before the shuffle merges them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pa_schema, stored, tidy

SCALE = 256.0
ROWS = 4096  # of a block, about
ANCHORS = 4096  # of a chunk, about
LEAF = 64
LIMIT = float(1 << 26)  # components are held at this size, so that scores of up to 2,048 dimensions fit 63 bits
LEAST = -(1 << 62)
LAST = (1 << 63) - 1

TREE = "block long, ids binary, labels binary, numbers binary, width int, nodes binary, balls binary"
PACK = "chunk long, rows binary, labels binary, ids binary, numbers binary, lo binary, hi binary"
FOUND = "anchor_row long, place int, score long, id long"


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """id, label and whole numbers of the rows that take part: nothing null in them, all components finite."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), v.cast("double") * scale))).cast("int"))
    return rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("v")
    ).where("id is not null and label is not null")


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of whole numbers as rows; shorter ones end in zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int32)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class Tree:
    """Balls over the rows of a block; a ball's rows are one slice. nodes: first row, end, left and right ball (-1: none),
    smallest and largest label; balls: centre, radius."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, whole: np.ndarray, nodes: np.ndarray, balls: np.ndarray):
        self.ids, self.labels, self.whole, self.nodes, self.balls = ids, labels, whole, nodes, balls
        self.x = whole.astype(np.float64)
        self.centres, self.radii = balls[:, :-1], balls[:, -1]
        self.low, self.high = nodes[:, 4], nodes[:, 5]
        self.leaves = np.flatnonzero(nodes[:, 2] < 0)
        self.most = float(np.abs(self.x).max(initial=0.0))
        self.looked = 0  # inner products with rows so far

    @classmethod
    def grown(cls, ids: np.ndarray, labels: np.ndarray, whole: np.ndarray) -> Tree:
        """Split between labels first, then in halves by the widest dimension: ties and equal rows split as well."""
        x = whole.astype(np.float64)
        order = np.lexsort((ids, labels))
        nodes: list[list[int]] = []
        balls = []
        waiting = [(0, len(ids), -1, 0)]
        while waiting:
            lo, hi, parent, side = waiting.pop()
            own = order[lo:hi]
            points, marks = x[own], labels[own]
            centre = points.mean(axis=0)
            radius = np.sqrt(((points - centre) ** 2).sum(axis=1).max(initial=0.0))
            if parent >= 0:
                nodes[parent][2 + side] = len(nodes)
            if hi - lo > LEAF:
                if marks[0] != marks[-1]:  # between two labels, next to the middle
                    edges = np.flatnonzero(marks[1:] != marks[:-1]) + 1
                    cut = lo + int(edges[np.abs(edges - (hi - lo) // 2).argmin()])
                else:
                    cut = (lo + hi) // 2
                    if x.shape[1]:
                        order[lo:hi] = own[np.argsort(points[:, points.var(axis=0).argmax()], kind="stable")]
                waiting += [(lo, cut, len(nodes), 0), (cut, hi, len(nodes), 1)]
            nodes.append([lo, hi, -1, -1, marks[0], marks[-1]])
            balls.append(np.append(centre, radius))
        return cls(ids[order], labels[order], whole[order], np.array(nodes, np.int64), np.array(balls))

    @classmethod
    def read(cls, row: dict) -> Tree:
        ids = np.frombuffer(row["ids"], np.int64)
        nodes = np.frombuffer(row["nodes"], np.int64).reshape(-1, 6)
        whole = np.frombuffer(row["numbers"], np.int32).reshape(len(ids), row["width"])
        return cls(ids, np.frombuffer(row["labels"], np.int64), whole, nodes, np.frombuffer(row["balls"]).reshape(len(nodes), -1))

    def search(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor and window (lo to hi, both included) the first k of the block's rows with the anchor's label
        (same) or another one: scores and ids, higher scores first, ties by id; LEAST where there are fewer."""
        count, windows = lo.shape
        best, who = np.full((count, windows, k), LEAST, np.int64), np.full((count, windows, k), LAST, np.int64)
        point = q.astype(np.float64)
        middle = point @ self.centres.T
        reach = np.sqrt((point**2).sum(axis=1))[:, None] * self.radii
        slack = 1e-9 * (np.abs(middle) + reach) + 1e-6  # rounding must not leave out a tie
        up, down = middle + reach + slack, middle - reach - slack
        fits = (labels[:, None] >= self.low) & (labels[:, None] <= self.high) if same else ~((labels[:, None] == self.low) & (labels[:, None] == self.high))
        exact = float(np.abs(point).max(initial=0.0)) * self.most * max(q.shape[1], 1) < 2.0**53
        done = np.zeros((count, len(self.nodes)), bool)

        def look(node: int, at: np.ndarray) -> None:
            at = at[~done[at, node]]
            if not len(at):
                return
            done[at, node] = True
            first, end = self.nodes[node, :2]
            self.looked += len(at) * int(end - first)
            s = (point[at] @ self.x[first:end].T).astype(np.int64) if exact else q[at].astype(np.int64) @ self.whole[first:end].astype(np.int64).T
            alike = labels[at][:, None] == self.labels[first:end]
            ok = (alike if same else ~alike) & (ids[at][:, None] != self.ids[first:end])
            for w in range(windows):
                good = ok & (s <= hi[at, w][:, None]) & (s >= np.maximum(lo[at, w], best[at, w, k - 1])[:, None])
                rows = np.flatnonzero(good.any(axis=1))
                if not len(rows):
                    continue
                scores = np.concatenate((best[at[rows], w], np.where(good[rows], s[rows], LEAST)), axis=1)
                names = np.concatenate((who[at[rows], w], np.where(good[rows], self.ids[first:end], LAST)), axis=1)
                order = np.lexsort((names, -scores), axis=1)[:, :k]
                best[at[rows], w] = np.take_along_axis(scores, order, 1)
                who[at[rows], w] = np.take_along_axis(names, order, 1)

        # the leaf that promises most comes first, so that the k-th best is known early
        promise = np.where(fits[:, self.leaves], np.minimum(up[:, self.leaves], hi.max(axis=1, initial=LEAST)[:, None].astype(float)), -np.inf)
        chosen = self.leaves[promise.argmax(axis=1)] if count else np.empty(0, np.int64)
        for leaf in np.unique(chosen):
            look(int(leaf), np.flatnonzero((chosen == leaf) & fits[:, leaf]))
        waiting = [(0, np.arange(count))]
        while waiting:
            node, at = waiting.pop()
            need = np.maximum(lo[at], best[at, :, k - 1])
            open_ = (up[at, node][:, None] >= need) & (down[at, node][:, None] <= hi[at])
            at = at[fits[at, node] & open_.any(axis=1)]
            if not len(at):
                continue
            left, right = self.nodes[node, 2:4]
            if left < 0:
                look(node, at)
            else:  # the better half of the two is looked at first
                a, b = (left, right) if up[at, left].sum() < up[at, right].sum() else (right, left)
                waiting += [(a, at), (b, at)]
        return best, who


def blocks_of(rows: DataFrame, blocks: int, width: int) -> DataFrame:
    """One row a block: the tree of its distinct rows, as bytes. Equal rows have one id, so they meet in one block."""
    schema = pa_schema(TREE)

    def build(key: tuple, own: pa.Table) -> pa.Table:
        ids, labels = own["id"].to_numpy(), own["label"].to_numpy()
        x = matrix(own["v"], width)
        whole = np.concatenate((ids[:, None], labels[:, None], x.astype(np.int64)), axis=1)
        at = np.unique(whole, axis=0, return_index=True)[1]
        tree = Tree.grown(ids[at].astype(np.int64), labels[at].astype(np.int64), x[at])
        values = (key[0].as_py(), tree.ids.tobytes(), tree.labels.tobytes(), tree.whole.tobytes(), width, tree.nodes.tobytes(), tree.balls.tobytes())
        return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(values, schema.types, strict=True)], schema=schema)

    return rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).groupBy("block").applyInArrow(build, TREE)


def packed(anchors: DataFrame, width: int, windows: int) -> DataFrame:
    """One row a chunk of anchors (chunk, anchor_row, id, label, v, lo and hi: a window or more)."""
    schema = pa_schema(PACK)

    def pack(key: tuple, own: pa.Table) -> pa.Table:
        numbers = [own[c].to_numpy().astype(np.int64).tobytes() for c in ("anchor_row", "label", "id")]
        ends = [np.array(own[c].to_pylist(), np.int64).reshape(-1, windows).tobytes() for c in ("lo", "hi")]
        values = (key[0].as_py(), *numbers, np.ascontiguousarray(matrix(own["v"], width)).tobytes(), *ends)
        return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(values, schema.types, strict=True)], schema=schema)

    return anchors.groupBy("chunk").applyInArrow(pack, PACK)


def met(trees: DataFrame, packs: DataFrame, blocks: int, chunks: int, windows: int, k: int, same: bool) -> DataFrame:
    """What each anchor finds in each block: anchor_row, place (of the window), score and id, k at most."""
    schema = pa_schema(FOUND)

    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        out: list[pa.Table] = [schema.empty_table()]
        for t in one.to_pylist():
            tree = Tree.read(t)
            for p in other.to_pylist():
                rows = np.frombuffer(p["rows"], np.int64)
                q = np.frombuffer(p["numbers"], np.int32).reshape(len(rows), t["width"])
                lo, hi = (np.frombuffer(p[c], np.int64).reshape(len(rows), windows) for c in ("lo", "hi"))
                best, who = tree.search(np.frombuffer(p["ids"], np.int64), np.frombuffer(p["labels"], np.int64), q, lo, hi, k, same)
                at, place, rank = np.nonzero(best > LEAST)
                columns = (rows[at], place, best[at, place, rank], who[at, place, rank])
                out.append(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))
        tidy()
        return pa.concat_tables(out)

    left = trees.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).withColumn("chunk", F.col("chunk").cast("long"))
    right = packs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("block", F.col("block").cast("long"))
    return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(run, FOUND)


def first(found: DataFrame, k: int) -> DataFrame:
    """Of each anchor and window the first k of all blocks, with rank from 1."""
    rank = F.row_number().over(Window.partitionBy("anchor_row", "place").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mined(
    rows: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: float = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | Column = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by `every`; their positives the first `positives` other rows of their label
    by integer inner product (floor of `scale` times each component); for each, the first `negatives` rows of other
    labels that score from `low` to `high` per cent of the positive. Higher scores come first, ties by smaller id.

    Rows with a null id, label, vector or component, or one that is not finite, take no part. Rows equal in id, label and
    numbers are one row; rows that share an id only are rows of their own but never each other's positive or negative.
    Shorter vectors end in zeros; components are held at 2 ** 26. Anchors without a positive, and positives without a
    negative in the window (such as those with a negative score), give no row. An empty table gives an empty table.
    """
    own = stored(usable(rows, id_col, vector_col, label_col, scale), "rows")
    size = own.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.count_if(F.col("id") % every == 0).alias("anchors")).first()
    blocks, chunks, width = -(-size.n // ROWS) or 1, -(-size.anchors // ANCHORS) or 1, size.width or 0
    trees = stored(blocks_of(own, blocks, width), "trees")
    anchors = own.where(F.col("id") % every == 0).dropDuplicates(["id", "label", "v"])
    chunk = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks))
    anchors = stored(anchors.select(F.monotonically_increasing_id().alias("anchor_row"), chunk.alias("chunk"), "id", "label", "v"), "anchors")
    every_score = anchors.withColumns({"lo": F.array(F.lit(LEAST + 1)), "hi": F.array(F.lit(LAST))})
    near = stored(first(met(trees, packed(every_score, width, 1), blocks, chunks, 1, positives, True), positives), "positives")
    window = F.struct("rank", F.expr(ends(low, True)).alias("lo"), F.expr(ends(high, False)).alias("hi"))
    windows = near.groupBy("anchor_row").agg(F.array_sort(F.collect_list(window)).alias("w"))  # `positives` at most
    fill = F.array_repeat(F.struct(F.lit(0).alias("rank"), F.lit(LAST).alias("lo"), F.lit(LEAST).alias("hi")), positives)
    w = F.slice(F.concat("w", fill), 1, positives)
    asked = anchors.join(windows, "anchor_row").withColumns({"lo": w["lo"], "hi": w["hi"]}).drop("w")
    far = first(met(trees, packed(asked, width, positives), blocks, chunks, positives, negatives, False), negatives)
    pairs = near.select("anchor_row", (F.col("rank") - 1).cast("int").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = far.join(pairs, ["anchor_row", "place"]).join(anchors.select("anchor_row", F.col("id").alias("anchor_id")), "anchor_row")
    out = out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    return out


def ends(share: int, up: bool) -> str:
    """score * share / 100 as a whole number, rounded up or down."""
    x = f"(score * {share}L)"
    return f"({x} + pmod(-{x}, 100L)) div 100L" if up else f"({x} - pmod({x}, 100L)) div 100L"
