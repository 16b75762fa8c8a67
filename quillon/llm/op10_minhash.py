"""Near duplicates by one-permutation hashing with optimal densification, banded buckets and star-shaped candidates.

Equal shingle sets are one class from the start, named by its smallest id. A class's signature is the smallest hash of
each bin of one permutation; an empty bin takes the value of the bin that its own sequence of probes meets first.
Bands of bins are buckets. In each bucket one class, the one whose buckets are fullest, is the centre, and only it is
compared with the others (on full sets). Two bucket mates that this leaves in different components can only be linked if
their differences from the centre have much in common, which a join on the rarest of these differences tells; such pairs
are then judged on full sets. So no link of bucket mates is lost, and no step makes all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import MULTIPLIER, Hashes, dropped, held_for, lowered, mixed, pa_schema, pick, pieces, stored, tidy

BINS, ROWS = 128, 4  # 32 bands of 4: two sets of similarity 0.8 share no bucket with a probability of 5e-8
SHINGLE, SIMILARITY = 5, 0.8


def shingles(text: str | None, words: int, hashes: Hashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of `words` words; of the whole sequence if there are fewer; none without words."""
    h = hashes.of(lowered(text).split())
    k = min(words, len(h))
    if not k:
        return h
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = (out ^ h[i : i + n]) * MULTIPLIER
        out ^= out >> np.uint64(29)
    return np.unique(mixed(out))


#: For each bin, the order in which an empty one probes the others.
PROBES = (mixed(np.arange(BINS * 512, dtype=np.uint64).reshape(BINS, 512)) % np.uint64(BINS)).astype(np.int64)


def bands(own: np.ndarray) -> np.ndarray:
    """A hash for each band of the densified signature."""
    place = (own >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)  # sorted hashes: the first of a bin is its least
    full, first = np.unique(place, return_index=True)
    signature = np.zeros(BINS, np.uint64)
    signature[full] = own[first]
    if len(full) < BINS:
        filled = np.zeros(BINS, bool)
        filled[full] = True
        empty = np.flatnonzero(~filled)
        met = filled[PROBES[empty]]
        at = met.argmax(1)
        source = np.where(met[np.arange(len(empty)), at], PROBES[empty, at], full[0])
        signature[empty] = mixed(signature[source] + at.astype(np.uint64))
    out = np.arange(BINS // ROWS, dtype=np.uint64)
    for r in range(ROWS):
        out = (out ^ signature[r::ROWS]) * MULTIPLIER
        out ^= out >> np.uint64(31)
    return mixed(out).view(np.int64)


def keys(own: np.ndarray) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(own.tobytes(), len(own))
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


def signed(docs: DataFrame, words: int) -> DataFrame:
    schema = "doc_id long, n int, k1 long, k2 long, bands array<long>"
    out = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_for()
        hashes = Hashes(200_000)
        for batch in batches:
            for lo, hi in pieces(batch):
                ids, texts = (c.slice(lo, hi - lo).to_pylist() for c in batch.columns)
                own = [shingles(t, words, hashes) for t in texts]
                k = [keys(s) for s in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(list(map(len, own)), pa.int32()), pa.array([x[0] for x in k], pa.int64()), pa.array([x[1] for x in k], pa.int64()), pa.array([bands(s) if len(s) else [] for s in own], out.field("bands").type)],
                    schema=out,
                )
        tidy()

    return docs.mapInArrow(run, schema)


def sets_of(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """The full set of each class, from the text of its smallest id."""
    schema = "cls long, k long, own array<long>"
    out = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_for()
        hashes = Hashes(200_000)
        for batch in batches:
            for lo, hi in pieces(batch):
                ids, k, own = [], [], []
                for i, text, k1, k2 in zip(*[c.slice(lo, hi - lo).to_pylist() for c in batch.columns], strict=True):
                    s = shingles(text, words, hashes)
                    if keys(s) == (k1, k2):  # an id may have several rows with different texts
                        ids.append(i)
                        k.append(k1)
                        own.append(s.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(k, pa.int64()), pa.array(own, out.field("own").type)], schema=out)
        tidy()

    return docs.join(classes.select(F.col("cls").alias("doc_id"), "k1", "k2"), "doc_id").select("doc_id", "text", "k1", "k2").mapInArrow(run, schema)


def fraction(similarity: float) -> tuple[int, int]:
    """The similarity as written, exactly: 0.8 is 4 / 5."""
    f = Fraction(str(similarity))
    if not 0 < f <= 1:
        raise ValueError("similarity must be above 0 and at most 1")
    return f.numerator, f.denominator


def alike(d: Column, n: Column, m: Column, similarity: float) -> Column:
    """Whether sets of n and m that differ in d elements are similar enough: similarity s means d <= (1-s)/(1+s) * (n+m)."""
    p, q = fraction(similarity)
    return (q + p) * d <= (q - p) * (n + m)


def differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, each side's key and size, and own: what is in one set of the pair alone. Joins only, so that a partition
    made large by one frequent class can be split."""
    sides = [sets.select(*[F.col(c).alias(f"{c}_{x}") for c in ("k", "own")], F.col("cls").alias(x)) for x in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    own = F.concat(F.array_except("own_a", "own_b"), F.array_except("own_b", "own_a"))
    return both.select("a", "b", "k_a", "k_b", F.size("own_a").alias("n"), F.size("own_b").alias("m"), own.alias("own"))


def components(edges: DataFrame) -> DataFrame:
    """cls and label (the smallest class reachable) of every class with a link: least labels along links, then label of label."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links", True)
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "cls"), "labels", True)
    while True:
        near = both.join(labels.select(F.col("cls").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels.cls == near.a).select("cls", F.col("label").alias("was"), F.least("label", "near").alias("l"))
        up = labels.select(F.col("cls").alias("l"), F.col("label").alias("further"))
        moves = Observation()
        new = hooked.join(up, "l", "left").select("cls", "was", F.least("l", "further").alias("label"))
        new = stored(new.observe(moves, F.count_if(F.col("was") != F.col("label")).alias("n")).select("cls", "label"), "labels", True)
        dropped(labels)
        labels = new
        if not moves.get["n"]:
            return labels


def duplicates(
    docs: DataFrame, words: int = SHINGLE, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable) and kept (doc_id = component_id) of each row.

    Null and empty texts have no shingles and are linked with nothing; rows with a null id are left alone (component
    null, kept). Rows that repeat an id are rows of the same document: each counts with its own text. Texts are read
    twice and shuffled once, to fetch the full sets of classes that share a bucket; everything else is a few numbers a
    row. Tables that outlive a step are in the shared folder.
    """
    docs = pick(docs, id_col, text_col)
    rows = stored(signed(docs, words), "signed")
    some = rows.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = stored(some.groupBy("k1", "k2").agg(F.min("doc_id").alias("cls"), F.first("bands").alias("bands")), "classes", True)
    mates = classes.select("cls", F.explode("bands").alias("key"))  # a key differs by its band
    sizes = mates.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    crowd = stored(mates.join(sizes, "key"), "crowd", True)
    central = crowd.groupBy("cls").agg(F.sum("size").alias("central"))
    sets = stored(sets_of(docs, classes.join(central, "cls", "left_semi"), words), "sets")

    # in each bucket all are compared with its centre
    members = crowd.join(central, "cls").select("key", "cls", "central")
    centre = members.groupBy("key").agg(F.max(F.struct("central", (-F.col("cls")).alias("least"))).alias("c"))
    pairs = members.join(centre, "key").select(F.col("cls").alias("a"), (-F.col("c.least")).alias("b")).where("a <> b").distinct()
    star = stored(differences(pairs, sets), "star", True)
    dropped(crowd)
    labels = components(star.where(alike(F.size("own"), F.col("n"), F.col("m"), similarity)))

    # bucket mates in different components: only those whose differences from the centre have enough in common
    more = Observation()
    rest = stored(differences(stored(candidates(star, labels, similarity), "rest", True), sets), "judged", True)
    links = rest.where(alike(F.size("own"), F.col("n"), F.col("m"), similarity)).select("a", "b")
    up, down = (labels.select(F.col("cls").alias(x), F.col("label").alias(f"of_{x}")) for x in "ab")
    bridges = links.join(up, "a", "left").join(down, "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    bridges = stored(bridges.where("a <> b").observe(more, F.count("*").alias("n")), "bridges", True)
    out = classes.select("k1", "k2", "cls").join(labels, "cls", "left").select("k1", "k2", F.coalesce("label", "cls").alias("component"))
    if more.get["n"]:
        joined = components(bridges).select(F.col("cls").alias("component"), "label")
        out = out.join(joined, "component", "left").select("k1", "k2", F.coalesce("label", "component").alias("component"))
    found = rows.drop("bands").join(out, ["k1", "k2"], "left")
    lone = F.col("doc_id").isNull() | (F.col("n") == 0)
    component = F.when(lone, F.col("doc_id")).otherwise(F.col("component"))
    return found.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def candidates(star: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of one centre's classes in different components that may be linked; no linked pair is missing.

    Let x and y differ from their centre in X and Y. They differ from each other in what is in one of X and Y alone, so
    they are linked if and only if X and Y share t = (|X| + |Y| - (1-s)/(1+s) * (|x| + |y|)) / 2 elements or more, and t
    is above 0 unless both are linked with the centre. Of two sets that share t elements, the first common one in any
    fixed order has t - 1 behind it in both. Elements are ordered by how few of the centre's classes have them, and those
    of one class alone are skipped, so that what a family's members have in common seldom comes up.
    """
    p, q = fraction(similarity)
    name = lambda x: labels.select(F.col("cls").alias(x), F.col("label").alias(f"of_{x}"))
    named = (
        star.join(name("a"), "a", "left").join(name("b"), "b", "left")
        .select("a", "b", "k_a", "k_b", "n", "own", F.coalesce("of_a", "a").alias("label"), F.coalesce("of_b", "b").alias("main"))
    )
    mixed_in = named.groupBy("b").agg(F.min(F.least("label", "main")).alias("lo"), F.max(F.greatest("label", "main")).alias("hi"))
    named = stored(named.join(mixed_in.where("lo < hi").select("b"), "b"), "named", True)
    each = named.select("a", "b", "k_a", "k_b", "n", "label", F.size("own").alias("d"), F.explode("own").alias("e"))
    often = each.groupBy("b", "e").agg(F.count("*").alias("times")).where("times > 1")
    own = each.join(often, ["b", "e"]).groupBy("b", "k_b", "a", "k_a", "n", "d", "label").agg(F.sort_array(F.collect_list(F.struct("times", "e"))).alias("own"))
    at = own.select("b", "k_b", "a", "n", "d", "label", (F.col("d") - F.size("own")).alias("alone"), F.posexplode("own").alias("at", "x"))
    at = at.select("b", "k_b", "a", "n", "d", "label", F.col("x.e").alias("e"), (F.col("alone") + F.col("at")).alias("at")).where(p * F.col("at") <= (q - p) * F.col("n"))
    at = stored(at, "prefixes", True)
    # of an element's classes those in its commonest component meet only those outside it, so a family that is linked
    # already makes no pairs
    on = ["b", "k_b", "e"]
    held = at.groupBy(*on, "label").agg(F.count("*").alias("rows")).groupBy(*on)
    main = held.agg(F.max(F.struct("rows", "label")).alias("m"), F.count("*").alias("labels")).where("labels > 1").select(*on, F.col("m.label").alias("main"))
    few = at.join(main, on).where(F.col("label") != F.col("main"))
    left, right = (d.select(*on, *[F.col(c).alias(f"{c}{x}") for c in ("a", "n", "d", "label", "at")]) for x, d in ((1, few), (2, at)))
    least = (q + p) * (F.col("d1") + F.col("d2")) - (q - p) * (F.col("n1") + F.col("n2"))  # 2 (q+p) t
    fits = (
        (F.col("label1") != F.col("label2"))
        & (q * F.least("n1", "n2") >= p * F.greatest("n1", "n2"))
        & (2 * (q + p) * (F.col("d1") - F.col("at1")) >= least) & (2 * (q + p) * (F.col("d2") - F.col("at2")) >= least)
    )
    same = [left[c] == right[c] for c in on]
    return left.join(right, same[0] & same[1] & same[2] & fits).select(F.least("a1", "a2").alias("a"), F.greatest("a1", "a2").alias("b")).distinct()


def kept(docs: DataFrame, words: int = SHINGLE, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those rows whose document is not the smallest id of its component; all columns stay."""
    gone = duplicates(docs, words, similarity, id_col, text_col).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col(id_col).cast("long") == F.col("__gone"), "left_anti")
