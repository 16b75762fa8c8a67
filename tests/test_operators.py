"""Worked cases by hand."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.functions import columns as C
from quillon.operators import bins, contacts, graph, hits, jobs, matrix, models, ordering
from quillon.plans import registry
from quillon.plans.scalar_queries import seqs
from quillon.sources import formats

READS = [
    ("r1", "c1", 60), ("r1", "c2", 60), ("r2", "c1", 40), ("r2", "c1", 40), ("r3", "c2", 10), ("r3", "c3", 60), ("r4", "c1", 60), ("r4", "c2", 60),
    ("r4", "c3", 60), ("r5", "c4", 60), ("r5", "c1", 60), ("r6", "c2", 60),
]


@pytest.fixture(scope="module")
def reads(spark):
    return spark.createDataFrame([(q, i, c, m) for i, (q, c, m) in enumerate(READS)], "qname string, at int, contig string, mapq int")


def pairs_of(rows):
    return sorted(tuple(r) for r in rows.collect())


def test_pairing_and_accounting(spark, reads):
    kept = spark.createDataFrame([("c1",), ("c2",), ("c3",)], "contig string")
    got = {r.status: r.n for r in contacts.accounting(reads, kept, F.col("mapq") >= 30, "at").collect()}
    assert got == {"different_contig": 2, "same_contig": 1, "poor_match": 1, "ref_excluded": 1, "single": 1}
    ok = contacts.pairs(reads.where("contig <> 'c4'"), F.col("mapq") >= 30, "at").where("ok")
    edges = contacts.counts(ok)
    assert pairs_of(edges) == [("c1", "c1", 1), ("c1", "c2", 2)]
    s = {r.contig: (r.signal, r.largest, r.self) for r in contacts.signal(edges, kept).collect()}
    assert s == {"c1": (2, 2, 1), "c2": (2, 2, 0), "c3": (0, 0, 0)}


def test_cigar_end(spark):
    rows = [(0, "10S40M"), (16, "10S40M"), (16, "40M10S"), (0, "29M"), (0, None), (0, "*")]
    df = spark.createDataFrame(rows, "flag int, cigar string")
    got = [r[0] for r in df.select(C.strong_match(F.col("flag"), F.lit(60), F.col("cigar"), 30, 30)).collect()]
    assert got == [False, True, False, False, False, False]


def test_n50(spark):
    df = spark.createDataFrame([("a", 50, 1), ("a", 30, 2), ("a", 20, 3)], "bin string, length long, k int")
    loose, strict = ordering.n50(df, "bin", "length", "k").first(), ordering.n50(df, "bin", "length", "k", strict=True).first()
    assert (loose.n50, loose.l50, strict.n50) == (50, 1, 30)


def test_percentile_cut(spark):
    df = spark.createDataFrame([(0, i, float(i)) for i in range(1, 6)], "i int, j int, v double")
    assert [r.v for r in matrix.above_percentile(df, 25).orderBy("v").collect()] == [3, 4, 5]
    assert [r.v for r in matrix.above_percentile(df, 25, keep_equal=True).orderBy("v").collect()] == [2, 3, 4, 5]
    with pytest.raises(ValueError):
        matrix.above_percentile(df, 100)
    assert matrix.above_percentile(df.where("v > 9"), 25).count() == 0


def test_ratios(spark):
    p = spark.createDataFrame([("a", "b", True)] * 2, "a string, b string, ok boolean")
    r = contacts.quality_ratios(p, F.col("ok"), F.col("a") != F.col("b")).first()
    assert r.informative_ratio == 1.0 and math.isinf(r.three_d_ratio)


def test_overlap_and_choice(spark):
    a = spark.createDataFrame([("a1", "c1", 100), ("a1", "c2", 100)], "bin string, contig string, length long")
    b = spark.createDataFrame([("b1", "c1", 100)], "bin string, contig string, length long")
    ov = bins.overlaps(a, b)
    assert ov.first().ratio == 100
    sa = spark.createDataFrame([("a1", 90.0, 3.0)], "bin string, completeness double, contamination double")
    sb = spark.createDataFrame([("b1", 85.0, 1.0)], "bin string, completeness double, contamination double")
    assert [(r.origin, r.bin) for r in bins.consolidated(sa, sb, ov).collect()] == [("B", "b1")]


def test_dereplicate_and_best_version(spark):
    m = spark.createDataFrame([("c1", "x"), ("c1", "y")], "contig string, bin string")
    s = spark.createDataFrame([("x", 90.0, 2.0, 10), ("y", 80.0, 0.0, 99)], "bin string, completeness double, contamination double, n50 long")
    assert bins.dereplicated(m, s).first().bin == "y"
    assert bins.dereplicated(m, s, remove=True).count() == 0
    v = spark.createDataFrame([("b", "orig", 90.0, 5.0, 1), ("b", "strict", 92.0, 5.0, 10), ("b", "permissive", 92.0, 5.0, 20)], "base string, version string, completeness double, contamination double, n50 long")
    assert bins.best_versions(v).first().version == "permissive"


def test_refinement(spark):
    rows = [("A", "p", "c1"), ("A", "p", "c2"), ("A", "q", "c3"), ("B", "u", "c1"), ("B", "v", "c2"), ("B", "v", "c3")]
    m = spark.createDataFrame([(*r, 100) for r in rows], "bin_set string, bin string, contig string, length long")
    assert sorted((r.A, r.B) for r in bins.intersections(m, ["A", "B"], 100).collect()) == [("p", "u"), ("p", "v"), ("q", "v")]
    assert bins.intersections(m, ["A", "B"], 101).count() == 0


def test_seed_marker(spark):
    hits = [("m1", c, 300) for c in ("c1", "c2", "c3")] + [(m, c, q) for m, q in (("m2", 200), ("m3", 150)) for c in ("c1", "c2")] + [("m4", "c1", 90)]
    got = bins.seed_marker(spark.createDataFrame(hits, "marker string, contig string, qlen int")).first()
    assert (got.marker, got.median) == ("m3", 2)
    assert bins.seed_marker(spark.createDataFrame(hits[-1:], "marker string, contig string, qlen int")).count() == 0


def test_sequences(spark):
    df = spark.createDataFrame([("s1", "GATCAATTGATC"), ("s2", "ACGTn"), ("s3", "A" * 2500), ("s4", "G" * 50 + "A" * 50), ("s5", "")], "name string, seq string")
    sites = [r[0] for r in df.select(C.site_count(F.col("seq"), "DpnII", "MluCI")).collect()]
    assert sites[0] == 3
    assert df.where("name = 's2'").select(C.reverse_complement(F.col("seq"))).first()[0] == "nACGT"
    seg = df.select("name", F.explode(C.segments(F.col("name"), F.col("seq"), 1000)).alias("s")).where("name = 's3'").select("s.*").collect()
    assert [(r.segment, len(r.part)) for r in seg] == [("s3_seg_1", 1000), ("s3_seg_2", 1000), ("s3_seg_3", 500)]
    assert df.where("name = 's4'").select(C.gc_bucket(F.col("seq"))).first()[0] == 24
    assert spark.range(1).select(C.translated(F.lit("ATGGATTAAN"))).first()[0] == "MD*"
    with pytest.raises(ValueError, match="HindIII"):
        C.motif_regex("HindII")


def test_whole_texts_are_translated(spark, tmp_path):
    texts = ["", "ac", "gat", "acgtn" * 200, "tttß\n\U0001f600" * 500, "gattacacat" * 5001, None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    code = {a + b + c: C.AMINO[16 * i + 4 * j + k] for i, a in enumerate("ACGT") for j, b in enumerate("ACGT") for k, c in enumerate("ACGT")}
    seq = {r.doc_id: r.seq or "" for r in seqs(spark, str(tmp_path)).collect()}
    want = {d: "".join(code.get(s[p : p + 3].upper(), "X") for p in range(0, len(s) - 2, 3)) for d, s in seq.items()}
    got = {r.doc_id: r.protein for r in registry.queries()["codon_translation"](spark, str(tmp_path)).collect()}
    assert got == want and max(map(len, got.values())) == 16670


def test_gap_remap_and_zscore(spark):
    df = spark.createDataFrame([(0, 0, True), (0, 1, False), (0, 2, True), (0, 3, True)], "g int, k int, mask boolean")
    got = ordering.gap_shift(df, "g", "k", F.col("mask")).orderBy("k").collect()
    assert [(r.k, r.gapless) for r in got if r.mask] == [(0, 0), (2, 1), (3, 2)]
    z = ordering.zscores(spark.createDataFrame([(4.0,)] * 3, "x double"), "x").collect()
    assert [r.z_x for r in z] == [0, 0, 0]


def test_block_means(spark):
    ones = spark.createDataFrame([(i, j, 1.0) for i in range(3) for j in range(3)], "i long, j long, v double")
    got = {(r.i, r.j): r.v for r in matrix.downsampled(ones, 2).collect()}
    assert got == {(0, 0): 1.0, (0, 1): 0.5, (1, 0): 0.5, (1, 1): 0.25}


def test_balance_converges(spark):
    rng = np.random.default_rng(0)
    a = [(i, j, float(rng.integers(1, 9))) for i in range(6) for j in range(i, 6)]
    _, scaled = matrix.balanced(spark.createDataFrame(a, "i long, j long, v double"), 100, 1e-9)
    sums = contacts.symmetric(scaled).groupBy("i").agg(F.sum("v").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-6 for r in sums)


def test_regression_recovers_coefficients(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 2))
    mu = np.exp(1.5 + 0.7 * x[:, 0] - 0.4 * x[:, 1])
    y = rng.poisson(mu * rng.gamma(1.0, 1.0, 4000)) + 0.0
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, (b, c) in zip(y, x, strict=True)], "y double, a double, b double")
    beta = models.negative_binomial(df.withColumn("y", F.col("y") + 1e-9), "y", ["a", "b"])
    assert np.allclose(beta, [1.5, 0.7, -0.4], atol=0.12)


def test_mixture(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate((rng.normal(300, 40, 4000), rng.normal(1500, 300, 1000)))
    got = models.gaussian_mixture(spark.createDataFrame([(float(v),) for v in x], "x double"), "x")
    assert abs(got["mean_n"] - 300) < 20 and abs(got["mean_c"] - 1500) < 80
    assert models.gaussian_mixture(spark.createDataFrame([], "x double"), "x")["cutoff"] == 500


def test_assignment():
    rng = np.random.default_rng(5)
    from itertools import permutations

    for n, m in ((3, 3), (2, 5), (4, 3)):
        c = rng.normal(size=(n, m))
        best = min(sum(c[i, j] for i, j in zip(range(n), p, strict=False)) for p in permutations(range(m), n)) if n <= m else min(sum(c[i, j] for j, i in enumerate(p)) for p in permutations(range(n), m))
        assert math.isclose(sum(c[i, j] for i, j in graph.assignment(c)), best)


def test_formats(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">c1 first\nACGT\nAC\n>c2\nGG\n")
    assert sorted((r.contig, r.seq) for r in formats.fasta(spark, str(tmp_path / "a.fa")).collect()) == [("c1", "ACGTAC"), ("c2", "GG")]
    (tmp_path / "a.fq").write_text("@r1/1\nACGT\n+\nIIII\n@r2/1\nGG\n+\nII\n")
    assert sorted((r.qname, r.seq, r.qual) for r in formats.fastq(spark, str(tmp_path / "a.fq"), 1).collect()) == [("r1", "ACGT", "IIII"), ("r2", "GG", "II")]
    (tmp_path / "a.sam").write_text("@SQ\tSN:c1\tLN:50\nr1\t4\tc1\t1\t60\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:2\n")
    assert formats.sam(spark, str(tmp_path / "a.sam")).first().tags == ["NM:i:2"]
    assert formats.sam_header(spark, str(tmp_path / "a.sam")).first().length == 50
    (tmp_path / "a.tree").write_text("# flow\n1:1:1 0.5 \"a\" 7\n1:1:2 0.2 \"b\" 8\n2:1 0.1 \"c\" 9\n")
    assert sorted((r.node, r.cluster) for r in formats.cluster_tree(spark, str(tmp_path / "a.tree")).collect()) == [(7, 0), (8, 0), (9, 1)]
    (tmp_path / "a.stats").write_text("b1\t{'GC': 0.5, 'N50': 10}\n")
    assert formats.dict_stats(spark, str(tmp_path / "a.stats")).first().figures["N50"] == "10"
    (tmp_path / "a.out").write_text(">s1 x\n1\t30\t+\t1\t1.2\n>s2\n5\t35\t-\t2\t1.3\n")
    assert sorted((r.seqid, r.start) for r in formats.gene_calls(spark, str(tmp_path / "a.out")).collect()) == [("s1", 1), ("s2", 5)]


def test_library_does_not_import_the_text_operators():
    import ast
    from pathlib import Path

    import quillon

    root = Path(quillon.__file__).parent
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            for n in ast.walk(ast.parse(p.read_text())):
                names = [a.name for a in n.names] if isinstance(n, ast.Import) else [n.module or "", *[a.name for a in n.names]] if isinstance(n, ast.ImportFrom) else []
                assert not any("llm" in x.split(".") for x in names), p


def test_all_markers_are_matched(spark, tmp_path):
    """14 markers on contigs 1 and 2, then two on one contig each: 3 touches contig 1, 4 touches none."""
    on = [(m, c) for m in range(14) for c in (1, 2)] + [(14, 3), (15, 4)]
    hit = [(100 + n, 1, m, c, 1.0, 50.0) for n, (m, c) in enumerate(on)]
    link = [(o, k, 99, c, 1.0, 20.0) for o in (1, 2) for k, c in ((1, 1), (2, 3))]
    kinds = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double"
    spark.createDataFrame(hit + link, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(m, f"m{m:02}", 1) for m in range(16)], "p_partkey long, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = registry.queries()["marker_matching"](spark, str(tmp_path)).collect()
    assert {r.contig: r.bin for r in got} == {1: 0, 2: 1, 3: 0, 4: 2}


def test_matching_draws_sums_not_contacts(spark):
    """Sums by bin come from the contacts' table, the same as from arrays; it is not asked for before a marker has new contigs."""
    from quillon.plans import more_queries

    asked, rows = [], [(1, 3, 2), (2, 3, 5), (3, 4, 1), (2, 5, 7), (1, 2, 9)]

    def table():
        asked.append(1)
        return spark.createDataFrame(rows, "i long, j long, v long")

    sums = more_queries.drawn_sums(table)
    assert graph.matched_bins([("a", [1, 2]), ("b", [2, 1])], None, 1.0, 0.0, {}, sums) == {1: 0, 2: 1} and not asked
    i, j, v = map(np.array, zip(*rows, strict=True))
    want = graph.sums_of(np.arange(1, 6), i, j, v)([3, 5, 4], {1: 0, 2: 1}, 2)
    assert sums([3, 5, 4], {1: 0, 2: 1}, 2).tolist() == want.tolist() and len(asked) == 1


def test_sums_agree_with_single_weights():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n = int(rng.integers(2, 30))
        w = {(a, b): int(rng.integers(1, 5)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.3}
        markers = [(f"m{k}", sorted(rng.choice(n, rng.integers(1, n), replace=False).tolist())) for k in range(15)]
        own = {c: {m for m, on in markers if c in on and rng.random() < 0.2} for c in range(n)}
        ends = np.array([*w, (0, 1)])
        sums = graph.sums_of(np.arange(n), ends[:, 0], ends[:, 1], np.array([*w.values(), 0]))
        plain = graph.matched_bins(markers, lambda a, b: float(w.get((min(a, b), max(a, b)), 0)), 1.0, 0.0, own)
        assert graph.matched_bins(markers, None, 1.0, 0.0, own, sums) == plain


def test_weak_contacts_are_clustered(spark, tmp_path):
    """Contigs 5 and 6 have weak contacts only; the seed marker is on two contigs, and no resolution gives three large clusters."""
    pairs = [(1, 2)] * 3 + [(3, 4)] * 3 + [(5, 1), (6, 3)]
    link = [(o, k, 99, c, 1.0, 20.0) for o, ends in enumerate(pairs) for k, c in enumerate(ends)]
    hit = [(100 + c, 1, 0, c, 1.0, 50.0) for c in (1, 2)]
    kinds = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double"
    spark.createDataFrame(link + hit, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(0, "m", 1)], "p_partkey long, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(c, 1.0) for c in range(1, 7)], "s_suppkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    run = lambda name: registry.queries()[name](spark, str(tmp_path)).collect()
    assert {r.node: r.cluster for r in run("modularity_clusters")} == {1: 1, 2: 1, 5: 1, 3: 3, 4: 3, 6: 3}
    assert run("modularity_quality")[0].modularity == pytest.approx(0.5)
    swept = run("resolution_sweep")
    assert {r.node for r in swept} == set(range(1, 7)) and {r.gamma for r in swept} == {500.0}


def test_headers_may_hold_the_mark(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">c1 len>5\nACGT\nAC\n>c2\n>c3 >x\r\nGG\r\n")
    got = sorted((r.contig, r.header, r.seq) for r in formats.fasta(spark, str(tmp_path / "a.fa")).collect())
    assert got == [("c1", "c1 len>5", "ACGTAC"), ("c2", "c2", ""), ("c3", "c3 >x", "GG")]


def test_records_across_parts_of_a_file(spark, tmp_path):
    """A file that many tasks read in parts: records and headers go over the parts' edges."""
    n = 400
    (tmp_path / "r.fq").write_text("".join(f"@r{k}/1 x\n{'ACGT' * (k % 7 + 1)}\n+\n{'I' * (4 * (k % 7 + 1))}\n" for k in range(n)))
    (tmp_path / "g.out").write_text("".join(f">s{k} x\n" + "".join(f"{p}\t{p + 9}\t+\t1\t1.5\n" for p in range(k % 40)) for k in range(60)))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert spark.read.text(str(tmp_path / "r.fq")).rdd.getNumPartitions() > 10
        got = {r.qname: (r.seq, len(r.qual)) for r in formats.fastq(spark, str(tmp_path / "r.fq"), 1).collect()}
        assert got == {f"r{k}": ("ACGT" * (k % 7 + 1), 4 * (k % 7 + 1)) for k in range(n)}
        calls = sorted((r.seqid, r.start) for r in formats.gene_calls(spark, str(tmp_path / "g.out")).collect())
        assert calls == sorted((f"s{k}", p) for k in range(60) for p in range(k % 40))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_empty_matrix_is_balanced(spark):
    none = spark.createDataFrame([], "i long, j long, v long")
    x, scaled = matrix.balanced(none, 5, 1e-6)
    assert x.count() == 0 and scaled.count() == 0


def test_mixture_cutoff():
    z = C.Z95
    assert models.mixture_cutoff(300, 50, 900, 100) == min(900 - z * 100, 300 + z * 50)
    assert models.mixture_cutoff(-300, 50, 900, 100) == 900 - z * 100  # the lower one's end does not count
    assert models.mixture_cutoff(300, 50, 100, 100) == 300 + z * 50
    assert models.mixture_cutoff(10, 1, 20, 1) == 100 and models.mixture_cutoff(float("nan"), 1, 2, 1) == 500


def test_single_only_before_the_end(spark):
    """An odd last record counts unless its name is the last one; without any there is no row."""
    kept = spark.createDataFrame([("c",)], "contig string")
    frame = lambda names: spark.createDataFrame([(q, i, "c", 60) for i, q in enumerate(names)], "qname string, at int, contig string, mapq int")
    count = lambda names: {r.status: r.n for r in contacts.accounting(frame(names), kept, F.col("mapq") >= 30, "at").collect()}
    assert count(["a", "b", "b", "b", "c"]) == {"same_contig": 1, "single": 2}
    assert count(["a", "a", "b"]) == {"same_contig": 1} and count([]) == {}


def test_clashing_columns(spark):
    rows = spark.createDataFrame([("t", "h1", 1, 100, "mine", 7), ("t", "h2", 2, 101, "own", 8)], "target string, hit string, start int, end int, s string, e int")
    got = hits.without_twins(rows).collect()
    assert [(r.hit, r.s, r.e) for r in got] == [("h1", "mine", 7)]
    d = spark.createDataFrame([("a", 50, 1, "x"), ("a", 30, 2, "y")], "bin string, length long, run int, total string")
    assert ordering.n50(d, "bin", "length", "run").first().n50 == 50


def test_gates_and_flags(spark):
    d = spark.createDataFrame([(True, 9_999, 1, 1, 0, 0), (True, -10_000, 1, 1, 0, 0), (False, None, 1, 1, 0, 0), (False, 5, 0, 1, 0, 0), (False, 5, 1, 1, 1024, 0), (False, 5, 1, 1, 0, 4)], "same boolean, d int, a int, b int, fa int, fb int")
    columns = [F.col(c) for c in ("same", "d", "a", "b", "fa", "fb")]
    got = [(r[0], r[1]) for r in d.select(contacts.informative(*columns), contacts.informative(*columns, strict=True)).collect()]
    assert got == [(False, False), (True, False), (True, True), (False, False), (False, False), (False, False)]
    r = spark.createDataFrame([("c1", "c2", 1), ("c1", "c9", 1), ("c1", "c2", 9), ("c1", "c2", 0), (None, "c2", 1)], "contig string, mate_contig string, flag int")
    allowed = spark.createDataFrame([("c1",), ("c2",), ("c2",)], "contig string")
    assert contacts.mate_gated(r, allowed).count() == 1


def test_order_is_checked(spark):
    own = spark.createDataFrame([(1,), (2,), (3,)], "contig long")
    order = lambda rows: spark.createDataFrame(rows, "contig long, at long, orientation int")
    got = {r.contig: (r.place, r.orientation, r.accepted) for r in ordering.ordered(own, order([(3, 5, 1), (1, 9, 0)])).collect()}
    assert got == {3: (0, 1, True), 1: (1, 0, True), 2: (None, None, False)}
    for wrong in ([(3, 5, 1), (3, 6, 1)], [(4, 1, 0)]):
        with pytest.raises(ValueError):
            ordering.ordered(own, order(wrong))


def test_normalisers(spark):
    """Contacts made from a known mean come back flat; kinds that do not exist are refused."""
    rng = np.random.default_rng(2)
    n = 40
    v = [(i, int(rng.integers(1, 60)), int(rng.integers(2000, 90000)), float(rng.uniform(1, 30))) for i in range(n)]
    mu = [np.sqrt(s + 1) * c**0.5 for _, s, _, c in v]
    rows = [(i, j, float(1 + 10 * mu[i] * mu[j])) for i in range(n) for j in range(i + 1, n)]
    e, vertices = spark.createDataFrame(rows, "i long, j long, v double"), spark.createDataFrame(v, "contig long, sites long, length long, coverage double")
    spread = lambda d: float(np.std([r.v for r in d.collect()]) / np.mean([r.v for r in d.collect()]))
    raw = spread(jobs.normalised(e, vertices, "raw", None))
    for kind in ("fitted", "pair_fitted"):
        assert spread(jobs.normalised(e, vertices, kind, None)) < 0.6 * raw
    assert jobs.normalised(e, vertices, "raw", 5.0).count() < len(rows)
    assert jobs.normalised(e.where("v < 0"), vertices, "coverage").count() == 0
    with pytest.raises(ValueError):
        jobs.normalised(e, vertices, "other")
    got = jobs.binned(e, vertices, 0, [1.0, 5.0], 1)
    assert got.count() == n and {r.gamma for r in got.select("gamma").distinct().collect()} == {1.0}


def test_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from quillon.sources import tables

    unset = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: unset)))
    with pytest.raises(ValueError):
        tables.shared_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None)))
