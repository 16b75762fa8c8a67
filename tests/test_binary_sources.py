"""Binary alignments, files named by key, and exact percentiles: round trips and failures."""

import gzip
import random
import re
import struct
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.operators import quantiles
from quillon.sources import bam, keyed

REFERENCES = [(f"c{k:02d}", 5000 + 100 * k) for k in range(12)]
FIELDS = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual", "tags")


def alignments(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        name, size = rng.choice(REFERENCES)
        m = rng.choice((0, 1, 7, 50, 151, 3000 if k % 97 == 0 else 40))
        seq = "".join(rng.choice("ACGTN") for _ in range(m)) or "*"
        unmapped = rng.random() < 0.1
        cigar = "*" if unmapped or not m else f"{m}M" if m < 9 else f"2S{m - 5}M2I1D1M"
        tags = [["NM:i:3", "AS:i:-7"], ["XA:Z:c01,+5;x", "XF:f:0.5", "XC:A:q"], ["ZB:B:c,-1,2,3", "ZF:B:f,0.5,2"], []][k % 4]
        rows.append(
            (f"read{rng.randrange(n)}", rng.choice((0, 16, 99, 147)) | 4 * unmapped, "*" if unmapped else name, 0 if unmapped else rng.randrange(1, size), rng.randrange(61), cigar,
             rng.choice(("=", "*", "c03")) if not unmapped else "*", rng.randrange(0, 4000), rng.randrange(-500, 500), seq, "*" if k % 5 == 0 or seq == "*" else "".join(chr(33 + rng.randrange(41)) for _ in seq), tags)
        )
    return rows


@pytest.fixture(scope="module")
def rows():
    return alignments(6000)


@pytest.fixture(scope="module")
def written(spark, rows, tmp_path_factory):
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags array<string>")
    references = spark.createDataFrame(REFERENCES, "name string, length long")
    out = {}
    for order in ("queryname", "coordinate"):
        out[order] = str(tmp_path_factory.mktemp("bam") / order)
        bam.write_bam(df, out[order], references, order)
    return out


def plain(df):
    return sorted(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.select(*FIELDS).collect())


@pytest.mark.parametrize("order", ["queryname", "coordinate"])
@pytest.mark.parametrize("split", [1 << 23, 20_000, 3_001])
def test_alignments_come_back_from_any_split(spark, rows, written, order, split):
    got = bam.bam(spark, written[order], order, split=split)
    assert got.rdd.getNumPartitions() > (20 if split < 5000 else 0)
    want = sorted((*r[:6], "=" if r[6] == r[2] and r[2] != "*" else r[6], *r[7:11], tuple(r[11])) for r in rows)
    assert plain(got) == want
    assert got.select("file", "file_pos").distinct().count() == len(rows)


def test_splits_of_a_file_share_its_header(written, monkeypatch):
    """References are read once for a file, not for each of its splits; planning reads no more than the first block."""
    from pyspark.sql.types import _parse_datatype_string

    read, real = [], bam.header_of
    monkeypatch.setattr(bam, "header_of", lambda *a: (read.append(1), real(*a))[1])
    reader = bam.BamReader(_parse_datatype_string("qname string"), {"path": written["queryname"], "order": "queryname", "splitbytes": "5000"})
    parts = reader.partitions()
    assert not read
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 6000
    assert len(read) == len({p.path for p in parts}) < len(parts)


def test_fewer_fields_and_header(spark, rows, written):
    got = bam.bam(spark, written["queryname"], fields="flag int, qname string")
    assert got.columns == ["flag", "qname"] and sorted(map(tuple, got.collect())) == sorted((r[1], r[0]) for r in rows)
    assert [(r.name, r.length) for r in bam.bam_header(spark, written["queryname"]).orderBy("refid").collect()] == REFERENCES
    with pytest.raises(Exception, match="no such fields"):
        bam.bam(spark, written["queryname"], fields="quality int").collect()


def test_orders(spark, rows, written):
    names = [r.qname for r in bam.bam(spark, written["queryname"], "queryname").orderBy("file", "file_pos").collect()]
    assert names == sorted(names)
    own = bam.mapped(spark, written["coordinate"]).orderBy("file", "file_pos").collect()
    assert [(r.rname, r.pos) for r in own] == sorted((r[2], r[3]) for r in rows if not r[1] & 4)
    for order, other in (("queryname", "coordinate"), ("coordinate", "queryname")):
        with pytest.raises(Exception, match="is in the order"):
            bam.bam(spark, written[order], other).count()


@pytest.mark.parametrize("region", ["c05", "c05:1000-1200", "c00:1-1", "c11:4000-99999"])
def test_regions(spark, rows, written, region):
    name, _, places = region.partition(":")
    lo, hi = map(int, places.split("-")) if places else (1, 1 << 40)

    def covers(r):
        span = sum(int(n) for n, c in re.findall(r"(\d+)([MIDNSHP=X])", r[5]) if c in "MDN=X")
        return r[2] == name and r[3] <= hi and r[3] + max(span, 1) - 1 >= lo

    got = bam.bam(spark, written["coordinate"], region=region, split=5000)
    assert sorted((r.qname, r.pos) for r in got.collect()) == sorted((r[0], r[3]) for r in rows if covers(r))
    whole = bam.bam(spark, written["coordinate"], split=5000)
    assert got.rdd.getNumPartitions() < whole.rdd.getNumPartitions() / 2
    with pytest.raises(Exception, match="coordinate"):
        bam.bam(spark, written["queryname"], region=region).count()


def test_blocks_are_gzip_members(written):
    """Any reader of gzip reads the whole stream, and each record says its own length."""
    for path in sorted(Path(written["queryname"]).glob("*.bam")):
        data = gzip.decompress(path.read_bytes())
        at = 8 + struct.unpack_from("<i", data, 4)[0]
        count, at = struct.unpack_from("<i", data, at)[0], at + 4
        for _ in range(count):
            at += 8 + struct.unpack_from("<i", data, at)[0]
        while at < len(data):
            at += 4 + struct.unpack_from("<i", data, at)[0]
        assert at == len(data) and path.read_bytes().endswith(bam.LAST_BLOCK)


def test_damaged_files(spark, written, tmp_path):
    good = next(Path(written["queryname"]).glob("*.bam")).read_bytes()
    for name, raw in (("cut", good[: len(good) // 2]), ("flipped", good[:5000] + bytes([good[5000] ^ 255]) + good[5001:]), ("text", b"not an alignment" * 100)):
        (tmp_path / f"{name}.bam").write_bytes(raw)
        with pytest.raises(Exception):  # noqa: B017
            bam.bam(spark, str(tmp_path / f"{name}.bam")).count()
    with pytest.raises(Exception, match="missing"):
        bam.bam(spark, str(tmp_path / "missing.bam")).count()


def test_empty_alignments(spark, tmp_path):
    references = spark.createDataFrame(REFERENCES, "name string, length long")
    df = spark.createDataFrame([], "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags array<string>")
    bam.write_bam(df, str(tmp_path / "none"), references)
    bam.write_bam(df, str(tmp_path / "none"), references, mode="overwrite")
    assert bam.bam(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="written already"):
        bam.write_bam(df, str(tmp_path / "none"), references)


# -- files by key ------------------------------------------------------------------------------------------------------
def names(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("*") if p.is_file() and not p.name.startswith("."))


def test_bin_files(spark, tmp_path):
    m = spark.createDataFrame([(b, f"k{i}", "ACGT" * (i + 1)) for i, b in enumerate([7, 7, 12, 10_007, 7])], "bin int, contig string, seq string").repartition(3)
    keyed.write_bin_files(m, str(tmp_path / "bins"))
    assert names(tmp_path / "bins") == ["BIN0007.fa", "BIN0012.fa", "BIN10007.fa", "_SUCCESS"]
    assert (tmp_path / "bins/BIN0007.fa").read_text() == ">k0\nACGT\n>k1\nACGTACGT\n>k4\n" + "ACGT" * 5 + "\n"
    with pytest.raises(Exception, match="written already"):
        keyed.write_bin_files(m, str(tmp_path / "bins"))
    keyed.write_bin_files(m.where("bin = 12"), str(tmp_path / "bins"), mode="overwrite")
    assert names(tmp_path / "bins") == ["BIN0012.fa", "_SUCCESS"]


def test_clusters_with_an_order(spark, tmp_path):
    members = spark.createDataFrame([("CL1", f"k{i:02d}", "AACG" + "T" * i) for i in range(11)] + [("CL2", "z", "A" * 70), ("CL3", "y", "A")], "cluster string, contig string, seq string")
    order = spark.createDataFrame([("CL1", "k03", 0, False), ("CL1", "k00", 1, True)], "cluster string, contig string, place int, forward boolean")
    keyed.write_keyed(keyed.cluster_records(members, order, least=10), str(tmp_path / "c"), "n")
    assert names(tmp_path / "c") == ["CL1.fna", "CL1.ordered.fna", "CL2.fna", "_SUCCESS"]
    assert (tmp_path / "c/CL1.ordered.fna").read_text() == ">CL1_1 contig:k03 ori:- length:7\nAAACGTT\n>CL1_2 contig:k00 ori:+ length:4\nAACG\n"
    lines = (tmp_path / "c/CL1.fna").read_text().split("\n")
    assert lines[0] == ">CL1_01 contig:k00 ori:UNKNOWN length:4" and lines[20] == ">CL1_11 contig:k10 ori:UNKNOWN length:14"
    assert (tmp_path / "c/CL2.fna").read_text() == ">CL2_1 contig:z ori:UNKNOWN length:70\n" + "A" * 60 + "\n" + "A" * 10 + "\n"


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    """One row of one file is refused: no file of the job appears, and the same job without it writes all of them."""
    df = spark.createDataFrame([(f"f{k % 9}", str(k)) for k in range(90)] + [("../x", "bad")], "file string, value string")
    with pytest.raises(Exception, match="no name of a file"):
        keyed.write_keyed(df, str(tmp_path / "k"), "value")
    assert not [n for n in names(tmp_path / "k") if not n.startswith("_temporary")]
    keyed.write_keyed(df.where("value <> 'bad'"), str(tmp_path / "k"), "value")
    assert names(tmp_path / "k") == ["_SUCCESS", *[f"f{k}" for k in range(9)]]
    assert (tmp_path / "k/f3").read_text().split() == sorted(str(k) for k in range(3, 90, 9))


# -- percentiles -------------------------------------------------------------------------------------------------------
def test_ten_million_distinct_values(spark):
    values = spark.range(10_000_000).select((F.pmod(F.col("id") * 48271, F.lit(10_000_019)) / 7.0).alias("x"))
    shares = [0.05, 0.5, 0.987654]
    want = np.quantile(values.toPandas()["x"].to_numpy(), shares)
    assert quantiles.percentiles(values, "x", shares) == pytest.approx(list(want), rel=1e-14)


@pytest.mark.parametrize("most", [1, 3, 50])
def test_percentiles_of_odd_values(spark, most):
    rng = random.Random(most)
    kinds = [lambda: rng.gauss(0, 1), lambda: float(rng.randrange(3)), lambda: 2.0 ** -rng.randrange(1000), lambda: rng.choice((1e300, -1e300, 0.0, -0.0)), lambda: 7.0]
    for kind in kinds:
        own = [kind() for _ in range(rng.choice((1, 2, 300)))]
        df = spark.createDataFrame([(x,) for x in [*own, None]], "x double")
        shares = [0.0, 0.05, 0.5, 0.8, 1.0]
        assert quantiles.percentiles(df, "x", shares, most) == pytest.approx(list(np.quantile(own, shares)), rel=1e-12)
        assert quantiles.at_rank(df, "x", 0.5) == sorted(own)[len(own) // 2]
    assert quantiles.percentiles(df.where("x is null"), "x", [0.5]) == [None]
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,)], "x double")
    assert quantiles.percentiles(nan, "x", [0.5], most) == [2.0] and np.isnan(quantiles.percentiles(nan, "x", [1.0], most)[0])
    with pytest.raises(ValueError):
        quantiles.percentiles(df, "x", [1.5])


def test_group_percentiles(spark):
    """A group with most of the rows is spread over partitions; the result is that of each group by itself."""
    rng = random.Random(2)
    rows = [("hot", rng.random()) for _ in range(5000)] + [(f"g{k % 40}", float(rng.randrange(9))) for k in range(900)] + [("one", 4.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    for share in (0.0, 0.3, 0.5, 1.0):
        got = {r.g: r.p for r in quantiles.group_percentiles(df, "g", "x", share, "p").collect()}
        want = {g: np.quantile([x for h, x in rows if h == g and x is not None], share) for g in {g for g, x in rows if x is not None}}
        assert got.keys() == want.keys() and all(got[g] == pytest.approx(want[g], rel=1e-12) for g in want)


# -- sparse arrays -----------------------------------------------------------------------------------------------------
def archive(path, dense, kind, compressed):
    """A matrix as the usual tools write it."""
    i, j = np.nonzero(dense)
    if kind == "csc":
        order = np.lexsort((i, j))
        i, j = i[order], j[order]
    own = {"format": np.array(kind.encode()), "shape": np.array(dense.shape), "data": dense[i, j]}
    major, minor = (i, j) if kind == "csr" else (j, i)
    if kind == "coo":
        own |= {"row": i.astype(np.int32), "col": j.astype(np.int32)}
    else:
        own |= {"indices": minor.astype(np.int32), "indptr": np.searchsorted(major, np.arange(dense.shape[kind == "csc"] + 1)).astype(np.int32)}
    (np.savez_compressed if compressed else np.savez)(path, **own)


@pytest.mark.parametrize("kind", ["coo", "csr", "csc"])
@pytest.mark.parametrize("compressed", [False, True])
def test_sparse_archives(spark, tmp_path, monkeypatch, kind, compressed):
    from quillon.sources import npz

    rng = np.random.default_rng(5)
    dense = np.where(rng.random((70, 90)) < 0.2, rng.integers(1, 9, (70, 90)), 0)
    dense[10:40], dense[:, 30:50], dense[69] = 0, 0, 0
    archive(str(tmp_path / "m.npz"), dense, kind, compressed)
    monkeypatch.setattr(npz, "CHUNK", 7)  # chunks of entries and of rows end anywhere
    reader = npz.NpzReader({"path": str(tmp_path / "m.npz"), "splitentries": "100"})
    splits = reader.partitions()
    assert len(splits) == (1 if compressed else -(-np.count_nonzero(dense) // 100))
    got = np.zeros(dense.shape)
    for s in splits:
        for b in reader.read(s):
            got[b["i"].to_numpy(), b["j"].to_numpy()] += b["v"].to_numpy()
    assert (got == dense).all()
    rows = {(r.i, r.j): r.v for r in npz.npz(spark, str(tmp_path / "m.npz"), 150).collect()}
    assert rows == {(i, j): float(v) for (i, j), v in np.ndenumerate(dense) if v}


def test_sparse_archives_are_written(spark, tmp_path):
    from quillon.sources import npz

    rows = [(k % 50, k * 7 % 60, k / 2) for k in range(1000)]
    e = spark.createDataFrame(rows, "i long, j long, v double").repartition(5)
    npz.write_npz(e, str(tmp_path / "m"), 50, 60)
    assert sorted(map(tuple, npz.npz(spark, str(tmp_path / "m")).collect())) == sorted(rows)
    one = np.load(next((tmp_path / "m").glob("*.npz")))
    assert one["format"].item() == b"coo" and one["shape"].tolist() == [50, 60] and len(one["row"]) == len(one["data"])
    with pytest.raises(Exception, match="outside"):
        npz.write_npz(e, str(tmp_path / "small"), 10, 60)
    npz.write_npz(e.limit(0), str(tmp_path / "none"), 1, 1)
    assert npz.npz(spark, str(tmp_path / "none")).count() == 0
    np.savez(str(tmp_path / "odd.npz"), data=np.ones(3))
    with pytest.raises(Exception, match="no coordinates"):
        npz.npz(spark, str(tmp_path / "odd.npz")).collect()
