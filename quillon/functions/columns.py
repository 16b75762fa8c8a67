"""Scalar expressions: alignment flags and CIGAR, names, sequences, means and formats. All but translated are JVM-side columns."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Bits of an alignment flag (fixed values of the format).
PAIRED, UNMAPPED, MATE_UNMAPPED, REVERSE, FIRST, SECOND = 0x1, 0x4, 0x8, 0x10, 0x40, 0x80
SECONDARY, DUPLICATE, SUPPLEMENTARY = 0x100, 0x400, 0x800
#: Recognition motifs by enzyme (fixed values).
MOTIFS = {
    "DpnII": "GATC", "MboI": "GATC", "Sau3AI": "GATC", "MluCI": "AATT", "HindIII": "AAGCTT", "NlaIII": "CATG", "EcoRI": "GAATTC", "HinfI": "GANTC", "DdeI": "CTNAG",
}
#: Ambiguity codes of nucleotides (fixed values).
AMBIGUOUS = {"R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}
Z95 = 1.6448536269514722


def has(flag: Column, required: int = 0, excluded: int = 0) -> Column:
    """All required bits are set and no excluded one is."""
    return (flag.bitwiseAND(F.lit(required)) == required) & (flag.bitwiseAND(F.lit(excluded)) == 0)


def informative(flag: Column) -> Column:
    return has(flag, 0, UNMAPPED | SECONDARY | SUPPLEMENTARY)


def strong_match(flag: Column, mapq: Column, cigar: Column, min_mapq: int, min_match: int) -> Column:
    """Mapping quality, and a match operation of min_match bases at the read's 5' end; 0 asks for the quality alone."""
    if not min_match:
        return mapq >= min_mapq
    head = F.regexp_extract(cigar, r"^(\d+)M", 1)
    tail = F.regexp_extract(cigar, r"(\d+)M$", 1)
    end = F.when(flag.bitwiseAND(F.lit(REVERSE)) != 0, tail).otherwise(head)
    return F.coalesce((mapq >= min_mapq) & (end != "") & (F.expr("0") + end.try_cast("int") >= min_match), F.lit(False))


def motif_regex(enzyme: str) -> str:
    if enzyme not in MOTIFS:
        import difflib

        near = difflib.get_close_matches(enzyme, MOTIFS, cutoff=0.8)
        raise ValueError(f"unknown enzyme {enzyme!r}" + (f"; did you mean {', '.join(near)}?" if near else ""))
    return "".join(f"[{AMBIGUOUS[c]}]" if c in AMBIGUOUS else c for c in MOTIFS[enzyme])


def site_count(seq: Column, *enzymes: str) -> Column:
    """Overlapping occurrences of the enzymes' motifs, added up."""
    total = F.lit(0)
    for e in enzymes:
        total = total + F.regexp_count(seq, F.lit(f"(?={motif_regex(e)})"))
    return total.cast("long")


def tip_sites(seq: Column, tip: int, *enzymes: str) -> Column:
    """Sites within `tip` bases of either end; sequences too short for two tips are halved."""
    half = F.floor(F.length(seq) / 2).cast("int")
    size = F.when(F.length(seq) < 2 * tip, half).otherwise(F.lit(tip))
    left = F.substring(seq, F.lit(1), size)
    right = F.substring(seq, F.length(seq) - size + 1, size)
    return F.array(site_count(left, *enzymes), site_count(right, *enzymes))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def oriented(value: Column, flag: Column, complement: bool) -> Column:
    """Sequence or quality as the read had it."""
    turned = reverse_complement(value) if complement else F.reverse(value)
    return F.when(flag.bitwiseAND(F.lit(REVERSE)) != 0, turned).otherwise(value)


def gc_fraction(seq: Column) -> Column:
    """G and C among A, C, G and T; 0 without any of them."""
    gc = F.regexp_count(seq, F.lit("[GCgc]"))
    return F.when(F.regexp_count(seq, F.lit("[ACGTacgt]")) == 0, F.lit(0.0)).otherwise(gc / F.regexp_count(seq, F.lit("[ACGTacgt]")))


def gc_bucket(seq: Column) -> Column:
    """floor(100 * GC / length) - 26, from 0 to 43."""
    share = F.floor(100 * F.regexp_count(seq, F.lit("[GCgc]")) / F.length(seq)) - 26
    return F.greatest(F.lit(0), F.least(F.lit(43), share)).cast("int")


def segments(name: Column, seq: Column, size: int) -> Column:
    """Array of (name_seg_k, part) with parts of `size`, the last one shorter; none of an empty sequence."""
    n = F.ceil(F.length(seq) / size).cast("int")
    k = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(k, lambda i: F.struct(F.concat(name, F.lit("_seg_"), i.cast("string")).alias("segment"), F.substring(seq, (i - 1) * size + 1, F.lit(size)).alias("part")))


def scaffold_of(segment: Column) -> Column:
    return F.split(segment, "_seg_")[0]


def mismatches(tags: Column) -> Column:
    return F.regexp_extract(tags, r"NM:i:(\d+)", 1).try_cast("int")


MEANS = {
    "geometric": lambda x, y: F.sqrt(x * y),
    "harmonic": lambda x, y: 2 * x * y / (x + y),
    "arithmetic": lambda x, y: (x + y) / 2,
}


def mean_of(kind: str, x: Column, y: Column) -> Column:
    if kind not in MEANS:
        raise ValueError(f"unknown mean {kind!r}; known: {', '.join(MEANS)}")
    return MEANS[kind](x, y)


def log_plus(x: Column, epsilon: float) -> Column:
    return F.log(x + F.lit(epsilon))


def normal_pdf(x: Column, mean: float, std: float) -> Column:
    return F.exp(-((x - mean) ** 2) / (2 * std * std)) / (std * math.sqrt(2 * math.pi))


def padded(prefix: str, number: Column, width: int = 4) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def contig_of_gene(gene: Column) -> Column:
    """The gene id without its last three tokens."""
    return F.regexp_replace(gene, r"(_[^_]*){3}$", "")


def contig_of_hit(gene: Column) -> Column:
    """What stands before start, end and strand."""
    return F.regexp_extract(gene, r"^(.+)_\d+_\d+_[+-]$", 1)


def first_word(header: Column) -> Column:
    return F.element_at(F.split(F.trim(header), r"\s+"), 1)


def kmer_contig(header: Column) -> Column:
    """The assembler's contig name at the start of a header; empty if there is none."""
    return F.regexp_extract(header, r"^(k\d+_\d+)", 1)


def prefixed(group: Column, name: Column) -> Column:
    return F.concat(group, F.lit("_"), name)


#: Marker families that count as another one (fixed values).
ALIASES = {"TIGR00388": "TIGR00389", "TIGR00471": "TIGR00472", "TIGR00408": "TIGR00409", "TIGR02386": "TIGR02387"}


def marker_alias(marker: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])[marker], marker)


def last_token(name: Column) -> Column:
    return F.element_at(F.split(name, "_"), -1)


def clean_header(header: Column) -> Column:
    return F.translate(header, "=", "_")


def truncated(x: Column, size: int = 5) -> Column:
    return F.substring(x.cast("string"), 1, size)


def mbp(x: Column) -> Column:
    return F.round(x / 1048576, 2)


def ratio(a: Column, b: Column) -> Column:
    """a / b; infinite where b is 0 and a is not, 0 where both are."""
    return F.when(b != 0, a / b).when(a != 0, F.lit(float("inf"))).otherwise(F.lit(0.0))


def log_sum_exp(a: Column, b: Column) -> Column:
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


#: Codons in the order of the bases A, C, G, T (fixed values of the standard code).
AMINO = "KNKNTTTTRSRSIIMIQHQHPPPPRRRRLLLLEDEDAAAAGGGGVVVV*Y*YSSSS*CWCLFLF"
#: Number of each letter's base (4 for no base), and amino acid of each three such numbers.
BASES = np.array(["ACGT".find(chr(c).upper()) % 5 for c in range(128)], np.uint8)
RESIDUES = np.array([ord("X") if 4 in (i // 25, i // 5 % 5, i % 5) else ord(AMINO[i // 25 * 16 + i // 5 % 5 * 4 + i % 5]) for i in range(125)], np.uint8)


def protein(seq: str | None) -> str:
    """Amino acids of whole codons; X for a codon with another letter."""
    points = np.frombuffer((seq or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points) // 3
    letters = BASES[np.minimum(points[: 3 * n], 127)].reshape(n, 3)
    return RESIDUES[letters @ np.array([25, 5, 1])].tobytes().decode()


def translated(seq: Column) -> Column:
    """The protein of a whole sequence, in linear time: a substring for each codon would scan from the start each time."""
    return F.pandas_udf(lambda seqs: seqs.map(protein), StringType())(seq)
