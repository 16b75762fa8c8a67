"""Binary alignment files as a data source: split at any byte, ordered, by region; and a writer of sorted parts.

A file is a chain of compressed blocks, and a record may begin and end anywhere in the stream that they hold. A split
begins at the first block at or after its offset whose successor is a block too, and at the first place in it where a
chain of records fits the header's references. Every record belongs to the split in which its first byte's block begins,
so files of any size are read in parallel without an index.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .files import Attempt, Written, cleared, committed, emptied, listed, located, vacant

#: Fixed values of the format.
MAGIC, BLOCK_MAGIC = b"BAM\1", b"\x1f\x8b\x08\x04"
LAST_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BASES, OPERATIONS = b"=ACMGRSVTWYHKDBN", "MIDNSHP=X"
FIXED = struct.Struct("<iiiBBHHHiiii")
WHOLE = {"c": "b", "C": "B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}

SCHEMA = (
    "file string, file_pos long, qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, "
    "seq string, qual string, tags array<string>"
)
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]
SPLIT = 8 << 20  # compressed bytes of a split
BATCH = 4096  # records of a batch
CHAIN = 10  # records in a row that make a place a record's start
BLOCK = 65_280  # bytes that the writer compresses at once
SPREAD = 1 << 16  # largest block


def block_size(head: bytes) -> int:
    """Bytes of the block that begins with these, 0 if none does."""
    if len(head) < 18 or head[:4] != BLOCK_MAGIC:
        return 0
    extra, at = struct.unpack_from("<H", head, 10)[0], 12
    while at + 4 <= min(12 + extra, len(head)):
        name, size = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if name == b"BC" and size == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return 0


class Blocks:
    """Blocks of a file from an offset on: (offset, content) one by one."""

    def __init__(self, file, size: int, offset: int = 0):
        self.file, self.size, self.offset = file, size, offset

    def next(self) -> tuple[int, bytes] | None:
        if self.offset >= self.size:
            return None
        raw = self.file.read_at(min(SPREAD, self.size - self.offset), self.offset)
        n = block_size(raw)
        if not n or n > len(raw):
            raise ValueError(f"no whole block at byte {self.offset}")
        head = 12 + struct.unpack_from("<H", raw, 10)[0]
        content = zlib.decompress(raw[head : n - 8], -15)
        if zlib.crc32(content) != struct.unpack_from("<I", raw, n - 8)[0]:
            raise ValueError(f"the block at byte {self.offset} is damaged")
        at, self.offset = self.offset, self.offset + n
        return at, content


def first_block(file, size: int, offset: int) -> int:
    """Offset of the first block at or after a byte: it is followed by another one or by the end."""
    raw = file.read_at(min(3 * SPREAD, size - offset), offset)
    at = raw.find(BLOCK_MAGIC)
    while 0 <= at < SPREAD:
        n = block_size(raw[at : at + 64])
        if n and (offset + at + n == size or block_size(raw[at + n : at + n + 64])):
            return offset + at
        at = raw.find(BLOCK_MAGIC, at + 1)
    return size


@dataclass
class Header:
    text: str
    references: list[tuple[str, int]]
    block: int  # the first record's block, and its place in there
    place: int

    @property
    def order(self) -> str:
        found = re.search(r"^@HD\t.*?\bSO:(\w+)", self.text, re.M)
        return found[1] if found else "unknown"


def order_of(file, size: int) -> str:
    """The order that the header's first line tells; the references are not read for it."""
    data = Blocks(file, size).next() if size else None
    data = data[1] if data else b""
    end = data.find(b"\n", 8)
    if data[:4] != MAGIC or data[8:12] != b"@HD\t" or not 8 <= end < 8 + struct.unpack_from("<i", data, 4)[0]:
        return header_of(file, size).order
    return Header(data[8:end].decode(), [], 0, 0).order


#: Headers that a worker's tasks have read; the splits of a file follow each other.
_KEPT: dict[tuple, Header] = {}


def kept_header(fs, path: str, file, size: int) -> Header:
    """The header of a file, read once for the splits of it that a worker reads one after another."""
    key = (path, size, fs.get_file_info(path).mtime_ns)
    if key not in _KEPT:
        while len(_KEPT) > 1:
            del _KEPT[next(iter(_KEPT))]
        _KEPT[key] = header_of(file, size)
    return _KEPT[key]


def header_of(file, size: int) -> Header:
    blocks, data, starts = Blocks(file, size), bytearray(), []

    def need(n: int) -> None:
        nonlocal data
        while len(data) < n:
            got = blocks.next()
            if got is None:
                raise ValueError("the header ends too early")
            starts.append((len(data), got[0]))
            data += got[1]

    need(8)
    if data[:4] != MAGIC:
        raise ValueError("not a binary alignment file")
    n = struct.unpack_from("<i", data, 4)[0]
    need(12 + n)
    text, count, at = data[8 : 8 + n].rstrip(b"\0").decode(), struct.unpack_from("<i", data, 8 + n)[0], 12 + n
    references = []
    for _ in range(count):
        need(at + 4)
        m = struct.unpack_from("<i", data, at)[0]
        need(at + 8 + m)
        references.append((data[at + 4 : at + 3 + m].decode(), struct.unpack_from("<i", data, at + 4 + m)[0]))
        at += 8 + m
    inside = [(s, b) for s, b in starts if s <= at]
    if at == len(data):  # the first record is in the next block
        return Header(text, references, blocks.offset, 0)
    return Header(text, references, inside[-1][1], at - inside[-1][0])


def plausible(data: bytes, at: int, references: list[tuple[str, int]]) -> int:
    """Where the record at this place ends, if there can be one; -1 if not; 0 if more bytes are needed to tell."""
    if at + 36 > len(data):
        return 0
    size, ref, pos, name, _, _, ops, _, bases, ref2, pos2, _ = FIXED.unpack_from(data, at)
    n = len(references)
    if not (-1 <= ref < n and -1 <= ref2 < n and pos >= -1 and pos2 >= -1 and name >= 1 and bases >= 0):
        return -1
    if size < 32 + name + 4 * ops + (bases + 1) // 2 + bases or (ref >= 0 and pos > references[ref][1]) or (ref2 >= 0 and pos2 > references[ref2][1]):
        return -1
    own = data[at + 36 : at + 36 + name]
    if len(own) < name:
        return 0
    if own[-1] or any(not 33 <= c <= 126 for c in own[:-1]):
        return -1
    return at + 4 + size


class Stream:
    """The bytes of blocks from one on, as far as they are asked for, and the block of every place."""

    def __init__(self, blocks: Blocks):
        self.blocks, self.data, self.starts, self.ended = blocks, bytearray(), [], False

    def more(self) -> bool:
        got = None if self.ended else self.blocks.next()
        if got is None:
            self.ended = True
            return False
        self.starts.append((len(self.data), got[0]))
        self.data += got[1]
        return True

    def first_record(self, references: list[tuple[str, int]]) -> int | None:
        """The first place where a chain of records begins; None if there is none up to the end."""
        at = 0
        while True:
            if at >= len(self.data) and not self.more():
                return None
            place, chained = at, 0
            while chained < CHAIN:
                end = plausible(self.data, place, references)
                if end == 0 or end > len(self.data):
                    if self.more():
                        continue
                    break
                if end < 0:
                    break
                place, chained = end, chained + 1
            if chained == CHAIN or (chained and place == len(self.data) and self.ended):
                return at
            at += 1

    def cut(self, at: int) -> None:
        """Forget the bytes before a place."""
        del self.data[:at]
        self.starts = [(s - at, b) for s, b in self.starts]
        while len(self.starts) > 1 and self.starts[1][0] <= 0:
            del self.starts[0]


@dataclass
class Split(InputPartition):
    path: str
    size: int
    start: int
    end: int

    def __init__(self, path: str, size: int, start: int, end: int):
        super().__init__((path, start))
        self.path, self.size, self.start, self.end = path, size, start, end


def tags_of(data: bytes, at: int, end: int) -> list[str]:
    out = []
    while at < end:
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind == "A":
            out.append(f"{name}:A:{chr(data[at])}")
            at += 1
        elif kind in "ZH":
            stop = data.index(0, at)
            out.append(f"{name}:{kind}:{data[at:stop].decode()}")
            at = stop + 1
        elif kind == "B":
            own, n = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            one = struct.Struct(f"<{n}{WHOLE[own][-1]}")
            values = one.unpack_from(data, at + 5)
            out.append(f"{name}:B:{own}" + "".join(f",{v:g}" if own == "f" else f",{v}" for v in values))
            at += 5 + one.size
        else:
            one = struct.Struct(WHOLE[kind])
            v = one.unpack_from(data, at)[0]
            out.append(f"{name}:f:{v:g}" if kind == "f" else f"{name}:i:{v}")
            at += one.size
    return out


_DIGITS = str.maketrans("0123456789abcdef", BASES.decode())
_UP33, _DOWN33 = (bytes((i + d) % 256 for i in range(256)) for d in (33, -33))
#: Different cigars and tags whose other form a worker keeps; most records repeat one.
REPEATS = 1 << 14


def sequence_of(raw: bytes, n: int) -> str:
    return raw.hex().translate(_DIGITS)[:n] if n else "*"


@lru_cache(REPEATS)
def cigar_of(raw: bytes) -> str:
    return "".join(f"{x >> 4}{OPERATIONS[x & 15]}" for x in struct.unpack(f"<{len(raw) // 4}I", raw)) or "*"


@lru_cache(REPEATS)
def _short_tags(raw: bytes) -> list[str]:
    return tags_of(raw, 0, len(raw))


def span_of(data: bytes, at: int, ops: int) -> int:
    """Reference bases that the operations cover."""
    return sum(x >> 4 for x in struct.unpack_from(f"<{ops}I", data, at) if (x & 15) in (0, 2, 3, 7, 8))


class BamReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = [f.name for f in schema.fields]
        unknown = set(self.names) - set(NAMES)
        if unknown:
            raise ValueError(f"no such fields: {', '.join(sorted(unknown))}")
        from pyspark.sql.pandas.types import to_arrow_schema

        self.schema = to_arrow_schema(schema)
        self.uri, self.order, self.region = options["path"], options.get("order", ""), options.get("region", "")
        self.split = int(options.get("splitbytes", SPLIT))

    def partitions(self) -> list[Split]:
        fs, _ = located(self.uri)
        out = []
        for path, size in listed(self.uri, ".bam"):
            with fs.open_input_file(path) as file:
                order = order_of(file, size)
                if self.order and order != self.order:
                    raise ValueError(f"{path} is in the order {order}, not {self.order}")
                own = [Split(path, size, lo, min(lo + self.split, size)) for lo in range(0, size, self.split)]
                out += self._of_region(file, header_of(file, size), own) if self.region else own
        return out

    def asked(self, references: list[tuple[str, int]]) -> tuple[int, int, int]:
        """Number of the region's reference, and its first place and end (from 0)."""
        found = re.fullmatch(r"(.+?)(?::(\d+)-(\d+))?", self.region)
        names = [n for n, _ in references]
        name, lo, hi = (self.region, None, None) if self.region in names else found.groups()
        if name not in names:
            raise ValueError(f"no reference {name}")
        ref = names.index(name)
        return ref, int(lo) - 1 if lo else 0, int(hi) if hi else references[ref][1]

    def _of_region(self, file, header: Header, own: list[Split]) -> list[Split]:
        """Splits that may hold records of the region: their first records are looked up by bisection."""
        if header.order != "coordinate":
            raise ValueError("regions need files in the order coordinate")
        ref, _, hi = self.asked(header.references)

        def place(split: Split) -> tuple[int, int]:
            """Reference and position of the first record at or after the split's start; unmapped ones come last."""
            for data, at, _ in records(file, Split(split.path, split.size, split.start, split.size), header):
                r, p = struct.unpack_from("<ii", data, at + 4)
                return (r if r >= 0 else len(header.references), p)
            return (len(header.references), 0)

        def first(test) -> int:
            lo, end = 0, len(own)
            while lo < end:
                mid = (lo + end) // 2
                lo, end = (lo, mid) if test(place(own[mid])) else (mid + 1, end)
            return lo

        begin, end = first(lambda x: x >= (ref, -1)), first(lambda x: x >= (ref, hi))
        return own[max(begin - 1, 0) : end]

    def read(self, partition: Split | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there is no split at all
            return
        fs, _ = located(self.uri)
        with fs.open_input_file(partition.path) as file:
            header = kept_header(fs, partition.path, file, partition.size)
            region = self.asked(header.references) if self.region else None
            rows: list[tuple] = []
            before = (-2, -2)
            for data, at, voffset in records(file, partition, header):
                ref, pos = struct.unpack_from("<ii", data, at + 4)
                if self.order == "coordinate":
                    now = (ref if ref >= 0 else len(header.references), pos)
                    if now < before:
                        raise ValueError(f"{partition.path}: records are not in the order coordinate")
                    before = now
                if region is not None:
                    if ref > region[0] or ref < 0 or (ref == region[0] and pos >= region[2]):
                        break  # what follows lies further on
                    if ref < region[0]:
                        continue
                    name, ops = data[at + 12], struct.unpack_from("<H", data, at + 16)[0]
                    if pos + max(1, span_of(data, at + 36 + name, ops)) <= region[1]:
                        continue
                rows.append(self.row(data, at, header.references, partition.path, voffset))
                if len(rows) == BATCH:
                    yield self.batch(rows)
                    rows = []
            if rows:
                yield self.batch(rows)

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), self.schema, strict=True)], schema=self.schema)

    def row(self, data: bytes, at: int, references: list[tuple[str, int]], path: str, voffset: int) -> tuple:
        """The fields that are asked for; the others are not decoded."""
        size, ref, pos, n, mapq, _, ops, flag, bases, ref2, pos2, tlen = FIXED.unpack_from(data, at)
        cigar = at + 36 + n
        seq = cigar + 4 * ops
        qual = seq + (bases + 1) // 2
        out = []
        for f in self.names:
            if f == "qname":
                out.append(data[at + 36 : cigar - 1].decode())
            elif f == "flag":
                out.append(flag)
            elif f == "rname":
                out.append(references[ref][0] if ref >= 0 else "*")
            elif f == "pos":
                out.append(pos + 1)
            elif f == "mapq":
                out.append(mapq)
            elif f == "cigar":
                raw = bytes(data[cigar:seq])
                out.append(cigar_of(raw) if len(raw) <= 64 else cigar_of.__wrapped__(raw))
            elif f == "rnext":
                out.append("*" if ref2 < 0 else "=" if ref2 == ref else references[ref2][0])
            elif f == "pnext":
                out.append(pos2 + 1)
            elif f == "tlen":
                out.append(tlen)
            elif f == "seq":
                out.append(sequence_of(bytes(data[seq:qual]), bases))
            elif f == "qual":
                raw = bytes(data[qual : qual + bases])
                out.append("*" if not raw or raw[0] == 255 else raw.translate(_UP33).decode("latin-1"))
            elif f == "tags":
                raw = bytes(data[qual + bases : at + 4 + size])
                out.append(_short_tags(raw) if len(raw) <= 64 else tags_of(raw, 0, len(raw)))
            elif f == "file":
                out.append(path)
            else:
                out.append(voffset)
        return tuple(out)


def records(file, split: Split, header: Header) -> Iterator[tuple[bytearray, int, int]]:
    """(bytes, place, virtual offset) of the records whose first byte's block begins in the split."""
    first = header.block if split.start <= header.block else first_block(file, split.size, split.start)
    if first >= split.end:
        return
    stream = Stream(Blocks(file, split.size, first))
    if first == header.block:
        while len(stream.data) < header.place and stream.more():
            pass
        at = header.place
    else:
        found = stream.first_record(header.references)
        if found is None:
            return
        at = found
    block = 0
    while True:
        while at + 4 > len(stream.data) or at + 4 + struct.unpack_from("<i", stream.data, at)[0] > len(stream.data):
            if not stream.more():
                if at < len(stream.data):
                    raise ValueError(f"{split.path} ends within a record")
                return
        while block + 1 < len(stream.starts) and stream.starts[block + 1][0] <= at:
            block += 1
        start, offset = stream.starts[block]
        if offset >= split.end:
            return
        yield stream.data, at, offset << 16 | (at - start)
        at += 4 + struct.unpack_from("<i", stream.data, at)[0]
        if at > 4 << 20:
            stream.cut(at)
            at, block = 0, 0


def bin_of(lo: int, hi: int) -> int:
    """The smallest bin of the format's binning scheme that holds places lo to hi."""
    hi -= 1
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if lo >> shift == hi >> shift:
            return first + (lo >> shift)
    return 0


def tag_bytes(tag: str) -> bytes:
    name, kind, value = tag.split(":", 2)
    head = name.encode()
    if kind == "A":
        return head + b"A" + value.encode()
    if kind in "ZH":
        return head + kind.encode() + value.encode() + b"\0"
    if kind == "f":
        return head + b"f" + struct.pack("<f", float(value))
    if kind == "B":
        own, *values = value.split(",")
        code = WHOLE[own][-1]
        return head + b"B" + own.encode() + struct.pack(f"<i{len(values)}{code}", len(values), *[float(v) if own == "f" else int(v) for v in values])
    return head + (b"i" + struct.pack("<i", int(value)) if -(1 << 31) <= int(value) < 1 << 31 else b"I" + struct.pack("<I", int(value)))


_NIBBLE = bytearray([15]) * 256
for _i, _c in enumerate(BASES):
    _NIBBLE[_c] = _NIBBLE[ord(chr(_c).lower())] = _i


def _cigar_bytes(cigar: str) -> tuple[bytes, int, int]:
    """The operations, how many they are, and the reference bases that they cover."""
    ops = [] if cigar == "*" else [(int(n) << 4) | OPERATIONS.index(c) for n, c in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]
    return struct.pack(f"<{len(ops)}I", *ops), len(ops), sum(x >> 4 for x in ops if (x & 15) in (0, 2, 3, 7, 8))


_short_cigar, _short_tag = lru_cache(REPEATS)(_cigar_bytes), lru_cache(REPEATS)(tag_bytes)


def packed(sequences: list[str]) -> Iterator[bytes]:
    """Two bases a byte, of all sequences in one pass; each begins with a byte of its own."""
    own = ["" if s == "*" else s for s in sequences]
    codes = np.frombuffer("".join(s + "=" * (len(s) % 2) for s in own).encode().translate(_NIBBLE), np.uint8)
    both, at = (codes[0::2] << 4 | codes[1::2]).tobytes(), 0
    for s in own:
        end = at + (len(s) + 1) // 2
        yield both[at:end]
        at = end


def plain_values(column: pa.Array) -> list:
    """As to_pylist(), which is slow value by value; without nulls numpy does it at once."""
    return column.to_pylist() if column.null_count else column.to_numpy(zero_copy_only=False).tolist()


def records_bytes(batch: pa.RecordBatch, numbers: dict[str, int]) -> Iterator[bytes]:
    columns = [plain_values(batch[c]) for c in ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")]
    tags = batch["tags"]
    if tags.null_count:
        columns.append(tags.to_pylist())
    else:
        flat, ends = plain_values(tags.values), tags.offsets.to_numpy().tolist()
        columns.append([flat[lo:hi] for lo, hi in zip(ends, ends[1:], strict=False)])
    for qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual, tags, bases in zip(*columns, packed(columns[9]), strict=True):
        name, n = qname.encode() + b"\0", 0 if seq == "*" else len(seq)
        ops, count, span = (_short_cigar if len(cigar) <= 64 else _cigar_bytes)(cigar)
        quality = b"\xff" * n if qual == "*" else qual.encode().translate(_DOWN33)
        extra = b"".join([(_short_tag if len(t) <= 64 else tag_bytes)(t) for t in tags or ()])
        ref, pos = numbers[rname], pos - 1
        ref2 = ref if rnext == "=" else numbers[rnext]
        size = 32 + len(name) + len(ops) + len(bases) + len(quality) + len(extra)
        yield FIXED.pack(size, ref, pos, len(name), mapq, bin_of(pos, pos + max(span, 1)) if pos >= 0 else 4680, count, flag, n, ref2, pnext - 1, tlen)
        yield b"".join((name, ops, bases, quality, extra))


def block_bytes(content: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    raw = c.compress(content) + c.flush()
    return BLOCK_MAGIC + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(raw) + 25) + raw + struct.pack("<II", zlib.crc32(content), len(content))


class BamWriter(DataSourceArrowWriter):
    """Each task writes a whole file of its own, in the order of its rows."""

    def __init__(self, options: dict, overwrite: bool):
        self.uri, self.order = options["path"], options.get("order", "unknown")
        self.references = [(n, int(m)) for n, m in json.loads(options["references"])]
        (emptied if overwrite else vacant)(self.uri)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        numbers = {n: k for k, (n, _) in enumerate(self.references)} | {"*": -1}
        text = f"@HD\tVN:1.6\tSO:{self.order}\n" + "".join(f"@SQ\tSN:{n}\tLN:{m}\n" for n, m in self.references)
        head = MAGIC + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(self.references))
        waiting = bytearray(head + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", m) for n, m in self.references))
        attempt, name = Attempt(self.uri), f"part-{TaskContext.get().partitionId():05d}.bam"
        with attempt.opened(name) as out:
            for batch in iterator:
                for raw in records_bytes(batch, numbers):
                    waiting += raw
                while len(waiting) >= BLOCK:
                    out.write(block_bytes(bytes(waiting[:BLOCK])))
                    del waiting[:BLOCK]
            if waiting:
                for lo in range(0, len(waiting), BLOCK):
                    out.write(block_bytes(bytes(waiting[lo : lo + BLOCK])))
            out.write(LAST_BLOCK)
        return Written(attempt.folder, (name,))

    def commit(self, messages: list[Written | None]) -> None:
        committed(self.uri, messages)

    def abort(self, messages: list[Written | None]) -> None:
        cleared(self.uri)


class Bam(DataSource):
    """spark.read.format("bam"): options order (an error unless the header says so), region (name or name:first-last, for
    coordinate order) and splitBytes; a schema of fewer fields decodes no others."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> BamReader:
        return BamReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> BamWriter:
        return BamWriter(self.options, overwrite)


def bam(spark: SparkSession, path: str, order: str | None = None, region: str | None = None, fields: str | None = None, split: int = SPLIT) -> DataFrame:
    """Alignment records of a file or a folder of files; file_pos is a record's virtual offset in its file.

    fields: a schema string of those to decode. Missing values are as in the text format: * and 0.
    """
    spark.dataSource.register(Bam)
    r = spark.read.format("bam").option("splitBytes", split)
    for k, v in (("order", order), ("region", region)):
        r = r.option(k, v) if v else r
    return (r.schema(fields) if fields else r).load(path)


def bam_header(spark: SparkSession, path: str) -> DataFrame:
    """refid, name and length of the references, of the first file."""
    fs, _ = located(path)
    name, size = listed(path, ".bam")[0]
    with fs.open_input_file(name) as file:
        references = header_of(file, size).references
    return spark.createDataFrame([(k, n, m) for k, (n, m) in enumerate(references)], "refid int, name string, length long")


def mapped(spark: SparkSession, path: str, fields: str | None = None) -> DataFrame:
    """All mapped records of files in coordinate order, each file's in that order."""
    return bam(spark, path, "coordinate", fields=fields).where(F.col("flag").bitwiseAND(F.lit(4)) == 0)


def write_bam(df: DataFrame, path: str, references: DataFrame, order: str = "queryname", mode: str = "errorifexists") -> None:
    """Records as files in the order queryname or coordinate: rows are range-partitioned, each task sorts its own and
    writes a file, and files appear when all tasks are done. references (name, length) go into every file's header, so
    they are collected; the order of names is that of their bytes."""
    listed_ = [(r.name, r.length) for r in references.select("name", F.col("length").cast("long").alias("length")).orderBy("name").collect()]
    spark = df.sparkSession
    spark.dataSource.register(Bam)
    if order == "queryname":
        keys = ["qname", "flag"]
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    elif order == "coordinate":
        unmapped, name = F.col("rname") == "*", F.col("rname")
        keys = [unmapped, name, F.col("pos"), F.col("qname")]
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    fields = [n for n in NAMES if n not in ("file", "file_pos")]
    df.select(*fields).write.format("bam").option("references", json.dumps(listed_)).option("order", order).mode("overwrite" if mode == "overwrite" else "append").save(path)
