"""Sparse matrices as array archives: a data source that reads them in chunks, and a writer of parts.

An archive is a zip of arrays: data with row and col (coordinates), or data with indices and indptr (by rows or columns),
the shape and the name of the format. Members that are stored without compression are read from any place, so such a file
is split; compressed ones can only be read from their beginning and are one split each. A split holds a chunk at a time.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .files import Attempt, Written, cleared, committed, emptied, listed, located, vacant

SCHEMA = "i long, j long, v double"
CHUNK = 65_536  # entries that a split holds at a time
SPLIT = 4_000_000  # entries of a split


class Member:
    """An array of an archive, read from some entry on."""

    def __init__(self, archive: zipfile.ZipFile, name: str):
        self.file = archive.open(f"{name}.npy")
        version = np.lib.format.read_magic(self.file)
        read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        self.shape, _, self.dtype = read(self.file)
        self.begin = self.file.tell()
        self.size = int(np.prod(self.shape, dtype=np.int64))

    def seek(self, entry: int) -> Member:
        self.file.seek(self.begin + entry * self.dtype.itemsize)  # a compressed member skips by reading
        return self

    def read(self, n: int) -> np.ndarray:
        return np.frombuffer(self.file.read(n * self.dtype.itemsize), self.dtype)


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int

    def __init__(self, path: str, start: int, end: int):
        super().__init__((path, start))
        self.path, self.start, self.end = path, start, end


class NpzReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri, self.split = options["path"], int(options.get("splitentries", SPLIT))

    def partitions(self) -> list[Split]:
        fs, _ = located(self.uri)
        out = []
        for path, _ in listed(self.uri, ".npz"):
            with fs.open_input_file(path) as raw, zipfile.ZipFile(raw) as archive:
                n = Member(archive, "data").size
                names = set(archive.namelist())
                if not ({"row.npy", "col.npy"} <= names or {"indices.npy", "indptr.npy"} <= names):
                    raise ValueError(f"{path} holds no coordinates, rows or columns")
                plain = all(x.compress_type == zipfile.ZIP_STORED for x in archive.infolist())
                step = self.split if plain else max(n, 1)
                out += [Split(path, lo, min(lo + step, n)) for lo in range(0, n, step)]
        return out

    def read(self, partition: Split | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there is no entry at all
            return
        fs, _ = located(self.uri)
        with fs.open_input_file(partition.path) as raw, zipfile.ZipFile(raw) as archive:
            lo, end = partition.start, partition.end
            data = Member(archive, "data").seek(lo)
            if "row.npy" in archive.namelist():
                row, col = (Member(archive, n).seek(lo) for n in ("row", "col"))
                while lo < end:
                    n = min(CHUNK, end - lo)
                    yield batch_of(row.read(n), col.read(n), data.read(n))
                    lo += n
                return
            by_rows = bytes(np.lib.format.read_array(archive.open("format.npy")).item()) != b"csc"
            minor, edges = Member(archive, "indices").seek(lo), Member(archive, "indptr")
            # the rows of a chunk: edges are passed in chunks as well
            left, line = edges.size, 0
            ahead = edges.read(min(CHUNK, left)).astype(np.int64)
            left -= len(ahead)
            while lo < end:
                n = min(CHUNK, end - lo)
                places, major, done = np.arange(lo, lo + n), np.empty(n, np.int64), 0
                while done < n:
                    # entries below the last edge at hand can be placed
                    upto = int(np.searchsorted(places, ahead[-1])) if left else n
                    major[done:upto] = line + np.searchsorted(ahead, places[done:upto], side="right") - 1
                    done = max(done, upto)
                    if done < n:
                        line += len(ahead) - 1
                        more = edges.read(min(CHUNK, left)).astype(np.int64)
                        left -= len(more)
                        ahead = np.concatenate((ahead[-1:], more))
                other, v = minor.read(n), data.read(n)
                yield batch_of(major, other, v) if by_rows else batch_of(other, major, v)
                lo += n


def batch_of(i: np.ndarray, j: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(i.astype(np.int64)), pa.array(j.astype(np.int64)), pa.array(v.astype(np.float64))], names=["i", "j", "v"])


class NpzWriter(DataSourceArrowWriter):
    """Each task writes its entries as an archive of coordinates of its own, with the whole matrix's shape."""

    def __init__(self, options: dict, overwrite: bool):
        self.uri, self.shape = options["path"], [int(x) for x in options["shape"].split(",")]
        (emptied if overwrite else vacant)(self.uri)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in iterator]
        i, j, v = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.empty(0, np.int64),) * 3
        if len(i) and (min(i.min(), j.min()) < 0 or i.max() >= self.shape[0] or j.max() >= self.shape[1]):
            raise ValueError(f"an entry lies outside {self.shape}")
        attempt, name = Attempt(self.uri), f"part-{TaskContext.get().partitionId():05d}.npz"
        with attempt.opened(name) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
            arrays = {"row": i.astype(np.int64), "col": j.astype(np.int64), "format": np.array(b"coo"), "shape": np.array(self.shape), "data": v.astype(np.float64)}
            for key, x in arrays.items():
                held = io.BytesIO()
                np.lib.format.write_array(held, np.ascontiguousarray(x) if x.ndim else x, allow_pickle=False)
                archive.writestr(f"{key}.npy", held.getvalue())
        return Written(attempt.folder, (name,))

    def commit(self, messages: list[Written | None]) -> None:
        committed(self.uri, messages)

    def abort(self, messages: list[Written | None]) -> None:
        cleared(self.uri)


class Npz(DataSource):
    """spark.read.format("npz"): option splitEntries; writing needs the option shape (rows,columns)."""

    @classmethod
    def name(cls) -> str:
        return "npz"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> NpzReader:
        return NpzReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> NpzWriter:
        return NpzWriter(self.options, overwrite)


def npz(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """Entries (i, j, v) of an archive or of a folder of them."""
    spark.dataSource.register(Npz)
    return spark.read.format("npz").option("splitEntries", split).load(path)


def write_npz(edges: DataFrame, path: str, rows: int, columns: int, mode: str = "errorifexists") -> None:
    """Entries (i, j, v) as archives of coordinates; entries of one place stay apart, and readers add them up."""
    edges.sparkSession.dataSource.register(Npz)
    own = edges.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.col("v").cast("double").alias("v"))
    own.write.format("npz").option("shape", f"{rows},{columns}").mode("overwrite" if mode == "overwrite" else "append").save(path)
