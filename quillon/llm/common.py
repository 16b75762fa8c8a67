"""What several operators share: reading, hashing, checkpointed tables and map-side helpers.

Conventions of every operator of this subpackage: the caller names the id and the text column, other columns are
dropped before any column is added, so they cannot clash; a null text is an empty text unless a docstring says
otherwise; a null id is carried through; each input row gives a row of its own, repeated ids included.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The bytes that end a word where words are told apart by ASCII white space.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: A-Z lowered, every other character kept.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only the named columns, as doc_id, text and their own names."""
    bounded(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more
    )


def bounded(spark: SparkSession) -> None:
    """Texts are long rows: unless the caller has set another size, Arrow batches have a thousand rows, not ten thousand."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def work_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share. Where that is unset, a local master (as in tests)
    gets a temporary folder; on a cluster it is an error."""
    jsc = spark.sparkContext._jsc.sc()
    base = spark.conf.get("spark.checkpoint.dir", None) or (
        jsc.getCheckpointDir().get() if jsc.getCheckpointDir().isDefined() else None
    )
    if base is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quillon-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "t", narrow: bool = False) -> DataFrame:
    """df written as a Parquet table in the shared folder and read again: it cuts the lineage and outlives executors.

    narrow: a table of a few numbers a row; it is written by four tasks a core at most, for it needs no more files.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}"
    if narrow:
        df = df.coalesce(4 * spark.sparkContext.defaultParallelism)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table that stored() wrote and that nothing reads any more."""
    spark = df.sparkSession
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def released(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files that no live DataFrame needs; what is needed later is in a table by now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_HELD: dict[str, dict] = {}


def tidy() -> None:
    """Give memory that a Python worker does not use back to the system: Arrow's pool and the C library keep what was freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


def held_for(name: str = "") -> dict:
    """What a Python worker keeps from task to task for one operator (models, remembered words). Workers outlive operators:
    whoever asks next makes the others' part go, so that a stage is not charged with what the one before it knew."""
    for k in [k for k in _HELD if k != name]:
        del _HELD[k]
    tidy()
    return _HELD.setdefault(name, {}) if name else {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Hashes(dict):
    """word (bytes) -> 64-bit hash, remembered for at most `most` words."""

    def __init__(self, most: int = 400_000, seed: int = 0):
        super().__init__()
        self.most, self.seed = most, seed

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z lowered; bytes.lower() leaves all but ASCII alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def mapped(df: DataFrame, row: Callable[[tuple], tuple], schema: str, setup: Callable[[], object] | None = None, keeps: bool = False) -> DataFrame:
    """row(state, *values) of every row, batch by batch; setup() runs once in each task. keeps: setup() uses held_for() itself."""
    out = pa_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            held_for()
        state = setup() if setup else None
        for batch in batches:
            for lo, hi in pieces(batch):
                columns = [c.slice(lo, hi - lo).to_pylist() for c in batch.columns]
                rows = [row(state, *values) for values in zip(*columns, strict=True)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out
                    )
        tidy()

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about `most` bytes each, one row at least: bounds what a task holds as Python objects."""
    n = batch.num_rows
    if not n:
        return
    each = max(1, int(n * most / max(batch.nbytes, 1)))
    for lo in range(0, n, each):
        yield lo, min(n, lo + each)


def pa_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
