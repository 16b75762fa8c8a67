"""Streaming counts of canonical pairs: the same aggregation over a stream, with a watermark where it has event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).agg(F.count("*").alias("v"))


def windowed_counts(pairs: DataFrame, time: str, width: str, late: str) -> DataFrame:
    """Counts by window; rows later than the watermark are left out and state is dropped behind it."""
    return pairs.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).agg(F.count("*").alias("v"))


def run_once(counts: DataFrame, path: str, checkpoint: str, mode: str = "complete") -> None:
    """All that has arrived, once; the checkpoint folder makes the next run go on from there."""

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    counts.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
