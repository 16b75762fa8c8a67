"""Tables that loops and later steps read: Parquet in the shared folder, so that no executor is needed again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset, a local master gets a temporary folder; on a cluster
    executors would not see it, so it is an error."""
    jsc = spark.sparkContext._jsc.sc()
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not jsc.getCheckpointDir().isDefined():
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quillon-"))
        base = jsc.getCheckpointDir().get()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def dropped(df: DataFrame) -> None:
    """Delete a table that stored() wrote and that nothing reads any more."""
    spark = df.sparkSession
    for folder in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
