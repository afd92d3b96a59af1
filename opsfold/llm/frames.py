"""Small DataFrame helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsfold.config import checkpoint_dir, configure


# Texts vary from a few bytes to many megabytes; small batches keep what a task holds small.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that the driver and all executors share."""
    return f"{checkpoint_dir(spark)}/opsfold-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage at storage that outlives any executor, so that later
    stages see the same rows however often their tasks are retried.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(name: str, df: DataFrame) -> str:
    """``name``, led by more underscores as long as ``df`` has a column of it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def trimmed(run):
    """``run`` for ``mapInArrow``; what its arrays took is given back when a task ends.

    Workers serve many tasks, of stages with quite different needs, and the allocators would
    otherwise keep the most that any of them has used.
    """
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass
    return task
