"""Parquet files with INT64 nanosecond timestamps.

Spark's own writer has no nanosecond type, so tasks write the files through Arrow, one each.  Spark
reads such a column as bigint nanoseconds (``nanosAsLong``), which the loader normalises.
"""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsfold.sources.sinks import qualified


def write_nanos(df: DataFrame, path: str, nanos: str) -> int:
    """Write ``df`` below ``path`` with the bigint column ``nanos`` as a nanosecond timestamp.

    A task's file has the number of its partition in its name and appears under it only when it is
    complete, so a repeated task replaces the file by the same rows.  Returns the rows written.
    """
    spark = df.sparkSession
    root = qualified(spark, path).replace("file:///", "/")
    names = df.columns

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(root)
        store.create_dir(folder)
        task = TaskContext.get()
        final = f"{folder}/part-{task.partitionId():05d}.parquet"
        draft = f"{folder}/_draft-{task.partitionId():05d}-{task.taskAttemptId()}"
        writer, rows = None, 0
        for batch in batches:
            columns = [batch.column(i).cast(pa.timestamp("ns")) if c == nanos else batch.column(i)
                       for i, c in enumerate(names)]
            table = pa.Table.from_arrays(columns, names=names)
            if writer is None:
                writer = pq.ParquetWriter(draft, table.schema, filesystem=store, version="2.6")
            writer.write_table(table)
            rows += batch.num_rows
        if writer is not None:
            writer.close()
            store.move(draft, final)
        yield pa.RecordBatch.from_arrays([pa.array([rows])], names=["rows"])

    return df.mapInArrow(run, "rows long").agg(F.sum("rows")).first()[0] or 0
