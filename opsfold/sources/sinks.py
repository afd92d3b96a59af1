"""Sinks: parquet writes, previews, output validation and dataset trimming."""

from __future__ import annotations

import os
import posixpath
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opsfold.config import PREVIEW_ROWS, TRIM_LIMIT
from opsfold.operators.limits import first_file_rows, first_rows, top_rows

__all__ = ["first_file_rows", "first_rows", "preview", "top_rows", "trim_dataset", "trim_frame",
           "validate_outputs", "write_bucketed", "write_counted", "write_parquet",
           "write_partitions", "TrimResult"]


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_counted(df: DataFrame, path: str, **options) -> int:
    """:func:`write_parquet`; the number of rows is taken in the writing pass."""
    seen = Observation()
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, **options)
    return seen.get["rows"]


def write_partitions(df: DataFrame, path: str, partition_by: list[str]) -> str:
    """Replace the partitions that ``df`` has rows of, and leave all others as they are.

    So one day can be run again by itself.  Rows are rebalanced by the partition columns: few files
    a partition, and a large partition is written by several tasks.
    """
    (df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    return path


def write_bucketed(df: DataFrame, table: str, path: str, by: str, buckets: int,
                   sort_by: list[str] | None = None) -> DataFrame:
    """``df`` as an external table bucketed by one column, read back from the catalog.

    Windows, aggregates and joins by that column (with or without further ones) need no shuffle of
    such a table, however many jobs share it.
    """
    writer = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, by)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def preview(df: DataFrame, n: int = PREVIEW_ROWS, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows as a DataFrame (``show`` is left to the caller).

    With ``order_by`` the preview is deterministic (top-n per partition, then a
    bounded merge of ``n`` rows per partition).
    """
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def trim_frame(df: DataFrame, limit: int = TRIM_LIMIT,
               order_by: list[str] | None = None) -> DataFrame:
    """At most ``limit`` rows of ``df``; the cap is the feature of this operator.

    Unordered (as the reference): :func:`first_rows`, exact whatever the partitions.
    With ``order_by``: :func:`top_rows`, the first ``limit`` rows in that
    (ascending, nulls first) order, with no task holding more than one
    order bucket.
    """
    if order_by:
        return top_rows(df, limit, order_by)
    return first_rows(df, limit)


@dataclass(frozen=True)
class TrimResult:
    source: str
    target: str | None
    status: str  # "trimmed" or "skipped"
    original_rows: int
    kept_rows: int


def qualified(spark: SparkSession, path: str) -> str:
    """The path as its file system names it: scheme, authority, no ``.``, ``..`` or double slashes."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = fs.makeQualified(p).toUri().normalize()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{posixpath.normpath(uri.getPath())}"


def trim_dataset(spark: SparkSession, source: str, target: str, limit: int = TRIM_LIMIT,
                 order_by: list[str] | None = None, fmt: str = "parquet",
                 mode: str = "errorifexists") -> TrimResult:
    """Copy at most ``limit`` rows of ``source`` to ``target``.

    Never writes to the path it reads, nor above or below it, however the two
    are spelled.  A dataset already within the limit is left untouched and
    reported as ``skipped``.  Unordered trims of parquet read only the files
    they keep rows of.
    """
    a, b = qualified(spark, source) + "/", qualified(spark, target) + "/"
    if a.startswith(b) or b.startswith(a):
        raise ValueError("trim_dataset never overwrites its input; choose another target")
    df = spark.read.format(fmt).load(source)
    original = df.count()
    if original <= limit:
        return TrimResult(source, None, "skipped", original, original)
    if fmt == "parquet" and not order_by:
        kept = first_file_rows(spark, source, limit)
    else:
        kept = trim_frame(df, limit, order_by)
    seen = Observation()
    counted = kept.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode(mode).format(fmt).save(target)
    return TrimResult(source, target, "trimmed", original, seen.get["rows"])


def validate_outputs(spark: SparkSession, root: str,
                     expected: dict[str, list[str]]) -> list[dict]:
    """Read each output under ``root``, check its columns and that it is non-empty."""
    report = []
    for name, columns in expected.items():
        path = os.path.join(root, name)
        entry = {"output": name, "path": path, "exists": False, "columns_ok": False,
                 "non_empty": False}
        try:
            df = spark.read.parquet(path)
        except Exception as exc:  # missing path or unreadable footer
            entry["error"] = str(exc).splitlines()[0]
            report.append(entry)
            continue
        entry["exists"] = True
        entry["columns_ok"] = set(columns) <= set(df.columns)
        entry["non_empty"] = df.limit(1).count() > 0
        report.append(entry)
    return report
