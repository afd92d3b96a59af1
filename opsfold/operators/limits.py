"""Exact row limits without a single-task merge.

``df.limit(n)`` and ``orderBy(...).limit(n)`` let every task send up to ``n``
rows to one final task, which does not hold when ``n`` is large and the input
has many thousands of partitions.  All operators here find a cut in a small
table of counts and keep the rows before it where they lie.  The cut is a
property of the rows (a hash, an order bucket, a place in a file), never of the
partitions a job happens to see.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from opsfold.operators.scan import DEFAULT_TARGET_ROWS, assign_chunks

HASH_GROUPS = 4096
# A group of at most this many rows is ranked in one window partition.
RANKED_ROWS = 100_000


def _cut(sizes: DataFrame, group: str, limit: int) -> Row | None:
    """The group where the running row total reaches ``limit``, and how many of
    its rows to take; None when all groups together hold fewer rows.

    ``sizes`` has one row per group (``group``, ``_n``), so the running sum
    runs over that small table, and one row comes back to the driver.
    """
    before = F.coalesce(F.sum("_n").over(
        Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (sizes.withColumn("_before", before)
            .where((F.col("_before") < limit) & (F.col("_before") + F.col("_n") >= limit))
            .select(F.col(group).alias("group"), F.col("_n").alias("rows"),
                    (F.lit(limit) - F.col("_before")).alias("take"))
            .first())


def first_rows(df: DataFrame, limit: int) -> DataFrame:
    """Exactly ``min(limit, rows)`` rows of ``df``, the ones of least row hash.

    Rows are counted by a digit of their hash, the groups before the cut are
    taken whole, and the group at the cut is ranked if it is small, or counted
    by the next digit.  What is left after the last digit are copies of one row,
    of which the right number is made.  The choice depends on the rows alone, so
    jobs that see different partitions agree.  Each count is a partial aggregate
    of at most ``HASH_GROUPS`` rows; only the small group at the cut is shuffled.
    """
    if limit <= 0:
        return df.limit(0)
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    tagged, bits = df.withColumn("_h", h), HASH_GROUPS.bit_length() - 1
    kept, prefix, left = [], F.lit(True), limit
    for shift in [*range(64 - bits, 0, -bits), 0]:
        digit = F.shiftright("_h", shift)  # signed: the first digit keeps the sign
        rows = tagged.where(prefix)
        sizes = rows.groupBy(digit.alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
        cut = _cut(sizes, "_g", left)
        if cut is None:  # fewer rows than the limit
            return df
        kept.append(prefix & (digit < cut["group"]))
        prefix, left = digit == cut["group"], cut["take"]
        if cut["rows"] <= RANKED_ROWS:
            rank = F.row_number().over(Window.partitionBy(digit).orderBy("_h"))
            edge = tagged.where(prefix).withColumn("_rank", rank).where(F.col("_rank") <= left)
            break
    else:
        edge = (tagged.where(prefix).limit(1)
                .withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(left).cast("long")))))
    whole = reduce(or_, kept)
    return tagged.where(whole).select(df.columns).unionAll(edge.select(df.columns))


def first_file_rows(spark: SparkSession, path: str, limit: int) -> DataFrame:
    """Exactly ``min(limit, rows)`` rows of a parquet dataset: whole files in path order up
    to the cut, and the first rows of the file at the cut.

    Rows are counted per file (parquet footers, no columns) and placed by
    ``_metadata.row_index``, so neither depends on how files are split; only the
    files that give rows are read.
    """
    df = spark.read.parquet(path)
    if limit <= 0:
        return df.limit(0)
    sizes = (df.groupBy(F.col("_metadata.file_path").alias("_f"))
             .agg(F.count(F.lit(1)).alias("_n")))
    cut = _cut(sizes, "_f", limit)
    if cut is None:
        return df
    # Files before the cut hold less than ``limit`` rows, so their list is bounded by it.
    file = F.col("_metadata.file_path")
    last = (file == cut["group"]) & (F.col("_metadata.row_index") < cut["take"])
    return df.where((file < cut["group"]) | last)


def top_rows(df: DataFrame, limit: int, order_by: list[str], *,
             target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """The first ``limit`` rows in ascending, nulls-first ``order_by`` order.

    Rows are cut into order buckets of about ``target_rows`` rows by the
    skew-safe scan's deterministic split points (every row of bucket ``i``
    sorts before every row of bucket ``i + 1``; exact ties are broken by a
    hash of the whole row).  Rows per bucket are counted, the bucket where the
    running total reaches ``limit`` is found, and the buckets before it are
    kept whole.  Only that one bucket is ranked, in one window partition of
    about ``target_rows`` rows.  The result is a set of rows, not sorted.
    """
    if limit <= 0:
        return df.limit(0)
    keyed = df.withColumn("_all", F.lit(0))
    chunked, _ = assign_chunks(keyed, ["_all"], list(order_by), target_rows=target_rows)
    sizes = chunked.groupBy("_sub").agg(F.count(F.lit(1)).alias("_n"))
    cut = _cut(sizes, "_sub", limit)
    if cut is None:  # fewer rows than the limit
        return df
    whole = chunked.where(F.col("_sub") < cut["group"])
    order = [F.col(c).asc_nulls_first() for c in [*order_by, "_tb"]]
    rank = F.row_number().over(Window.partitionBy("_sub").orderBy(*order))
    edge = (chunked.where(F.col("_sub") == cut["group"])
            .withColumn("_rank", rank).where(F.col("_rank") <= cut["take"]).drop("_rank"))
    return whole.unionByName(edge).select(*df.columns)
