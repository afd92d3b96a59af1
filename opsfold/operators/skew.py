"""Key-skew study: hot key, partition profile and salted two-stage aggregation.

``repartition(n, endpoint)`` sends every row of the hottest endpoint to one
partition; salting that endpoint with ``pmod(xxhash64(...), buckets)`` spreads
it over up to ``buckets`` partitions.  The rows-per-partition profile of either
layout is counted in the layout itself, made of rows of endpoint and salt only.
The two timed arms are the plain per-endpoint aggregate and the salted
two-stage one over the two layouts, each written in full to a ``noop`` sink (a
bare ``count()`` would let the optimizer drop the aggregates).
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsfold.config import DEFAULT_SALT_BUCKETS, DEFAULT_TARGET_PARTITIONS, PERCENTILE_ACCURACY
from opsfold.functions.columns import salt
from opsfold.operators.sketches import SKETCH_K, latency_sketch, percentiles_of


def hot_endpoint(logs: DataFrame, key: str = "endpoint") -> DataFrame:
    """One row: the most frequent ``key`` value, its count, the total and its share.

    Ties go to the smallest value (nulls first).  An empty input still gives one
    row, with a null key and share 0.  Two partial aggregates, no join.
    """
    counts = logs.groupBy(key).agg(F.count(F.lit(1)).alias("request_count"))
    top = F.min(F.struct((-F.col("request_count")).alias("neg"), F.col(key).alias("k")))
    one = counts.agg(top.alias("_top"), F.sum("request_count").alias("_total"))
    total = F.coalesce(F.col("_total"), F.lit(0)).cast("long")
    count = F.coalesce(-F.col("_top.neg"), F.lit(0)).cast("long")
    return one.select(
        F.col("_top.k").alias(key),
        count.alias("request_count"),
        total.alias("total_rows"),
        F.when(total > 0, count / total).otherwise(F.lit(0.0)).alias("share"),
    )


# Marks "hot key not given": None is a valid hot key (an empty input has none).
_FIND = object()


def _with_salt(logs: DataFrame, buckets: int, key: str = "endpoint",
               hot_key=_FIND) -> DataFrame:
    """Add ``salt``: hashed bucket for rows of the hot key, 0 for all others.

    Without ``hot_key`` the hot key is found inside the plan and arrives as a
    one-row broadcast.  A caller that already fetched it (the study) passes
    the value, so the data is not aggregated again to find it.
    """
    if hot_key is not _FIND:
        return logs.withColumn("salt", salt(F.coalesce(F.col(key) == F.lit(hot_key),
                                                       F.lit(False)), buckets))
    hot = hot_endpoint(logs, key).select(F.col(key).alias("_hot"))
    joined = logs.join(F.broadcast(hot), logs[key] == hot["_hot"], "left")
    return joined.withColumn("salt", salt(F.col("_hot").isNotNull(), buckets)).drop("_hot")


def endpoint_stats(logs: DataFrame, *, accuracy: int = PERCENTILE_ACCURACY,
                   with_p95: bool = True) -> DataFrame:
    """Unsalted per-endpoint count, mean latency and (optionally) p95."""
    aggs = [F.count(F.lit(1)).alias("request_count"), F.avg("latency_ms").alias("avg_latency_ms")]
    if with_p95:
        aggs.append(F.percentile_approx("latency_ms", 0.95, accuracy).alias("p95_latency_ms"))
    return logs.groupBy("endpoint").agg(*aggs)


def salted_aggregate(salted: DataFrame, *, with_p95: bool = False,
                     sketch_k: int = SKETCH_K) -> DataFrame:
    """Stage 1 per (endpoint, salt), stage 2 per endpoint.

    The mean divides by the non-null latency count, so it equals ``avg``.  With
    ``with_p95`` stage 1 keeps a latency sketch, which stage 2 merges: the p95 is
    that of the unsalted rows within the sketch's rank error, for any salt.
    """
    aggs = [F.count(F.lit(1)).alias("partial_count"),
            F.sum("latency_ms").alias("partial_latency_sum"),
            F.count("latency_ms").alias("partial_latency_n")]
    if with_p95:
        aggs.append(latency_sketch(k=sketch_k).alias("partial_sketch"))
    partial = salted.groupBy("endpoint", "salt").agg(*aggs)
    merged = partial.groupBy("endpoint").agg(
        F.sum("partial_count").alias("request_count"),
        (F.sum("partial_latency_sum") / F.nullif(F.sum("partial_latency_n"), F.lit(0)))
        .alias("avg_latency_ms"),
        *([F.kll_merge_agg_double("partial_sketch").alias("_sketch"),
           F.sum("partial_latency_n").alias("_n")] if with_p95 else []),
    )
    if not with_p95:
        return merged
    (p95,) = percentiles_of("_sketch", "_n", [0.95])
    return merged.withColumn("p95_latency_ms", p95).drop("_sketch", "_n")


def salted_endpoint_stats(logs: DataFrame, *, salt_buckets: int = DEFAULT_SALT_BUCKETS,
                          with_p95: bool = False, sketch_k: int = SKETCH_K) -> DataFrame:
    return salted_aggregate(_with_salt(logs, salt_buckets), with_p95=with_p95, sketch_k=sketch_k)


def hash_layout(logs: DataFrame, partitions: int, *, salt_buckets: int | None = None,
                hot_key=_FIND) -> DataFrame:
    """``repartition(partitions, endpoint)``, or by (endpoint, salt) with ``salt_buckets``.

    All rows of an unsalted hot endpoint land in one partition: that is the layout studied.
    """
    if salt_buckets is None:
        return logs.repartition(partitions, "endpoint")
    return (_with_salt(logs, salt_buckets, hot_key=hot_key)
            .repartition(partitions, "endpoint", "salt"))


def _profile(layout: DataFrame, phase: str) -> DataFrame:
    """Rows per non-empty partition of a layout as Spark made it: max, min, avg.

    Each partition counts its own rows; empty partitions are not counted.
    """
    per = layout.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("rows"))
    return per.agg(
        F.max("rows").alias("max_partition_rows"),
        F.min("rows").alias("min_partition_rows"),
        F.avg("rows").alias("avg_partition_rows"),
        F.count(F.lit(1)).alias("non_empty_partitions"),
    ).select(F.lit(phase).alias("phase"), "*")


def partition_skew(logs: DataFrame, *, target_partitions: int = DEFAULT_TARGET_PARTITIONS,
                   salt_buckets: int = DEFAULT_SALT_BUCKETS, hot_key=_FIND) -> DataFrame:
    """Two rows, ``before`` (hash by endpoint) and ``after`` (by endpoint and salt).

    Both layouts are really made, of narrow rows: the endpoint, and the salt.
    """
    before = _profile(logs.select("endpoint").repartition(target_partitions, "endpoint"), "before")
    salted = _with_salt(logs, salt_buckets, hot_key=hot_key).select("endpoint", "salt")
    after = _profile(salted.repartition(target_partitions, "endpoint", "salt"), "after")
    return before.unionByName(after)


def _timed_noop(df: DataFrame) -> int:
    start = time.perf_counter_ns()
    df.write.format("noop").mode("overwrite").save()
    return (time.perf_counter_ns() - start) // 1_000_000


def skew_study(spark: SparkSession, logs: DataFrame, *,
               target_partitions: int = DEFAULT_TARGET_PARTITIONS,
               salt_buckets: int = DEFAULT_SALT_BUCKETS,
               materialize_layout: bool = True) -> DataFrame:
    """One-row study: partition profile before/after salting, hot key, timings.

    Runs jobs: the hot-key row and the two profile rows come to the driver
    (three rows in all), and each arm is timed as a full ``noop`` write of
    the same result (count and mean; p95 is left out of both arms so they do
    equal work).  Both arms first repartition the raw rows by the layout that
    is reported (by endpoint, resp. endpoint and salt), so the times compare
    these layouts; the unsalted one puts the hot endpoint into one task, which
    is what the study measures.  Without ``materialize_layout`` the plain plans
    are timed, which aggregate map-side first.
    """
    hot = hot_endpoint(logs).first()
    # The hot key is found once; the salted plans compare with that value, so
    # the timed salted arm does not pay for finding it again (nor does the
    # unsalted arm).
    hot_key = hot["endpoint"]
    prof = {r["phase"]: r for r in partition_skew(
        logs, target_partitions=target_partitions, salt_buckets=salt_buckets,
        hot_key=hot_key).collect()}
    if materialize_layout:
        unsalted = endpoint_stats(hash_layout(logs, target_partitions), with_p95=False)
        salted = salted_aggregate(hash_layout(logs, target_partitions, salt_buckets=salt_buckets,
                                              hot_key=hot_key))
    else:
        unsalted = endpoint_stats(logs, with_p95=False)
        salted = salted_aggregate(_with_salt(logs, salt_buckets, hot_key=hot_key))
    before_ms = _timed_noop(unsalted)
    after_ms = _timed_noop(salted)
    empty = {"max_partition_rows": None, "min_partition_rows": None, "avg_partition_rows": None}
    b, a = prof.get("before") or empty, prof.get("after") or empty
    row = (b["max_partition_rows"], b["min_partition_rows"], b["avg_partition_rows"],
           a["max_partition_rows"], a["min_partition_rows"], a["avg_partition_rows"],
           hot["endpoint"], float(hot["share"]), int(salt_buckets), int(target_partitions),
           int(before_ms), int(after_ms), (before_ms - after_ms) * 100.0 / max(before_ms, 1))
    schema = T.StructType([
        T.StructField("before_max_partition_rows", T.LongType()),
        T.StructField("before_min_partition_rows", T.LongType()),
        T.StructField("before_avg_partition_rows", T.DoubleType()),
        T.StructField("after_max_partition_rows", T.LongType()),
        T.StructField("after_min_partition_rows", T.LongType()),
        T.StructField("after_avg_partition_rows", T.DoubleType()),
        T.StructField("top_endpoint", T.StringType()),
        T.StructField("top_endpoint_share", T.DoubleType()),
        T.StructField("salt_buckets", T.IntegerType()),
        T.StructField("target_partitions", T.IntegerType()),
        T.StructField("runtime_before_ms", T.LongType()),
        T.StructField("runtime_after_ms", T.LongType()),
        T.StructField("runtime_improvement_pct", T.DoubleType()),
    ])
    return spark.createDataFrame([row], schema)
