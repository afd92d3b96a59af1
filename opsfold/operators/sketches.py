"""Mergeable latency percentiles: KLL sketches kept in the hourly table.

``percentile_approx`` results cannot be merged, so a day's percentiles would need the day's
log rows again.  A KLL sketch per (series, hour) is a few kilobytes at most and merges into
days, weeks or any set of series without reading a log row.  A sketch of ``k`` is exact up to
``k`` values; beyond that, the rank of a reported percentile is off by a small share of the
number of values (:func:`rank_error`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsfold.functions.columns import day_bucket, error_flag, hour_bucket
from opsfold.operators.rollup import PERCENTILES, SERIES_KEYS, SLO_COLUMNS

SKETCH_K = 800
SKETCH_COLUMNS = ["request_count", "latency_sum", "latency_n", "error_sum", "latency_sketch"]


def rank_error(k: int = SKETCH_K) -> float:
    """Bound of a percentile's rank error as a share of all values.

    Twice the error that a sketch of ``k`` keeps in 99 of 100 cases, about five
    standard deviations.
    """
    return 2 * 2.296 / k ** 0.9723


def latency_sketch(value: str | Column = "latency_ms", k: int = SKETCH_K) -> Column:
    return F.kll_sketch_agg_double(value, k)


def percentiles_of(sketch: str, n: str, quantiles: list[float]) -> list[Column]:
    """Percentiles of a sketch column; null where it holds no value (``n`` is 0)."""
    return [F.when(F.col(n) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(q)))
            for q in quantiles]


def sketch_rollup(logs: DataFrame, keys: list[str], bucket: Column, k: int = SKETCH_K) -> DataFrame:
    """Per (keys, bucket): counts, sums and the latency sketch, all of them mergeable."""
    return logs.groupBy(*keys, bucket.alias("time_bucket")).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.sum("latency_ms").alias("latency_sum"),
        F.count("latency_ms").alias("latency_n"),
        F.sum(error_flag("status_code")).alias("error_sum"),
        latency_sketch(k=k).alias("latency_sketch"),
    )


def hourly_sketches(logs: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """The hourly table of sketches per (service, endpoint, region, hour)."""
    return sketch_rollup(logs, SERIES_KEYS, hour_bucket("timestamp"), k)


def merge_sketches(sketches: DataFrame, keys: list[str | Column]) -> DataFrame:
    """Sum and merge the rows of a sketch table per ``keys``."""
    return sketches.groupBy(*keys).agg(
        F.sum("request_count").alias("request_count"),
        F.sum("latency_sum").alias("latency_sum"),
        F.sum("latency_n").alias("latency_n"),
        F.sum("error_sum").alias("error_sum"),
        F.kll_merge_agg_double("latency_sketch").alias("latency_sketch"),
    )


def slo_from_sketches(sketches: DataFrame) -> DataFrame:
    """The SLO columns of a sketch table, one row per row."""
    p50, p95, p99 = percentiles_of("latency_sketch", "latency_n", PERCENTILES)
    mean = F.col("latency_sum") / F.nullif(F.col("latency_n"), F.lit(0))
    return sketches.withColumns({
        "avg_latency_ms": mean, "p50_latency_ms": p50, "p95_latency_ms": p95,
        "p99_latency_ms": p99, "error_rate": F.col("error_sum") / F.col("request_count"),
    }).select(*SLO_COLUMNS)


def daily_from_hourly(sketches: DataFrame) -> DataFrame:
    """The daily SLO table from the hourly table of sketches; no log row is read."""
    day = day_bucket("time_bucket").alias("time_bucket")
    return slo_from_sketches(merge_sketches(sketches, [*SERIES_KEYS, day]))


def rank_check(values: DataFrame, found: DataFrame, keys: list[str], quantiles: list[float],
               k: int = SKETCH_K, value: str = "latency_ms") -> DataFrame:
    """Per (keys, quantile): how many values there are, and whether the one found is in bounds.

    ``found`` has ``keys`` and one column ``q0, q1, ...`` per quantile, one row per group, so it is
    as small as the number of groups.  The ranks of each found value are counted in ``values``; it
    is in bounds if some rank that it holds lies within :func:`rank_error` of the quantile.
    """
    names = [f"q{i}" for i in range(len(quantiles))]
    rows = values.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    met = rows.join(found.select(*keys, *names), keys)
    counts = [F.count(F.lit(1)).alias("latency_rows")]
    for c in names:
        counts += [F.count_if(F.col("_v") < F.col(c)).alias(f"_lo_{c}"),
                   F.count_if(F.col("_v") <= F.col(c)).alias(f"_hi_{c}")]
    ranked = met.groupBy(*keys).agg(*counts)
    n, slack = F.col("latency_rows"), F.lit(rank_error(k))
    checks = F.array(*[F.struct(
        F.lit(q).alias("quantile"),
        ((F.col(f"_lo_{c}") / n - slack <= q) & (F.col(f"_hi_{c}") / n + slack >= q)
         & (F.col(f"_hi_{c}") > F.col(f"_lo_{c}"))).alias("within"))
        for q, c in zip(quantiles, names, strict=True)])
    return (ranked.select(*keys, "latency_rows", F.explode(checks).alias("x"))
            .select(*keys, "latency_rows", "x.quantile", "x.within"))
