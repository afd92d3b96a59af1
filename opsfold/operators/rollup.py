"""Hourly and daily SLO roll-ups.

One hourly roll-up feeds the SLO table, deployment attribution and anomaly
scoring, so the logs are aggregated once per hour grain rather than three
times.  ``percentile_approx`` is a partial aggregate: each map task ships one
sketch per group, so a hot group does not pull its raw rows into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsfold.config import PERCENTILE_ACCURACY
from opsfold.functions.columns import day_bucket, error_flag, hour_bucket

# Reported latency percentiles.
PERCENTILES = [0.50, 0.95, 0.99]
SERIES_KEYS = ["service", "endpoint", "region"]
SLO_COLUMNS = ["service", "endpoint", "region", "time_bucket", "request_count",
               "avg_latency_ms", "p50_latency_ms", "p95_latency_ms", "p99_latency_ms",
               "error_rate"]


def _rollup(logs: DataFrame, bucket: Column, accuracy: int) -> DataFrame:
    pcts = F.percentile_approx("latency_ms", PERCENTILES, accuracy)
    grouped = logs.groupBy(*SERIES_KEYS, bucket.alias("time_bucket")).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        pcts.alias("_pcts"),
        F.avg(error_flag("status_code")).alias("error_rate"),
    )
    return grouped.select(
        *SERIES_KEYS, "time_bucket", "request_count", "avg_latency_ms",
        F.col("_pcts").getItem(0).alias("p50_latency_ms"),
        F.col("_pcts").getItem(1).alias("p95_latency_ms"),
        F.col("_pcts").getItem(2).alias("p99_latency_ms"),
        "error_rate",
    )


def hourly_rollup(logs: DataFrame, *, accuracy: int = PERCENTILE_ACCURACY) -> DataFrame:
    """Per (service, endpoint, region, hour): count, mean, p50/p95/p99, error rate.

    Null latency counts in ``request_count`` only; a null status is not an error.
    """
    return _rollup(logs, hour_bucket("timestamp"), accuracy)


def slo_hourly(logs: DataFrame, *, accuracy: int = PERCENTILE_ACCURACY) -> DataFrame:
    return hourly_rollup(logs, accuracy=accuracy)


def slo_daily(logs: DataFrame, *, accuracy: int = PERCENTILE_ACCURACY) -> DataFrame:
    """As :func:`slo_hourly` with a ``date`` bucket.

    Percentiles cannot be merged from hourly outputs, so this aggregates rows.
    """
    return _rollup(logs, day_bucket("timestamp"), accuracy)


def slo_metrics(logs: DataFrame, *, accuracy: int = PERCENTILE_ACCURACY) -> dict[str, DataFrame]:
    return {"hourly": slo_hourly(logs, accuracy=accuracy),
            "daily": slo_daily(logs, accuracy=accuracy)}
