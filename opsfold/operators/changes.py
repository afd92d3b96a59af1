"""Deployment intervals and change-impact attribution.

A bucket (hour start ``h``) belongs to the service's deployment in force at
``h`` -- the latest one with ``deploy_time <= h`` -- provided
``h <= deploy_time + N hours``.  Rather than a range join, each deployment is
expanded to the at most ``N + 1`` hour buckets it can own and the latest
candidate per (service, hour) is kept.  Attribution is then an equi-join with
a unique right side: no per-service window, no residual range predicate, and
a hot service only makes a larger hash partition that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsfold.config import DEFAULT_ATTRIBUTION_WINDOW_HOURS, MAX_BROADCAST_BYTES, fits
from opsfold.functions.columns import hour_bucket, minutes_between
from opsfold.operators.asof import asof_join
from opsfold.operators.rollup import hourly_rollup
from opsfold.operators.scan import DEFAULT_TARGET_ROWS, keyed_scan

CHANGE_IMPACT_COLUMNS = ["time_bucket", "service", "endpoint", "region", "request_count",
                         "avg_latency_ms", "p95_latency_ms", "error_rate", "deploy_version",
                         "deploy_time", "minutes_since_deploy"]


def _valid(deployments: DataFrame) -> DataFrame:
    return (deployments.select("service", "version", "deploy_time")
            .where(F.col("deploy_time").isNotNull() & F.col("service").isNotNull()))


def deployment_intervals(deployments: DataFrame, *,
                         target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """``[deploy_time, next_deploy_time)`` per deployment of a service.

    Order is (deploy_time, version), so of two deploys at the same instant the
    higher version owns the interval.  The lead runs as a skew-safe scan.
    """
    scanned = keyed_scan(_valid(deployments), ["service"], ["deploy_time", "version"],
                         "deploy_time", target_rows=target_rows, prev="_prev_deploy",
                         nxt="next_deploy_time")
    return scanned.select("service", "version", "deploy_time", "next_deploy_time")


def deployments_in_force(deployments: DataFrame, *,
                         window_hours: int = DEFAULT_ATTRIBUTION_WINDOW_HOURS) -> DataFrame:
    """(service, time_bucket) -> the deployment owning that hour bucket, if any."""
    d = _valid(deployments)
    trunc = hour_bucket("deploy_time")
    first = F.when(trunc == F.col("deploy_time"), trunc).otherwise(
        trunc + F.make_dt_interval(hours=F.lit(1)))
    last = hour_bucket(F.col("deploy_time") + F.make_dt_interval(hours=F.lit(window_hours)))
    hours = F.when(first <= last, F.sequence(first, last, F.make_dt_interval(hours=F.lit(1))))
    expanded = d.select("service", "version", "deploy_time",
                        F.explode(hours).alias("time_bucket"))
    latest = F.max(F.struct(F.col("deploy_time"), F.col("version"))).alias("d")
    return (expanded.groupBy("service", "time_bucket").agg(latest)
            .select("service", "time_bucket", F.col("d.version").alias("deploy_version"),
                    F.col("d.deploy_time").alias("deploy_time")))


def change_impact(logs: DataFrame, deployments: DataFrame, *,
                  window_hours: int = DEFAULT_ATTRIBUTION_WINDOW_HOURS,
                  rollup: DataFrame | None = None, broadcast: bool | None = None,
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hourly roll-up rows with the deployment in force (null when none).

    Keeps exactly the roll-up's rows.  The (service, hour) table is broadcast
    only when it is proven to hold at most ``max_broadcast_bytes``.
    """
    hourly = rollup if rollup is not None else hourly_rollup(logs)
    hourly = hourly.select("time_bucket", "service", "endpoint", "region", "request_count",
                           "avg_latency_ms", "p95_latency_ms", "error_rate")
    owners = deployments_in_force(deployments, window_hours=window_hours)
    if broadcast is None:
        # Each deployment owns at most N + 1 hour buckets, so a small enough
        # deployment table proves the bound without building the hour table.
        broadcast = fits(_valid(deployments), max_broadcast_bytes // (window_hours + 1))
    if broadcast:
        owners = F.broadcast(owners)
    joined = hourly.join(owners, ["service", "time_bucket"], "left")
    minutes = F.when(F.col("deploy_time").isNull(), F.lit(None).cast("double")).otherwise(
        minutes_between("time_bucket", "deploy_time"))
    return joined.withColumn("minutes_since_deploy", minutes).select(*CHANGE_IMPACT_COLUMNS)


def attributed(rows: DataFrame, deployments: DataFrame, *, time: str,
               window_hours: int = DEFAULT_ATTRIBUTION_WINDOW_HOURS,
               target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """``rows`` (any time grain) with the deployment of their service in force at ``time``.

    Adds ``deploy_version``, ``deploy_time`` and ``minutes_since_deploy``, null where the latest
    deployment is more than ``window_hours`` old or there is none.  A merge scan per service finds
    it, so no deployment is expanded to time buckets and a hot service is split.
    """
    deploys = _valid(deployments).withColumnRenamed("version", "deploy_version")
    found = asof_join(rows, deploys, ["service"], time, "deploy_time", ["deploy_version"],
                      tolerance=F.make_dt_interval(hours=F.lit(window_hours)),
                      target_rows=target_rows)
    minutes = F.when(F.col("deploy_time").isNotNull(), minutes_between(time, "deploy_time"))
    return found.withColumn("minutes_since_deploy", minutes)


def change_impact_asof(logs: DataFrame, deployments: DataFrame, *,
                       window_hours: int = DEFAULT_ATTRIBUTION_WINDOW_HOURS,
                       rollup: DataFrame | None = None,
                       target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """:func:`change_impact` by a merge scan instead of an expanded equi-join."""
    hourly = rollup if rollup is not None else hourly_rollup(logs)
    hourly = hourly.select("time_bucket", "service", "endpoint", "region", "request_count",
                           "avg_latency_ms", "p95_latency_ms", "error_rate")
    return attributed(hourly, deployments, time="time_bucket", window_hours=window_hours,
                      target_rows=target_rows).select(*CHANGE_IMPACT_COLUMNS)
