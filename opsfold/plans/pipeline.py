"""The batch pipeline: load -> enrich -> products -> parquet outputs."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from opsfold.config import Params, configure
from opsfold.operators.anomalies import anomalies, top_offenders
from opsfold.operators.changes import change_impact
from opsfold.operators.enrich import enrich_logs
from opsfold.operators.rollup import hourly_rollup, slo_daily
from opsfold.operators.sessions import (
    trace_flow_steps,
    trace_flows,
    user_session_steps,
    user_sessions,
)
from opsfold.operators.skew import skew_study
from opsfold.plans.publish import OUTPUT_PATHS
from opsfold.sources.readers import Inputs, load_inputs
from opsfold.sources.sinks import write_counted

# Columns the products read; the cache holds nothing else.
ENRICHED_COLUMNS = ["timestamp", "service", "endpoint", "host", "status_code", "latency_ms",
                    "user_id", "trace_id", "region", "instance_type"]


def build_products(spark: SparkSession, inputs: Inputs, params: Params = Params(), *,
                   include_flows: bool = False) -> dict[str, DataFrame]:
    """Lazy products (the skew study excepted); nothing is cached."""
    configure(spark)
    enriched = enrich_logs(inputs.logs, inputs.hosts).select(*ENRICHED_COLUMNS)
    return dict(_products(spark, enriched, inputs, params, include_flows, lambda _, df: df))


def _products(spark: SparkSession, enriched: DataFrame, inputs: Inputs, params: Params,
              include_flows: bool, put) -> Iterator[tuple[str, DataFrame]]:
    """All products in order; ``put(name, df)`` gives the frame later ones read."""
    timeout = params.session_timeout_minutes

    def done(name: str, df: DataFrame) -> tuple[str, DataFrame]:
        return name, put(name, df)

    yield done("session_trace", trace_flows(enriched, include_flow=include_flows))
    yield done("session_trace_steps", trace_flow_steps(enriched))
    yield done("user_sessions", user_sessions(enriched, timeout_minutes=timeout,
                                              include_flow=include_flows))
    yield done("user_session_steps", user_session_steps(enriched, timeout_minutes=timeout))
    # One hourly roll-up shared by SLO, attribution and anomaly scoring.
    name, hourly = done("slo_hourly", hourly_rollup(enriched))
    yield name, hourly
    yield done("slo_daily", slo_daily(enriched))
    yield done("change_impact_attribution", change_impact(
        enriched, inputs.deployments, window_hours=params.attribution_window_hours, rollup=hourly))
    name, flagged = done("anomalies", anomalies(enriched, baseline_hours=params.baseline_hours,
                                                rollup=hourly))
    yield name, flagged
    yield done("top_offenders", top_offenders(flagged))
    yield done("skew_study", skew_study(spark, enriched, target_partitions=params.target_partitions,
                                        salt_buckets=params.salt_buckets))


def run_from_paths(spark: SparkSession, logs: str, deployments: str, host_meta: str,
                   params: Params = Params(), **options) -> dict[str, DataFrame]:
    """Load the three inputs in ``params.input_format`` and run the pipeline."""
    configure(spark)
    inputs = load_inputs(spark, logs, deployments, host_meta, fmt=params.input_format)
    return run_pipeline(spark, inputs, params, **options)


def run_pipeline(spark: SparkSession, inputs: Inputs, params: Params = Params(), *,
                 output_root: str | None = None, include_flows: bool = False,
                 partition_by: dict[str, list[str]] | None = None,
                 counts: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Run every product.

    Without ``output_root`` the lazy products are returned.  With it, each
    product is written once as parquet and the returned DataFrames read the
    written files, so previews do not recompute the plans.  Products that
    feed others are read back from their written output: attribution and
    anomaly scoring read the written hourly roll-up, top offenders the written
    anomalies.  That cuts the lineage at a table in shared storage (a lost
    executor never re-runs the roll-up) and gives every product the same
    percentiles.  A cached enriched table is released at the end.
    ``partition_by`` names partition columns for outputs that want them.
    ``counts`` is filled with the rows of each output, counted while it is written.
    """
    if output_root is None:
        return build_products(spark, inputs, params, include_flows=include_flows)
    configure(spark)
    enriched = enrich_logs(inputs.logs, inputs.hosts).select(*ENRICHED_COLUMNS)
    if params.persist_enriched:
        enriched = enriched.persist(StorageLevel.MEMORY_AND_DISK)
    partitions = partition_by or {}

    def put(name: str, df: DataFrame) -> DataFrame:
        path = os.path.join(output_root, OUTPUT_PATHS[name])
        rows = write_counted(df, path, partition_by=partitions.get(name))
        if counts is not None:
            counts[name] = rows
        return spark.read.parquet(path)

    try:
        return dict(_products(spark, enriched, inputs, params, include_flows, put))
    finally:
        enriched.unpersist()
