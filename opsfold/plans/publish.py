"""Publication: outputs as tables, the five chart views and the validation query.

Each view exists twice: as a DataFrame function (used by the pipeline and the
registered queries) and as SQL text for ``publish`` over registered tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsfold.sources.sinks import qualified

# Output names and the columns of each view, in order.
OUTPUT_PATHS = {
    "session_trace": "session_trace",
    "user_sessions": "user_sessions",
    # The request flows of both, one row per step.
    "session_trace_steps": "session_trace_steps",
    "user_session_steps": "user_session_steps",
    "slo_hourly": "slo/hourly",
    "slo_daily": "slo/daily",
    "change_impact_attribution": "change_impact_attribution",
    "anomalies": "anomalies",
    "top_offenders": "top_offenders",
    "skew_study": "skew_study",
}
VW_SLO_TRENDS = ["time_bucket", "service", "endpoint", "region", "request_count",
                 "avg_latency_ms", "p50_latency_ms", "p95_latency_ms", "p99_latency_ms",
                 "error_rate"]
VW_ANOMALY_TIMELINE = ["hour_bucket", "service", "endpoint", "region", "request_count",
                       "error_rate", "p95_latency_ms", "baseline_error_avg", "baseline_p95_avg",
                       "severity", "error_anomaly", "latency_anomaly", "explanation"]
VW_DEPLOYMENT_IMPACT = ["time_bucket", "service", "endpoint", "region", "deploy_version",
                        "deploy_time", "minutes_since_deploy", "request_count",
                        "avg_latency_ms", "p95_latency_ms", "error_rate"]
VW_TOP_OFFENDERS = ["service", "endpoint", "region", "anomaly_windows", "max_severity",
                    "peak_p95_ms", "peak_error_rate", "explanations"]
VW_SKEW_BENCHMARK = ["top_endpoint", "top_endpoint_share", "salt_buckets", "target_partitions",
                     "before_max_partition_rows", "before_min_partition_rows",
                     "before_avg_partition_rows", "after_max_partition_rows",
                     "after_min_partition_rows", "after_avg_partition_rows",
                     "runtime_before_ms", "runtime_after_ms", "runtime_improvement_pct"]
VALIDATION_LIMIT = 20

_TS_CAST = {"vw_slo_trends": ["time_bucket"], "vw_anomaly_timeline": ["hour_bucket"],
            "vw_deployment_impact": ["time_bucket", "deploy_time"]}
VIEWS = {"vw_slo_trends": ("slo_hourly", VW_SLO_TRENDS),
         "vw_anomaly_timeline": ("anomalies", VW_ANOMALY_TIMELINE),
         "vw_deployment_impact": ("change_impact_attribution", VW_DEPLOYMENT_IMPACT),
         "vw_top_offenders": ("top_offenders", VW_TOP_OFFENDERS),
         "vw_skew_benchmark": ("skew_study", VW_SKEW_BENCHMARK)}


def view_frame(name: str, source: DataFrame) -> DataFrame:
    """Project ``source`` as view ``name`` (time columns cast to timestamp)."""
    _, cols = VIEWS[name]
    casts = set(_TS_CAST.get(name, []))
    return source.select(*[F.col(c).cast("timestamp").alias(c) if c in casts else F.col(c)
                           for c in cols])


def vw_slo_trends(slo_hourly: DataFrame) -> DataFrame:
    return view_frame("vw_slo_trends", slo_hourly)


def vw_anomaly_timeline(anomalies: DataFrame) -> DataFrame:
    return view_frame("vw_anomaly_timeline", anomalies)


def vw_deployment_impact(change_impact: DataFrame) -> DataFrame:
    return view_frame("vw_deployment_impact", change_impact)


def vw_top_offenders(top_offenders: DataFrame) -> DataFrame:
    return view_frame("vw_top_offenders", top_offenders)


def vw_skew_benchmark(skew_study: DataFrame) -> DataFrame:
    return view_frame("vw_skew_benchmark", skew_study)


def slo_validation_top20(slo_trends: DataFrame, limit: int = VALIDATION_LIMIT) -> DataFrame:
    """Mean p95 per (service, endpoint), rounded to 2 places, highest first."""
    agg = slo_trends.groupBy("service", "endpoint").agg(
        F.round(F.avg("p95_latency_ms"), 2).alias("avg_p95_ms"))
    return agg.orderBy(F.col("avg_p95_ms").desc_nulls_last(), F.col("service").asc_nulls_first(),
                       F.col("endpoint").asc_nulls_first()).limit(limit)


def view_sql(name: str, table: str | None = None) -> str:
    source, cols = VIEWS[name]
    casts = set(_TS_CAST.get(name, []))
    items = [f"CAST({c} AS TIMESTAMP) AS {c}" if c in casts else c for c in cols]
    return f"SELECT {', '.join(items)} FROM {table or source}"


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def _drop_own_table(spark: SparkSession, database: str, name: str, path: str) -> None:
    """Drop ``name`` only if it is an external table over ``path``; its files stay."""
    table = f"{_quoted(database)}.{_quoted(name)}"
    if not spark.catalog.tableExists(table):
        return
    rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    location = rows.get("Location", "")
    if rows.get("Type") != "EXTERNAL" or qualified(spark, location) != qualified(spark, path):
        raise ValueError(f"{database}.{name} exists and is no external table over {path}")
    spark.sql(f"DROP TABLE {table}")


def publish(spark: SparkSession, root: str, *, database: str | None = None) -> dict[str, DataFrame]:
    """Register the outputs under ``root`` and create the five views.

    Without ``database`` the outputs and views are session views.  With one
    (created if missing), outputs become external tables over their parquet
    paths and the views are persistent views of that database; a table of the
    same name is replaced only if it is such a table itself, else an error is
    raised.  Returns the views and the validation query as DataFrames.
    """
    if database is not None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    for name, rel in OUTPUT_PATHS.items():
        path = os.path.join(root, rel)
        if database is None:
            spark.read.parquet(path).createOrReplaceTempView(name)
        else:
            _drop_own_table(spark, database, name, path)
            spark.catalog.createTable(f"{_quoted(database)}.{_quoted(name)}", path=path, source="parquet")
    out = {}
    for name, (source, _) in VIEWS.items():
        if database is None:
            spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS {view_sql(name)}")
            out[name] = spark.table(name)
        else:
            full = _quoted(database, name)
            spark.sql(f"CREATE OR REPLACE VIEW {full} AS {view_sql(name, _quoted(database, source))}")
            out[name] = spark.table(full)
    out["slo_validation_top20"] = slo_validation_top20(out["vw_slo_trends"])
    return out
