"""opsfold: service-telemetry analytics expressed as Spark DataFrame plans.

Inputs are request logs, deployment records and host metadata.  Products are
trace flows, gap-based user sessions, hourly/daily SLO roll-ups, attribution of
hourly buckets to the deployment in force, rolling-baseline anomalies with
ranked offenders, and a partition-skew study with salted aggregation.

Every operator is a function ``DataFrame -> DataFrame`` with keyword
parameters.  Jobs that run while a plan is built: the skew study, sinks and
trims; the size check of a side that may be broadcast (``enrich_logs``,
``change_impact``); and the count of hot keys before an ordered scan
(``session_events``, ``user_sessions``, both steps, ``deployment_intervals``).
"""

from opsfold.config import Params, configure
from opsfold.sources.readers import Inputs, load_inputs, normalize_time
from opsfold.operators.enrich import dedupe_hosts, enrich_logs
from opsfold.operators.sessions import (
    nest_flow,
    session_events,
    trace_flow_steps,
    trace_flows,
    user_session_steps,
    user_sessions,
)
from opsfold.operators.rollup import hourly_rollup, slo_daily, slo_hourly, slo_metrics
from opsfold.operators.changes import change_impact, deployment_intervals, deployments_in_force
from opsfold.operators.anomalies import anomalies, anomaly_scores, top_offenders
from opsfold.operators.limits import first_rows, top_rows
from opsfold.operators.scan import keyed_scan
from opsfold.operators.skew import (
    endpoint_stats,
    hot_endpoint,
    partition_skew,
    salted_endpoint_stats,
    skew_study,
)

__all__ = [
    "Params", "configure", "Inputs", "load_inputs", "normalize_time",
    "dedupe_hosts", "enrich_logs", "trace_flows", "trace_flow_steps", "session_events",
    "user_sessions", "user_session_steps", "nest_flow", "hourly_rollup", "slo_hourly",
    "slo_daily", "slo_metrics", "deployment_intervals", "deployments_in_force",
    "change_impact", "anomaly_scores", "anomalies", "top_offenders", "hot_endpoint",
    "endpoint_stats", "salted_endpoint_stats", "partition_skew", "skew_study",
    "keyed_scan", "first_rows", "top_rows",
]
