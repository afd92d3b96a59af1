"""Trace flows and gap-based user sessions.

Ordered work within a trace or user runs through :func:`keyed_scan`, so a hot
trace or user is split across tasks.  Summaries are plain ``groupBy``
aggregates (partial aggregation map-side, ``percentile_approx`` included).
The flattened ``*_steps`` outputs are the scalable form of a request flow;
:func:`nest_flow` builds the reference's nested array and is meant for groups
of bounded size only, since it materialises one whole group in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsfold.config import DEFAULT_SESSION_TIMEOUT_MINUTES, PERCENTILE_ACCURACY
from opsfold.functions.columns import error_flag, minutes_between, session_id
from opsfold.operators.scan import DEFAULT_TARGET_ROWS, keyed_scan

# Fields of one request-flow element, in sort order.
TRACE_FLOW_FIELDS = ["timestamp", "service", "endpoint", "status_code", "latency_ms", "host",
                     "region"]
FLOW_STEPS = 1000  # steps of one array
SESSION_FLOW_FIELDS = ["timestamp", "service", "endpoint", "status_code", "latency_ms",
                       "trace_id"]


def _flow(fields: list[str], name: str = "request_flow") -> Column:
    return F.sort_array(F.collect_list(F.struct(*[F.col(f) for f in fields]))).alias(name)


def nest_flow(rows: DataFrame, keys: list[str], fields: list[str],
              name: str = "request_flow") -> DataFrame:
    """``keys`` + ``sort_array(collect_list(struct(fields)))`` per group.

    Sorted field by field, nulls first.  One group becomes one row, so use it on
    groups of bounded size (e.g. after filtering to traces of interest).
    """
    return rows.groupBy(*keys).agg(_flow(fields, name))


def flow_arrays(steps: DataFrame, keys: list[str], fields: list[str], *,
                max_steps: int = FLOW_STEPS, name: str = "request_flow") -> DataFrame:
    """A flattened flow as arrays of at most ``max_steps`` steps: keys, ``part``, ``name``.

    Part ``i`` holds the steps ``i * max_steps + 1`` to ``(i + 1) * max_steps``, each with its
    ``step``.  Rows are grouped by (keys, part), so no group grows with a hot key, and a flow of at
    most ``max_steps`` steps is one array as a whole.
    """
    part = F.floor((F.col("step") - 1) / F.lit(max_steps)).cast("long")
    return steps.groupBy(*keys, part.alias("part")).agg(_flow(["step", *fields], name))


def flow_steps(arrays: DataFrame, keys: list[str], fields: list[str],
               name: str = "request_flow") -> DataFrame:
    """The rows that :func:`flow_arrays` was built from."""
    rows = arrays.select(*keys, F.explode(name).alias("_e"))
    return rows.select(*keys, *[F.col(f"_e.{f}").alias(f) for f in ["step", *fields]])


def trace_flows(logs: DataFrame, *, include_flow: bool = False) -> DataFrame:
    """One row per trace: start, end and event count (null trace ids left out)."""
    traced = logs.where(F.col("trace_id").isNotNull())
    return traced.groupBy("trace_id").agg(
        F.min("timestamp").alias("trace_start"),
        F.max("timestamp").alias("trace_end"),
        F.count(F.lit(1)).alias("event_count"),
        *([_flow(TRACE_FLOW_FIELDS)] if include_flow else []),
    )


def trace_flow_steps(logs: DataFrame, *, target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """The request flow flattened: one row per event with its 1-based ``step``.

    Steps follow the flow order (timestamp, service, endpoint, status, latency,
    host, region; nulls first).
    """
    traced = logs.where(F.col("trace_id").isNotNull()).select("trace_id", *TRACE_FLOW_FIELDS)
    scanned = keyed_scan(traced, ["trace_id"], TRACE_FLOW_FIELDS, "timestamp",
                         target_rows=target_rows, pos="step")
    return scanned.select("trace_id", "step", *TRACE_FLOW_FIELDS)


def _new_session(timeout_minutes: int):
    limit = F.lit(float(timeout_minutes))

    def flag(ts: Column, prev: Column) -> Column:
        # New at the first event or when the whole-second gap exceeds the timeout.
        return F.when(prev.isNull() | (minutes_between(ts, prev) > limit), F.lit(1)).otherwise(F.lit(0))
    return flag


def session_events(logs: DataFrame, *, timeout_minutes: int = DEFAULT_SESSION_TIMEOUT_MINUTES,
                   target_rows: int = DEFAULT_TARGET_ROWS,
                   with_start: bool = False) -> DataFrame:
    """Each event with a user id, tagged with its session.

    ``event_pos`` is the event's 1-based place in the user's timeline; a null
    timestamp sorts first and is a session of its own; equal timestamps never
    split; exactly ``timeout_minutes`` apart continues the session.  With
    ``with_start`` a ``session_start_pos`` column gives the ``event_pos`` of
    the session's first event.
    """
    flag = _new_session(timeout_minutes)
    users = logs.where(F.col("user_id").isNotNull()).select("user_id", *SESSION_FLOW_FIELDS)
    scanned = keyed_scan(users, ["user_id"], SESSION_FLOW_FIELDS, "timestamp",
                         flag=flag, target_rows=target_rows, pos="event_pos", prev="prev_ts",
                         run="session_index", start="session_start_pos" if with_start else None)
    extra = ["session_start_pos"] if with_start else []
    return scanned.select(
        "user_id", *SESSION_FLOW_FIELDS, "event_pos", "prev_ts",
        minutes_between("timestamp", "prev_ts").alias("gap_minutes"),
        flag(F.col("timestamp"), F.col("prev_ts")).alias("is_new_session"),
        "session_index",
        session_id("user_id", "session_index").alias("session_id"),
        *extra,
    )


def _session_summary(events: DataFrame, accuracy: int, *extra: Column) -> DataFrame:
    summary = events.groupBy("user_id", "session_index").agg(
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("event_count"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.percentile_approx("latency_ms", 0.95, accuracy).alias("p95_latency_ms"),
        F.avg(error_flag("status_code")).alias("error_rate"),
        *extra,
    )
    return summary.select(session_id("user_id", "session_index").alias("session_id"), "*").drop(
        "session_index")


def user_sessions(logs: DataFrame, *, timeout_minutes: int = DEFAULT_SESSION_TIMEOUT_MINUTES,
                  accuracy: int = PERCENTILE_ACCURACY, include_flow: bool = False,
                  target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """One row per session: bounds, count, mean and p95 latency, error rate."""
    events = session_events(logs, timeout_minutes=timeout_minutes, target_rows=target_rows)
    extra = [_flow(SESSION_FLOW_FIELDS)] if include_flow else []
    return _session_summary(events, accuracy, *extra)


def user_session_steps(logs: DataFrame, *,
                       timeout_minutes: int = DEFAULT_SESSION_TIMEOUT_MINUTES,
                       target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """A session's request flow flattened, with its 1-based ``step``.

    The step is the event's place in the user's timeline minus that of the
    session's first event, both from the same scan (no join back).
    """
    events = session_events(logs, timeout_minutes=timeout_minutes, target_rows=target_rows,
                            with_start=True)
    return events.select(
        "session_id", "user_id",
        (F.col("event_pos") - F.col("session_start_pos") + 1).alias("step"),
        *SESSION_FLOW_FIELDS,
    )
