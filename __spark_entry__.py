"""

Every query derives logs, host metadata and deployments from the given test
tables (``opsfold.plans.fixtures``), runs a library operator over the whole
tables and returns a DataFrame.  ``oracle_sql`` holds independent DuckDB SQL
for the same result; the inputs are inlined as CTEs.  For comparison, both
sides round double columns to 6 places, and Spark returns times as
``timestamp_ntz`` (DuckDB ``TIMESTAMP`` has no zone either).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsfold.config import configure, shared_path
from opsfold.operators.anomalies import anomalies, anomaly_scores, top_offenders
from opsfold.operators.changes import (
    attributed,
    change_impact,
    change_impact_asof,
    deployment_intervals,
)
from opsfold.operators.enrich import enrich_logs
from opsfold.operators.heavy import heavy_hitters
from opsfold.operators.rollup import PERCENTILES, slo_daily, slo_hourly
from opsfold.operators.selection import exact_quantile
from opsfold.operators.sessions import (
    TRACE_FLOW_FIELDS,
    flow_arrays,
    flow_steps,
    session_events,
    trace_flow_steps,
    trace_flows,
    user_session_steps,
    user_sessions,
)
from opsfold.operators.sketches import (
    daily_from_hourly,
    hourly_sketches,
    merge_sketches,
    percentiles_of,
    rank_check,
)
from opsfold.operators.skew import (
    _with_salt,
    endpoint_stats,
    hot_endpoint,
    partition_skew,
    salted_endpoint_stats,
    skew_study,
)
from opsfold.plans import publish as pub
from opsfold.plans.fixtures import fixture_inputs, oracle_prefix
from opsfold.plans.pipeline import run_from_paths
from opsfold.sources.nanos import write_nanos
from opsfold.sources.readers import coerce_counted, load_inputs, normalize_time
from opsfold.sources.sinks import (
    preview,
    trim_dataset,
    trim_frame,
    validate_outputs,
    write_bucketed,
    write_parquet,
    write_partitions,
)

try:  # the training-data operators are an optional part
    from opsfold.llm import queries as llm
except ImportError:
    llm = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
DIGITS = 6
GUARD_DIGITS = 9
# Sub-chunk size for the skewed-fixture queries: small enough that the hot
# user/trace (a third of all rows) is split even at sf0.01.
HOT_TARGET_ROWS = 1000
TRIM_1K = 1000
FLOW_ARRAY_STEPS = 100
HEAVY_SHARE = 0.005
BUCKETS = 8


def _finish(df: DataFrame) -> DataFrame:
    cols = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DoubleType):
            # First to GUARD_DIGITS places: float noise cannot flip a half, and no zero is negative.
            c = F.round(F.round(c, GUARD_DIGITS), DIGITS) + F.lit(0.0)
        cols.append(c.alias(field.name))
    return df.select(*cols)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = fixture_inputs(spark, sf_dir)
    return enrich_logs(inputs.logs, inputs.hosts)


def _enriched_skewed(spark: SparkSession, sf_dir: str, skewed: bool | str = True) -> DataFrame:
    inputs = fixture_inputs(spark, sf_dir, skewed=skewed)
    return enrich_logs(inputs.logs, inputs.hosts)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


# ---------------------------------------------------------------- Spark side

def q_enrich_logs(spark, sf_dir):
    return _finish(_enriched(spark, sf_dir))


def q_trace_flows(spark, sf_dir):
    return _finish(trace_flows(_enriched(spark, sf_dir)))


def q_trace_flow_steps(spark, sf_dir):
    return _finish(trace_flow_steps(_enriched(spark, sf_dir)))


def q_session_events(spark, sf_dir):
    return _finish(session_events(_enriched(spark, sf_dir)))


def q_user_sessions(spark, sf_dir):
    return _finish(user_sessions(_enriched(spark, sf_dir)))


def q_user_sessions_8h(spark, sf_dir):
    return _finish(user_sessions(_enriched(spark, sf_dir), timeout_minutes=480))


def q_user_session_steps(spark, sf_dir):
    return _finish(user_session_steps(_enriched(spark, sf_dir)))


def q_session_events_hot_user(spark, sf_dir):
    return _finish(session_events(_enriched_skewed(spark, sf_dir), target_rows=HOT_TARGET_ROWS))


def q_user_sessions_hot_user(spark, sf_dir):
    return _finish(user_sessions(_enriched_skewed(spark, sf_dir), target_rows=HOT_TARGET_ROWS))


def q_user_session_steps_hot_user(spark, sf_dir):
    return _finish(user_session_steps(_enriched_skewed(spark, sf_dir),
                                      target_rows=HOT_TARGET_ROWS))


def q_user_session_steps_many_hot(spark, sf_dir):
    # Nearly every user is hot here: no bound on their number may leave one unsplit.
    return _finish(user_session_steps(_enriched(spark, sf_dir), target_rows=3))


def q_trace_flow_steps_hot_trace(spark, sf_dir):
    return _finish(trace_flow_steps(_enriched_skewed(spark, sf_dir),
                                    target_rows=HOT_TARGET_ROWS))


def q_slo_hourly(spark, sf_dir):
    return _finish(slo_hourly(_enriched(spark, sf_dir)))


def q_slo_daily(spark, sf_dir):
    return _finish(slo_daily(_enriched(spark, sf_dir)))


def q_deployment_intervals(spark, sf_dir):
    return _finish(deployment_intervals(fixture_inputs(spark, sf_dir).deployments))


def q_change_impact(spark, sf_dir):
    inputs = fixture_inputs(spark, sf_dir)
    return _finish(change_impact(enrich_logs(inputs.logs, inputs.hosts), inputs.deployments))


def q_anomaly_scores(spark, sf_dir):
    return _finish(anomaly_scores(_enriched(spark, sf_dir)))


def q_anomalies(spark, sf_dir):
    return _finish(anomalies(_enriched(spark, sf_dir)))


def q_top_offenders(spark, sf_dir):
    return _finish(top_offenders(anomalies(_enriched(spark, sf_dir))))


def q_hot_endpoint(spark, sf_dir):
    return _finish(hot_endpoint(_enriched(spark, sf_dir)))


def q_endpoint_stats(spark, sf_dir):
    # The p95 by exact selection: order buckets of an endpoint's rows, one of them ranked.
    logs = _enriched(spark, sf_dir)
    p95 = exact_quantile(logs, ["endpoint"], "latency_ms", 0.95, name="p95_latency_ms",
                         target_rows=HOT_TARGET_ROWS)
    return _finish(endpoint_stats(logs, with_p95=False).join(p95, "endpoint", "left"))


def q_endpoint_p95_ranks(spark, sf_dir):
    # percentile_approx as the products use it: within its bound of n / accuracy ranks.
    logs = _enriched(spark, sf_dir)
    found = endpoint_stats(logs).select("endpoint", F.col("p95_latency_ms").alias("q0"))
    return _finish(rank_check(logs, found, ["endpoint"], [0.95]))


def q_slo_daily_from_sketches(spark, sf_dir):
    # The hourly sketches are written once; the days are built from that table alone.
    path = shared_path(spark, "hourly-sketches")
    write_parquet(hourly_sketches(_enriched(spark, sf_dir)), path)
    return _finish(daily_from_hourly(spark.read.parquet(path)))


def q_merged_percentile_ranks(spark, sf_dir):
    logs = _enriched(spark, sf_dir)
    path = shared_path(spark, "hourly-sketches")
    write_parquet(hourly_sketches(logs), path)
    merged = merge_sketches(spark.read.parquet(path), ["endpoint"])
    found = merged.select("endpoint", *[c.alias(f"q{i}") for i, c in enumerate(
        percentiles_of("latency_sketch", "latency_n", PERCENTILES))])
    return _finish(rank_check(logs, found, ["endpoint"], PERCENTILES))


def q_salted_p95_ranks(spark, sf_dir):
    logs = _enriched(spark, sf_dir)
    out = None
    for buckets in (1, 4, 16, 64):
        stats = salted_endpoint_stats(logs, salt_buckets=buckets, with_p95=True)
        found = stats.select("endpoint", F.col("p95_latency_ms").alias("q0"))
        part = (rank_check(logs, found, ["endpoint"], [0.95]).drop("quantile")
                .join(stats.select("endpoint", "request_count", "avg_latency_ms"), "endpoint")
                .withColumn("salt_buckets", F.lit(buckets)))
        out = part if out is None else out.unionByName(part)
    return _finish(out)


def q_salt_spread(spark, sf_dir):
    salted = _with_salt(_enriched(spark, sf_dir), 16)
    return salted.groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("request_count"), F.count_distinct("salt").alias("n_salts"),
        F.min("salt").alias("least_salt"), F.max("salt").alias("greatest_salt"))


def q_change_impact_asof(spark, sf_dir):
    inputs = fixture_inputs(spark, sf_dir)
    return _finish(change_impact_asof(enrich_logs(inputs.logs, inputs.hosts), inputs.deployments))


def q_change_impact_asof_hot_service(spark, sf_dir):
    inputs = fixture_inputs(spark, sf_dir, skewed="service")
    return _finish(change_impact_asof(enrich_logs(inputs.logs, inputs.hosts), inputs.deployments,
                                      target_rows=HOT_TARGET_ROWS))


def q_log_attribution(spark, sf_dir):
    # The grain of single log rows: no hour buckets at all.
    inputs = fixture_inputs(spark, sf_dir)
    logs = inputs.logs.select("timestamp", "service", "endpoint", "trace_id", "status_code")
    return _finish(attributed(logs, inputs.deployments, time="timestamp"))


def _flow_rows(enriched, target_rows=None):
    steps = trace_flow_steps(enriched, **({"target_rows": target_rows} if target_rows else {}))
    arrays = flow_arrays(steps, ["trace_id"], TRACE_FLOW_FIELDS, max_steps=FLOW_ARRAY_STEPS)
    return _finish(flow_steps(arrays, ["trace_id"], TRACE_FLOW_FIELDS))


def q_trace_flow_arrays(spark, sf_dir):
    return _flow_rows(_enriched(spark, sf_dir))


def q_trace_flow_arrays_hot_trace(spark, sf_dir):
    return _flow_rows(_enriched_skewed(spark, sf_dir), HOT_TARGET_ROWS)


def q_trace_flow_array_sizes(spark, sf_dir):
    steps = trace_flow_steps(_enriched_skewed(spark, sf_dir), target_rows=HOT_TARGET_ROWS)
    arrays = flow_arrays(steps, ["trace_id"], TRACE_FLOW_FIELDS, max_steps=FLOW_ARRAY_STEPS)
    return _finish(arrays.select("trace_id", "part", F.size("request_flow").alias("n_steps")))


def q_anomaly_scores_split(spark, sf_dir):
    # Rolling baselines over series cut into blocks: each block gets the rows before it too.
    return _finish(anomaly_scores(_enriched(spark, sf_dir), target_rows=3))


def q_heavy_users(spark, sf_dir):
    logs = _enriched_skewed(spark, sf_dir)
    total = logs.count()
    heavy = heavy_hitters(logs, ["user_id"], int(total * HEAVY_SHARE), total)
    return heavy.withColumnRenamed("_cnt", "request_count")


def _by_user_table(spark, sf_dir, column):
    table = f"opsfold_logs_by_{column}_" + hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    return write_bucketed(_enriched(spark, sf_dir), table, shared_path(spark, "bucketed"),
                          column, BUCKETS)


def q_user_sessions_bucketed(spark, sf_dir):
    return _finish(user_sessions(_by_user_table(spark, sf_dir, "user_id")))


def q_trace_flow_steps_bucketed(spark, sf_dir):
    return _finish(trace_flow_steps(_by_user_table(spark, sf_dir, "trace_id")))


def q_slo_daily_rerun(spark, sf_dir):
    # Late rows: the last day is first written from half of its logs, then run again by itself.
    logs = _enriched(spark, sf_dir)
    day = F.to_date("timestamp")
    last = logs.agg(F.max(day)).first()[0]
    path = shared_path(spark, "slo-daily")
    early = logs.where((day < F.lit(last)) | (F.hour("timestamp") < 12))
    by_day = lambda df: slo_daily(df).withColumn("day", F.col("time_bucket"))
    write_partitions(by_day(early), path, ["day"])
    write_partitions(by_day(logs.where(day == F.lit(last))), path, ["day"])
    return _finish(spark.read.parquet(path).drop("day"))


def q_enrich_logs_hybrid(spark, sf_dir):
    # No broadcast of the host table: the hot host is joined by broadcast, the others by shuffle.
    inputs = fixture_inputs(spark, sf_dir, skewed="host")
    return _finish(enrich_logs(inputs.logs, inputs.hosts, max_broadcast_bytes=0,
                               hot_rows=HOT_TARGET_ROWS))


def q_nulled_cells(spark, sf_dir):
    # Cells that the loader could not read, counted while the coerced rows are written.
    e = _events(spark, sf_dir)
    bad = lambda n, good: F.when(F.col("event_id") % n == 0, F.lit("?")).otherwise(good)
    raw = e.select(
        bad(50, F.col("ts").cast("string")).alias("timestamp"),
        F.col("event_type").alias("service"), F.lit(None).cast("string").alias("host"),
        F.col("event_type").alias("endpoint"), bad(7, F.lit("200")).alias("status_code"),
        bad(11, F.col("value").cast("string")).alias("latency_ms"),
        F.col("user_id").alias("user_id"), F.col("event_id").alias("trace_id"))
    rows, seen = coerce_counted(raw)
    write_parquet(rows, shared_path(spark, "coerced"))
    counts = dict(seen.get)
    total = counts.pop("rows")
    return spark.createDataFrame([(c, n, total) for c, n in counts.items()],
                                 "column string, nulled_cells long, total_rows long")


def q_trim_report(spark, sf_dir):
    root = shared_path(spark, "trim")
    write_parquet(fixture_inputs(spark, sf_dir).logs, f"{root}/logs")
    r = trim_dataset(spark, f"{root}/logs", f"{root}/trimmed", limit=TRIM_1K)
    return spark.createDataFrame([(r.status, r.original_rows, r.kept_rows,
                                   spark.read.parquet(r.target or r.source).count())],
                                 "status string, original_rows long, kept_rows long, read_rows long")


def q_load_nanos(spark, sf_dir):
    # A real INT64 nanosecond file, written by tasks and read back as bigint.
    e = _events(spark, sf_dir)
    path = shared_path(spark, "nanos")
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * F.lit(1000) + F.col("event_id") % F.lit(1000)
    write_nanos(e.select("event_id", "event_type", nanos.alias("t")), path, "t")
    raw = spark.read.parquet(path)
    return _finish(normalize_time(raw.withColumn("ns", F.col("t")), "t"))


def q_salted_endpoint_stats(spark, sf_dir):
    return _finish(salted_endpoint_stats(_enriched(spark, sf_dir)))


def q_partition_skew(spark, sf_dir):
    return _finish(partition_skew(_enriched(spark, sf_dir)))


def q_partition_skew_totals(spark, sf_dir):
    # What does not depend on the hash function: every row is in one partition, and without
    # salt there are no more non-empty partitions than keys.
    logs = _enriched(spark, sf_dir)
    keys = logs.agg(F.count_distinct("endpoint").alias("keys"))
    rows = partition_skew(logs).join(F.broadcast(keys))  # one row
    total = F.round(F.col("avg_partition_rows") * F.col("non_empty_partitions")).cast("long")
    few = (F.col("phase") == "after") | (F.col("non_empty_partitions") <= F.col("keys"))
    return rows.select("phase", total.alias("total_rows"), few.alias("bounded_by_keys"))


def q_skew_study_facts(spark, sf_dir):
    view = pub.vw_skew_benchmark(skew_study(spark, _enriched(spark, sf_dir)))
    return _finish(view.select(
        "top_endpoint", "top_endpoint_share", "salt_buckets", "target_partitions",
        (F.col("before_max_partition_rows") >= F.col("after_max_partition_rows")).alias("no_worse"),
        (F.col("runtime_before_ms") >= 0).alias("timed")))


def q_skew_study(spark, sf_dir):
    return _finish(skew_study(spark, _enriched(spark, sf_dir)))


def _time_source(spark, sf_dir, kind):
    e = _events(spark, sf_dir)
    ts = F.col("ts")
    forms = {
        "timestamp": ts.cast("timestamp"),
        "ns": F.unix_micros(ts.cast("timestamp")) * F.lit(1000),
        "s": F.unix_seconds(ts.cast("timestamp")).cast("int"),
        "string": F.when(F.col("event_id") % 50 == 0, F.lit("not a time"))
                   .otherwise(ts.cast("string")),
        "ntz": ts,
        "date": F.to_date(ts),
    }
    df = e.select("event_id", forms[kind].alias("t"))
    return _finish(normalize_time(df, "t"))


def _normalizer(kind):
    def run(spark, sf_dir):
        return _time_source(spark, sf_dir, kind)
    run.__name__ = f"q_normalize_time_{kind}"
    return run


def q_vw_slo_trends(spark, sf_dir):
    return _finish(pub.vw_slo_trends(slo_hourly(_enriched(spark, sf_dir))))


def q_vw_anomaly_timeline(spark, sf_dir):
    return _finish(pub.vw_anomaly_timeline(anomalies(_enriched(spark, sf_dir))))


def q_vw_deployment_impact(spark, sf_dir):
    inputs = fixture_inputs(spark, sf_dir)
    impact = change_impact(enrich_logs(inputs.logs, inputs.hosts), inputs.deployments)
    return _finish(pub.vw_deployment_impact(impact))


def q_vw_top_offenders(spark, sf_dir):
    return _finish(pub.vw_top_offenders(top_offenders(anomalies(_enriched(spark, sf_dir)))))


def q_vw_skew_benchmark(spark, sf_dir):
    return _finish(pub.vw_skew_benchmark(skew_study(spark, _enriched(spark, sf_dir))))


def q_slo_validation_top20(spark, sf_dir):
    trends = pub.vw_slo_trends(slo_hourly(_enriched(spark, sf_dir)))
    return _finish(pub.slo_validation_top20(trends))


def q_trim_dataset(spark, sf_dir):
    logs = fixture_inputs(spark, sf_dir).logs
    return _finish(trim_frame(logs, order_by=["timestamp", "user_id", "trace_id", "endpoint",
                                              "status_code", "latency_ms"]))


def q_trim_dataset_1k(spark, sf_dir):
    # A cap below the table size, so the ordered cut itself is checked.
    logs = fixture_inputs(spark, sf_dir).logs
    return _finish(trim_frame(logs, TRIM_1K, order_by=["timestamp", "user_id", "trace_id",
                                                     "endpoint", "status_code", "latency_ms"]))


def q_trim_unordered(spark, sf_dir):
    # Which rows are kept is open; how many, and that each is a row of the source, is not.
    logs = fixture_inputs(spark, sf_dir).logs
    kept = trim_frame(logs.repartition("user_id"), TRIM_1K)
    columns = logs.columns
    left = kept.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    right = logs.groupBy(*columns).agg(F.count(F.lit(1)).alias("m"))
    same = [left[c].eqNullSafe(right[c]) for c in columns]
    found = left.join(right, same, "left").select("n", F.coalesce("m", F.lit(0)).alias("m"))
    return found.agg(F.sum("n").alias("kept_rows"),
                     F.sum(F.least("n", "m")).alias("rows_of_source"))


def _written_inputs(spark, sf_dir, fmt):
    """The three inputs written to a fresh folder in ``fmt``, times as text."""
    inputs = fixture_inputs(spark, sf_dir)
    root = shared_path(spark, f"inputs-{fmt}")
    paths = []
    for name in ("logs", "deployments", "hosts"):
        df = getattr(inputs, name)
        if fmt != "parquet":
            df = df.select(*[F.col(f.name).cast("string") if isinstance(f.dataType, T.TimestampType)
                             else F.col(f.name) for f in df.schema.fields])
        writer = df.write.format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(f"{root}/{name}")
        paths.append(f"{root}/{name}")
    return paths


def _round_trip(fmt):
    def run(spark, sf_dir):
        inputs = load_inputs(spark, *_written_inputs(spark, sf_dir, fmt), fmt=fmt)
        return _finish(enrich_logs(inputs.logs, inputs.hosts))
    run.__name__ = f"q_load_{fmt}"
    return run


CATALOG_VIEWS = ["vw_slo_trends", "vw_anomaly_timeline", "vw_deployment_impact", "vw_top_offenders"]
_PUBLISHED: dict[tuple[str, str], tuple[str, str, dict[str, int]]] = {}


def _published(spark, sf_dir):
    """Folder, database and row counts of one pipeline run per session and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PUBLISHED:
        root, counts = shared_path(spark, "outputs"), {}
        run_from_paths(spark, *_written_inputs(spark, sf_dir, "parquet"), output_root=root, counts=counts)
        database = "opsfold_" + hashlib.sha1("".join(key).encode()).hexdigest()[:10]
        pub.publish(spark, root, database=database)
        _PUBLISHED[key] = root, database, counts
    return _PUBLISHED[key]


def q_published_trace_steps(spark, sf_dir):
    return _finish(spark.table(f"{_published(spark, sf_dir)[1]}.session_trace_steps"))


def _catalog_query(name):
    def run(spark, sf_dir):
        return _finish(spark.table(f"{_published(spark, sf_dir)[1]}.{name}"))
    run.__name__ = f"q_catalog_{name}"
    return run


def q_output_counts(spark, sf_dir):
    # Rows of each output as counted while it was written, next to those of its published table.
    _, database, counts = _published(spark, sf_dir)
    rows = None
    for name, written in counts.items():
        part = spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("table_rows")).select(
            F.lit(name).alias("output"), F.lit(written).cast("long").alias("written_rows"), "table_rows")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def q_output_check(spark, sf_dir):
    expected = {path: [] for path in pub.OUTPUT_PATHS.values()}
    expected["user_session_steps"] = ["session_id", "user_id", "step"]
    report = validate_outputs(spark, _published(spark, sf_dir)[0], expected)
    rows = [(r["output"], r["exists"], r["columns_ok"], r["non_empty"]) for r in report]
    return spark.createDataFrame(rows, "output string, present boolean, columns_ok boolean, "
                                       "non_empty boolean")


def q_preview(spark, sf_dir):
    hourly = slo_hourly(_enriched(spark, sf_dir))
    return _finish(preview(hourly, order_by=["service", "endpoint", "region", "time_bucket"]))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: hourly roll-up attributed to the deployment in force (sf0.001)."""
    return q_change_impact(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    qs = {
        "enrich_logs": q_enrich_logs,
        "trace_flows": q_trace_flows,
        "trace_flow_steps": q_trace_flow_steps,
        "session_events": q_session_events,
        "user_sessions": q_user_sessions,
        "user_sessions_8h": q_user_sessions_8h,
        "user_session_steps": q_user_session_steps,
        "session_events_hot_user": q_session_events_hot_user,
        "user_sessions_hot_user": q_user_sessions_hot_user,
        "user_session_steps_hot_user": q_user_session_steps_hot_user,
        "trace_flow_steps_hot_trace": q_trace_flow_steps_hot_trace,
        "user_session_steps_many_hot": q_user_session_steps_many_hot,
        "slo_hourly": q_slo_hourly,
        "slo_daily": q_slo_daily,
        "deployment_intervals": q_deployment_intervals,
        "change_impact": q_change_impact,
        "anomaly_scores": q_anomaly_scores,
        "anomalies": q_anomalies,
        "top_offenders": q_top_offenders,
        "hot_endpoint": q_hot_endpoint,
        "endpoint_stats": q_endpoint_stats,
        "salted_endpoint_stats": q_salted_endpoint_stats,
        "partition_skew": q_partition_skew,
        "partition_skew_totals": q_partition_skew_totals,
        "skew_study": q_skew_study,
        "skew_study_facts": q_skew_study_facts,
        "vw_slo_trends": q_vw_slo_trends,
        "vw_anomaly_timeline": q_vw_anomaly_timeline,
        "vw_deployment_impact": q_vw_deployment_impact,
        "vw_top_offenders": q_vw_top_offenders,
        "vw_skew_benchmark": q_vw_skew_benchmark,
        "slo_validation_top20": q_slo_validation_top20,
        "trim_dataset": q_trim_dataset,
        "trim_dataset_1k": q_trim_dataset_1k,
        "trim_unordered": q_trim_unordered,
        "preview": q_preview,
        "published_trace_steps": q_published_trace_steps,
        "output_check": q_output_check,
        "output_counts": q_output_counts,
        "endpoint_p95_ranks": q_endpoint_p95_ranks,
        "slo_daily_from_sketches": q_slo_daily_from_sketches,
        "merged_percentile_ranks": q_merged_percentile_ranks,
        "salted_p95_ranks": q_salted_p95_ranks,
        "salt_spread": q_salt_spread,
        "change_impact_asof": q_change_impact_asof,
        "change_impact_asof_hot_service": q_change_impact_asof_hot_service,
        "log_attribution": q_log_attribution,
        "trace_flow_arrays": q_trace_flow_arrays,
        "trace_flow_arrays_hot_trace": q_trace_flow_arrays_hot_trace,
        "trace_flow_array_sizes": q_trace_flow_array_sizes,
        "anomaly_scores_split": q_anomaly_scores_split,
        "heavy_users": q_heavy_users,
        "user_sessions_bucketed": q_user_sessions_bucketed,
        "trace_flow_steps_bucketed": q_trace_flow_steps_bucketed,
        "slo_daily_rerun": q_slo_daily_rerun,
        "enrich_logs_hybrid": q_enrich_logs_hybrid,
        "nulled_cells": q_nulled_cells,
        "trim_report": q_trim_report,
        "load_nanos": q_load_nanos,
    }
    for name in CATALOG_VIEWS:
        qs[f"catalog_{name}"] = _catalog_query(name)
    for fmt in ("parquet", "csv", "json"):
        qs[f"load_{fmt}"] = _round_trip(fmt)
    for kind in ("timestamp", "ns", "s", "string", "ntz", "date"):
        qs[f"normalize_time_{kind}"] = _normalizer(kind)
    if llm is not None:
        qs.update(llm.queries())
    if corpus_pipeline is not None:
        qs["pipeline"] = corpus_pipeline.run
    return qs


# --------------------------------------------------------------- oracle side

def _r(expr: str, alias: str) -> str:
    # Through a decimal, so that halves round away from zero as Spark's do.
    guarded = f"cast(round({expr}, {GUARD_DIGITS}) as decimal(38, {GUARD_DIGITS}))"
    return f"cast(round({guarded}, {DIGITS}) as double) + 0.0::double as {alias}"


_ERR = "case when status_code >= 500 then 1.0::double else 0.0::double end"
_SEC = "(epoch_us({0}) // 1000000)"
_TRACE_ORDER = ('"timestamp" nulls first, service nulls first, endpoint nulls first, '
                'status_code nulls first, latency_ms nulls first, host nulls first, '
                'region nulls first')
_USER_ORDER = ('"timestamp" nulls first, service nulls first, endpoint nulls first, '
               'status_code nulls first, latency_ms nulls first, trace_id nulls first')


def _rollup_cte(bucket: str, name: str = "rollup") -> str:
    return f""", {name} as (
  select service, endpoint, region, {bucket} as time_bucket,
         count(*) as request_count, avg(latency_ms) as avg_latency_ms,
         quantile_disc(latency_ms, 0.5) as p50_latency_ms,
         quantile_disc(latency_ms, 0.95) as p95_latency_ms,
         quantile_disc(latency_ms, 0.99) as p99_latency_ms,
         avg({_ERR}) as error_rate
  from enriched group by 1, 2, 3, 4)"""


_HOURLY = _rollup_cte("date_trunc('hour', \"timestamp\")", "hourly")
_DAILY = _rollup_cte("cast(\"timestamp\" as date)", "daily")

_SLO_SELECT = (f"service, endpoint, region, time_bucket, request_count, "
               f"{_r('avg_latency_ms', 'avg_latency_ms')}, {_r('p50_latency_ms', 'p50_latency_ms')}, "
               f"{_r('p95_latency_ms', 'p95_latency_ms')}, {_r('p99_latency_ms', 'p99_latency_ms')}, "
               f"{_r('error_rate', 'error_rate')}")


def _session_ctes(timeout: int) -> str:
    return f""", ev0 as (
  select user_id, "timestamp", service, endpoint, status_code, latency_ms, trace_id,
         row_number() over (partition by user_id order by {_USER_ORDER}) as event_pos,
         lag("timestamp") over (partition by user_id order by {_USER_ORDER}) as prev_ts
  from enriched where user_id is not null),
ev1 as (
  select *, ({_SEC.format('"timestamp"')} - {_SEC.format('prev_ts')}) / 60.0::double as gap_minutes
  from ev0),
ev2 as (
  select *, case when prev_ts is null or gap_minutes > {float(timeout)} then 1 else 0 end
            as is_new_session
  from ev1),
ev as (
  select *, cast(sum(is_new_session) over (partition by user_id order by {_USER_ORDER}
                 rows between unbounded preceding and current row) as bigint) as session_index
  from ev2),
events_s as (
  select *, user_id || '-' || lpad(cast(session_index as varchar), 8, '0') as session_id
  from ev)"""


def _sessions_sql(timeout: int, skewed: bool = False) -> str:
    return oracle_prefix(skewed=skewed) + _session_ctes(timeout) + f"""
select session_id, user_id, min("timestamp") as session_start, max("timestamp") as session_end,
       count(*) as event_count, {_r('avg(latency_ms)', 'avg_latency_ms')},
       {_r('quantile_disc(latency_ms, 0.95)', 'p95_latency_ms')},
       {_r(f'avg({_ERR})', 'error_rate')}
from events_s group by session_id, user_id"""


def _fmt(expr: str, places: int) -> str:
    # Half-up rounding of the shortest decimal form (as Java's %.Nf does) of the
    # value rounded to 9 places (as the library does before formatting).
    return f"cast(cast(cast(round({expr}, 9) as varchar) as decimal(38, {places})) as varchar)"


_SCORES = _HOURLY + f""", base as (
  select service, endpoint, region, time_bucket as hour_bucket, request_count, error_rate,
         p95_latency_ms,
         avg(error_rate) over w as baseline_error_avg,
         stddev_pop(error_rate) over w as baseline_error_std,
         avg(p95_latency_ms) over w as baseline_p95_avg,
         stddev_pop(p95_latency_ms) over w as baseline_p95_std
  from hourly
  window w as (partition by service, endpoint, region order by time_bucket
               rows between 24 preceding and 1 preceding)),
z as (
  select *,
    case when baseline_error_std > 0 then (error_rate - baseline_error_avg) / baseline_error_std end
      as error_zscore,
    case when baseline_p95_std > 0 then (p95_latency_ms - baseline_p95_avg) / baseline_p95_std end
      as p95_zscore,
    baseline_error_avg is not null
      and error_rate > baseline_error_avg + 3.0::double * baseline_error_std as error_anomaly,
    baseline_p95_avg is not null
      and p95_latency_ms > baseline_p95_avg + 3.0::double * baseline_p95_std as latency_anomaly
  from base),
scores as (
  select *,
    greatest(coalesce(error_zscore, 0.0::double), coalesce(p95_zscore, 0.0::double)) as severity,
    concat_ws('; ',
      case when error_anomaly then 'error_rate ' || {_fmt('error_rate', 4)} || ' > baseline '
           || {_fmt('baseline_error_avg', 4)} end,
      case when latency_anomaly then 'p95 ' || {_fmt('p95_latency_ms', 2)} || 'ms > baseline '
           || {_fmt('baseline_p95_avg', 2)} || 'ms' end) as explanation
  from z),
flagged as (select * from scores where error_anomaly or latency_anomaly),
offenders as (
  select service, endpoint, region, count(*) as anomaly_windows, max(severity) as max_severity,
         max(p95_latency_ms) as peak_p95_ms, max(error_rate) as peak_error_rate,
         array_to_string(list_sort(list_distinct(list(explanation))), ' | ') as explanations
  from flagged group by service, endpoint, region)"""

_SCORE_SELECT = ("service, endpoint, region, hour_bucket, request_count, "
                 + ", ".join(_r(c, c) for c in ["error_rate", "p95_latency_ms",
                                                "baseline_error_avg", "baseline_error_std",
                                                "baseline_p95_avg", "baseline_p95_std",
                                                "error_zscore", "p95_zscore"])
                 + f", error_anomaly, latency_anomaly, {_r('severity', 'severity')}, explanation")

_OFFENDER_SELECT = (f"service, endpoint, region, anomaly_windows, "
                    f"{_r('max_severity', 'max_severity')}, {_r('peak_p95_ms', 'peak_p95_ms')}, "
                    f"{_r('peak_error_rate', 'peak_error_rate')}, explanations")

_IMPACT = _HOURLY + f""", di as (
  select service, version, deploy_time,
         lead(deploy_time) over (partition by service
                                 order by deploy_time, version nulls first) as next_deploy_time
  from deployments where deploy_time is not null),
impact as (
  select l.time_bucket, l.service, l.endpoint, l.region, l.request_count, l.avg_latency_ms,
         l.p95_latency_ms, l.error_rate, d.version as deploy_version, d.deploy_time,
         case when d.deploy_time is null then null
              else ({_SEC.format('l.time_bucket')} - {_SEC.format('d.deploy_time')}) / 60.0::double
         end as minutes_since_deploy
  from hourly l left join di d
    on l.service = d.service and l.time_bucket >= d.deploy_time
   and (d.next_deploy_time is null or l.time_bucket < d.next_deploy_time)
   and l.time_bucket <= d.deploy_time + interval 6 hour)"""

_IMPACT_SELECT = ("time_bucket, service, endpoint, region, request_count, "
                  f"{_r('avg_latency_ms', 'avg_latency_ms')}, {_r('p95_latency_ms', 'p95_latency_ms')}, "
                  f"{_r('error_rate', 'error_rate')}, deploy_version, deploy_time, "
                  f"{_r('minutes_since_deploy', 'minutes_since_deploy')}")

_LOG_IMPACT = f""", di as (
  select service, version, deploy_time,
         lead(deploy_time) over (partition by service
                                 order by deploy_time, version nulls first) as next_deploy_time
  from deployments where deploy_time is not null and service is not null)
select l."timestamp", l.service, l.endpoint, l.trace_id, l.status_code, d.deploy_time,
       d.version as deploy_version,
       {_r(f"({_SEC.format('l.timestamp')} - {_SEC.format('d.deploy_time')}) / 60.0::double",
           'minutes_since_deploy')}
from logs l left join di d on l.service = d.service and l."timestamp" >= d.deploy_time
 and (d.next_deploy_time is null or l."timestamp" < d.next_deploy_time)
 and l."timestamp" <= d.deploy_time + interval 6 hour"""

_EPOCH = "timestamp '1970-01-01 00:00:00'"


def _session_events_sql(p: str) -> str:
    return p + _session_ctes(30) + f"""
select user_id, "timestamp", service, endpoint, status_code, {_r('latency_ms', 'latency_ms')},
       trace_id, event_pos, prev_ts, {_r('gap_minutes', 'gap_minutes')}, is_new_session,
       session_index, session_id
from events_s"""


def _session_steps_sql(p: str) -> str:
    return p + _session_ctes(30) + f"""
select session_id, user_id,
       event_pos - min(event_pos) over (partition by user_id, session_index) + 1 as step,
       "timestamp", service, endpoint, status_code, {_r('latency_ms', 'latency_ms')}, trace_id
from events_s"""


def _trace_steps_sql(p: str) -> str:
    return p + f"""
select trace_id, row_number() over (partition by trace_id order by {_TRACE_ORDER}) as step,
       "timestamp", service, endpoint, status_code, {_r('latency_ms', 'latency_ms')}, host, region
from enriched where trace_id is not null"""


def oracle_sql() -> dict[str, str]:
    p = oracle_prefix()
    ps = oracle_prefix(skewed=True)
    logs_cols = ('"timestamp", service, endpoint, host, status_code, '
                 f"{_r('latency_ms', 'latency_ms')}, user_id, trace_id")
    sql = {
        "enrich_logs": p + f"""
select host, "timestamp", service, endpoint, status_code, {_r('latency_ms', 'latency_ms')},
       user_id, trace_id, region, instance_type from enriched""",
        "trace_flows": p + """
select trace_id, min("timestamp") as trace_start, max("timestamp") as trace_end,
       count(*) as event_count
from enriched where trace_id is not null group by trace_id""",
        "trace_flow_steps": _trace_steps_sql(p),
        "session_events": _session_events_sql(p),
        "user_sessions": _sessions_sql(30),
        "user_sessions_8h": _sessions_sql(480),
        "user_session_steps": _session_steps_sql(p),
        "session_events_hot_user": _session_events_sql(ps),
        "user_sessions_hot_user": _sessions_sql(30, skewed=True),
        "user_session_steps_hot_user": _session_steps_sql(ps),
        "trace_flow_steps_hot_trace": _trace_steps_sql(ps),
        "slo_hourly": p + _HOURLY + f"\nselect {_SLO_SELECT} from hourly",
        "slo_daily": p + _DAILY + f"\nselect {_SLO_SELECT} from daily",
        "deployment_intervals": p + """
select service, version, deploy_time,
       lead(deploy_time) over (partition by service
                               order by deploy_time, version nulls first) as next_deploy_time
from deployments where deploy_time is not null and service is not null""",
        "change_impact": p + _IMPACT + f"\nselect {_IMPACT_SELECT} from impact",
        "anomaly_scores": p + _SCORES + f"\nselect {_SCORE_SELECT} from scores",
        "anomalies": p + _SCORES + f"\nselect {_SCORE_SELECT} from flagged",
        "top_offenders": p + _SCORES + f"\nselect {_OFFENDER_SELECT} from offenders",
        "hot_endpoint": p + f""", c as (select endpoint, count(*) as n from enriched group by endpoint),
t as (select cast(sum(n) as bigint) as total from c),
top1 as (select endpoint, n from c order by n desc, endpoint asc nulls first limit 1)
select top1.endpoint, top1.n as request_count, t.total as total_rows,
       {_r('top1.n / t.total', 'share')}
from top1, t""",
        "endpoint_stats": p + f"""
select endpoint, count(*) as request_count, {_r('avg(latency_ms)', 'avg_latency_ms')},
       {_r('quantile_disc(latency_ms, 0.95)', 'p95_latency_ms')}
from enriched group by endpoint""",
        "partition_skew_totals": p + """
select phase, count(*) as total_rows, true as bounded_by_keys
from enriched, (values ('before'), ('after')) as t(phase) group by phase""",
        "skew_study_facts": p + f""", c as (select endpoint, count(*) as n from enriched group by endpoint)
select endpoint as top_endpoint,
       {_r('n / (select sum(n) from c)', 'top_endpoint_share')}, 16::integer as salt_buckets,
       64::integer as target_partitions, true as no_worse, true as timed
from c order by n desc, endpoint asc nulls first limit 1""",
        "user_session_steps_many_hot": _session_steps_sql(p),
        "trim_unordered": p + f"""
select cast(least(count(*), {TRIM_1K}) as bigint) as kept_rows,
       cast(least(count(*), {TRIM_1K}) as bigint) as rows_of_source from logs""",
        "published_trace_steps": _trace_steps_sql(p),
        "output_check": p + """
select output, count(*) > 0 as present, true as columns_ok, count(*) > 0 as non_empty
from enriched, (values """ + ", ".join(f"('{x}')" for x in pub.OUTPUT_PATHS.values()) + """) as t(output)
group by output""",
        "salted_endpoint_stats": p + f"""
select endpoint, count(*) as request_count, {_r('avg(latency_ms)', 'avg_latency_ms')}
from enriched group by endpoint""",
        "vw_slo_trends": p + _HOURLY + f"\nselect {_SLO_SELECT} from hourly",
        "vw_anomaly_timeline": p + _SCORES + f"""
select hour_bucket, service, endpoint, region, request_count, {_r('error_rate', 'error_rate')},
       {_r('p95_latency_ms', 'p95_latency_ms')}, {_r('baseline_error_avg', 'baseline_error_avg')},
       {_r('baseline_p95_avg', 'baseline_p95_avg')}, {_r('severity', 'severity')},
       error_anomaly, latency_anomaly, explanation
from flagged""",
        "vw_deployment_impact": p + _IMPACT + f"\nselect {_IMPACT_SELECT} from impact",
        "vw_top_offenders": p + _SCORES + f"\nselect {_OFFENDER_SELECT} from offenders",
        "slo_validation_top20": p + _HOURLY + """
select service, endpoint, round(avg(p95_latency_ms), 2) as avg_p95_ms
from hourly group by service, endpoint
order by avg_p95_ms desc nulls last, service nulls first, endpoint nulls first
limit 20""",
        "trim_dataset": p + f"""
select {logs_cols} from logs
order by "timestamp" nulls first, user_id nulls first, trace_id nulls first,
         endpoint nulls first, status_code nulls first, latency_ms nulls first
limit 100000""",
        "trim_dataset_1k": p + f"""
select {logs_cols} from logs
order by "timestamp" nulls first, user_id nulls first, trace_id nulls first,
         endpoint nulls first, status_code nulls first, latency_ms nulls first
limit {TRIM_1K}""",
        "preview": p + _HOURLY + f"""
select {_SLO_SELECT} from hourly
order by service nulls first, endpoint nulls first, region nulls first, time_bucket nulls first
limit 20""",
        "normalize_time_timestamp": "select event_id, ts as t from events",
        "normalize_time_ns": f"""
select event_id, {_EPOCH} + to_seconds(cast(trunc(epoch_ns(ts) / 1e9) as bigint)) as t
from events""",
        "normalize_time_s": f"""
select event_id, {_EPOCH} + to_seconds(epoch_us(ts) // 1000000) as t from events""",
        "normalize_time_string": """
select event_id, case when event_id % 50 = 0 then null else ts end as t from events""",
        "normalize_time_ntz": "select event_id, ts as t from events",
        "normalize_time_date": "select event_id, cast(cast(ts as date) as timestamp) as t from events",
    }
    impact = f"\nselect {_IMPACT_SELECT} from impact"
    ranks = ", count(latency_ms) as latency_rows, true as within from enriched"
    sql.update({
        "output_counts": p + _SCORES + _IMPACT.replace(_HOURLY, "") + _session_ctes(30) + _DAILY + """, n as (
select 'session_trace' as output, (select count(distinct trace_id) from enriched) as rows
union all select 'session_trace_steps', (select count(trace_id) from enriched)
union all select 'user_sessions', (select count(distinct session_id) from events_s)
union all select 'user_session_steps', (select count(*) from events_s)
union all select 'slo_hourly', (select count(*) from hourly)
union all select 'slo_daily', (select count(*) from daily)
union all select 'change_impact_attribution', (select count(*) from impact)
union all select 'anomalies', (select count(*) from flagged)
union all select 'top_offenders', (select count(*) from offenders)
union all select 'skew_study', 1)
select output, rows::bigint as written_rows, rows::bigint as table_rows from n""",
        "endpoint_p95_ranks": p + f"\nselect endpoint, 0.95::double as quantile{ranks} group by endpoint",
        "slo_daily_from_sketches": sql["slo_daily"],
        "merged_percentile_ranks": p + f"""
select endpoint, quantile{ranks}, (values (0.5::double), (0.95::double), (0.99::double)) as t(quantile)
group by endpoint, quantile""",
        "salted_p95_ranks": p + f"""
select endpoint, salt_buckets, count(*) as request_count, {_r('avg(latency_ms)', 'avg_latency_ms')}{ranks},
       (values (1::integer), (4::integer), (16::integer), (64::integer)) as t(salt_buckets)
group by endpoint, salt_buckets""",
        "salt_spread": p + """, c as (select endpoint, count(*) as n from enriched group by endpoint),
h as (select endpoint as hot from c order by n desc, endpoint nulls first limit 1)
select endpoint, n as request_count, case when endpoint = hot then 16 else 1 end::bigint as n_salts,
       0::bigint as least_salt, case when endpoint = hot then 15 else 0 end::bigint as greatest_salt
from c, h""",
        "change_impact_asof": p + _IMPACT + impact,
        "change_impact_asof_hot_service": oracle_prefix(skewed="service") + _IMPACT + impact,
        "log_attribution": p + _LOG_IMPACT,
        "trace_flow_arrays": _trace_steps_sql(p),
        "trace_flow_arrays_hot_trace": _trace_steps_sql(ps),
        "trace_flow_array_sizes": ps + f""", s as (
select trace_id, row_number() over (partition by trace_id order by {_TRACE_ORDER}) as step
from enriched where trace_id is not null)
select trace_id, ((step - 1) // {FLOW_ARRAY_STEPS})::bigint as part, count(*)::integer as n_steps
from s group by 1, 2""",
        "anomaly_scores_split": p + _SCORES + f"\nselect {_SCORE_SELECT} from scores",
        "heavy_users": ps + f"""
select user_id, count(*) as request_count from enriched group by user_id
having count(*) > (select floor(count(*) * {HEAVY_SHARE}) from enriched)""",
        "user_sessions_bucketed": _sessions_sql(30),
        "trace_flow_steps_bucketed": _trace_steps_sql(p),
        "slo_daily_rerun": sql["slo_daily"],
        "enrich_logs_hybrid": sql["enrich_logs"].replace(p, oracle_prefix(skewed="host")),
        "nulled_cells": """
select unnest(['timestamp', 'service', 'host', 'endpoint', 'status_code', 'latency_ms', 'user_id',
               'trace_id']) as "column",
       unnest([count(*) filter (event_id % 50 = 0), 0, 0, 0, count(*) filter (event_id % 7 = 0),
               count(*) filter (event_id % 11 = 0), 0, 0])::bigint as nulled_cells,
       count(*) as total_rows
from events""",
        "trim_report": p + f"""
select case when count(*) > {TRIM_1K} then 'trimmed' else 'skipped' end as status,
       count(*) as original_rows, least(count(*), {TRIM_1K}) as kept_rows,
       least(count(*), {TRIM_1K}) as read_rows from logs""",
        "load_nanos": f"""
select event_id, event_type, (epoch_us(ts) * 1000 + event_id % 1000)::bigint as ns,
       {_EPOCH} + to_seconds((epoch_us(ts) * 1000 + event_id % 1000) // 1000000000) as t
from events""",
    })
    sql.update({f"catalog_{name}": sql[name] for name in CATALOG_VIEWS})
    sql.update({f"load_{fmt}": sql["enrich_logs"] for fmt in ("parquet", "csv", "json")})
    if llm is not None:
        sql.update(llm.oracle_sql())
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
