"""Loader coercion, time normalisation, file formats, sinks, trim and host enrichment."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from opsfold.operators.enrich import dedupe_hosts, enrich_logs
from opsfold.sources.readers import coerce_logs, load_inputs, normalize_time, read_table
from opsfold.sources.sinks import (
    first_rows,
    preview,
    trim_dataset,
    trim_frame,
    validate_outputs,
    write_parquet,
)
from tests.helpers import log, logs_df, t

EPOCH_2024 = 1704067200  # 2024-01-01 00:00:00 UTC


def _one(df, col="ts"):
    return [r[col] for r in df.orderBy("id").collect()]


def test_time_forms(spark):
    ns = spark.createDataFrame([(1, EPOCH_2024 * 10**9 + 999_999_000), (2, None)],
                               "id int, ts bigint")
    assert _one(normalize_time(ns, "ts")) == [t(0, 0, 0), None]
    assert _one(normalize_time(ns, "ts", keep_fraction=True)) == [t(0, 0, 0, 999_999), None]
    ms = spark.createDataFrame([(1, EPOCH_2024 * 1000 + 1500)], "id int, ts bigint")
    assert _one(normalize_time(ms, "ts", time_unit="ms")) == [t(0, 0, 1)]
    secs = spark.createDataFrame([(1, EPOCH_2024 + 61)], "id int, ts int")
    assert _one(normalize_time(secs, "ts")) == [t(0, 1, 1)]
    text = spark.createDataFrame([(1, "2024-01-01 00:00:05.25"), (2, "garbage")],
                                 "id int, ts string")
    assert _one(normalize_time(text, "ts")) == [t(0, 0, 5, 250_000), None]
    other = spark.createDataFrame([(1, dt.date(2024, 1, 2))], "id int, ts date")
    assert _one(normalize_time(other, "ts")) == [t(day=1)]
    ntz = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 3, 4, 5, 6))], "id int, ts timestamp_ntz")
    assert _one(normalize_time(ntz, "ts")) == [t(3, 4, 5, 6)]
    with pytest.raises(ValueError):
        normalize_time(ns, "ts", time_unit="weeks")
    double = spark.createDataFrame([(1, 1.7e9)], "id int, ts double")
    assert _one(normalize_time(double, "ts")) == [None]


def test_ntz_and_date_equal_their_string_parse_in_any_zone(spark):
    """The direct cast gives the instant the string route would, DST gaps included."""
    values = [(1, dt.datetime(2024, 3, 10, 2, 30)), (2, dt.datetime(2024, 11, 3, 1, 30)),
              (3, dt.datetime(1969, 12, 31, 23, 59, 59, 999_999)), (4, None)]
    ntz = spark.createDataFrame(values, "id int, ts timestamp_ntz")
    dates = ntz.select("id", F.to_date("ts").alias("ts"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("America/Los_Angeles", "Asia/Kolkata", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            for df in (ntz, dates):
                got = normalize_time(df, "ts").select("id", F.unix_micros("ts").alias("us"))
                want = df.select("id", F.unix_micros(F.try_to_timestamp(F.col("ts").cast("string")))
                                 .alias("us"))
                assert _one(got, "us") == _one(want, "us"), tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_coercion_bad_cells_become_null_and_extras_pass(spark):
    raw = spark.createDataFrame(
        [("2024-01-01 00:00:00", "s", "h", "/e", "5xx", "1.5", 7, "t", "extra")],
        "timestamp string, service string, host string, endpoint string, status_code string, "
        "latency_ms string, user_id int, trace_id string, note string")
    r = coerce_logs(raw).first()
    assert r["status_code"] is None and r["latency_ms"] == 1.5
    assert r["user_id"] == "7" and r["note"] == "extra"
    with pytest.raises(ValueError):
        coerce_logs(raw.drop("endpoint"))


def test_formats_give_same_table(spark, tmp_dir):
    rows = [("2024-01-01 01:00:00", "svc", "h1", "/a", 200, 1.5, "u1", "t1"),
            ("2024-01-01 02:30:00", "svc", "h2", "/b", 503, 2.5, "u2", None)]
    df = spark.createDataFrame(rows, "timestamp string, service string, host string, "
                               "endpoint string, status_code int, latency_ms double, "
                               "user_id string, trace_id string")
    hosts = spark.createDataFrame([("h1", "eu", "m")], "host string, region string, instance_type string")
    deps = spark.createDataFrame([("svc", "v1", "2024-01-01 00:00:00")],
                                 "service string, version string, deploy_time string")
    tables = {}
    for fmt in ("parquet", "csv", "json"):
        paths = {}
        for name, frame in (("logs", df), ("deploys", deps), ("hosts", hosts)):
            path = os.path.join(tmp_dir, fmt, name)
            writer = frame.write.mode("overwrite").format(fmt)
            if fmt == "csv":
                writer = writer.option("header", "true")
            writer.save(path)
            paths[name] = path
        inputs = load_inputs(spark, paths["logs"], paths["deploys"], paths["hosts"], fmt=fmt)
        cols = ["timestamp", "service", "host", "endpoint", "status_code", "latency_ms",
                "user_id", "trace_id"]
        tables[fmt] = sorted(tuple(r) for r in inputs.logs.select(*cols).collect())
        assert inputs.deployments.first()["deploy_time"] == t(0)
    assert tables["parquet"] == tables["csv"] == tables["json"]
    assert read_table(spark, os.path.join(tmp_dir, "csv", "hosts"), "csv").count() == 1


def test_enrich_unknown_duplicates_and_existing_region(spark):
    logs = logs_df(spark, [log(t(0), host="h1"), log(t(1), host="h9"), log(t(2), host=None)])
    hosts = spark.createDataFrame(
        [("h1", "zeta", "big"), ("h1", "alpha", "small"), ("h1", None, "a"), (None, "x", "y")],
        "host string, region string, instance_type string")
    for broadcast in (True, False, None):
        got = {r["host"]: (r["region"], r["instance_type"])
               for r in enrich_logs(logs, hosts, broadcast=broadcast).collect()}
        assert got == {"h1": ("alpha", "small"), "h9": ("unknown", "unknown"),
                       None: ("unknown", "unknown")}
        assert enrich_logs(logs, hosts, broadcast=broadcast).count() == 3
    assert dedupe_hosts(hosts).count() == 1


def test_sinks_preview_validate(spark, tmp_dir):
    df = spark.range(50).withColumn("v", F.col("id") * 2)
    path = write_parquet(df, os.path.join(tmp_dir, "out", "x"))
    assert [r["id"] for r in preview(spark.read.parquet(path), 3, ["id"]).collect()] == [0, 1, 2]
    report = validate_outputs(spark, os.path.join(tmp_dir, "out"), {"x": ["id", "v"], "y": ["id"]})
    assert report[0]["exists"] and report[0]["columns_ok"] and report[0]["non_empty"]
    assert not report[1]["exists"]


def test_trim_never_overwrites_input(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    spark.range(10).write.parquet(src)
    res = trim_dataset(spark, src, os.path.join(tmp_dir, "dst"), limit=4, order_by=["id"])
    assert (res.status, res.original_rows, res.kept_rows) == ("trimmed", 10, 4)
    assert spark.read.parquet(src).count() == 10
    plain = trim_dataset(spark, src, os.path.join(tmp_dir, "dst3"), limit=4)
    assert (plain.status, plain.kept_rows) == ("trimmed", 4)
    small = trim_dataset(spark, src, os.path.join(tmp_dir, "dst2"), limit=40)
    assert (small.status, small.target) == ("skipped", None)
    with pytest.raises(ValueError):
        trim_dataset(spark, src, src, limit=4)


def test_parquet_nanos_read_as_bigint_then_normalised(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = os.path.join(tmp_dir, "nanos.parquet")
    ns = [EPOCH_2024 * 10**9 + 5 * 10**9 + 123, None]
    table = pa.table({"id": [1, 2], "ts": pa.array(ns, type=pa.timestamp("ns"))})
    pq.write_table(table, path, version="2.6", coerce_timestamps=None)
    raw = spark.read.parquet(path)
    assert raw.schema["ts"].dataType.typeName() == "long"
    assert _one(normalize_time(raw, "ts")) == [t(0, 0, 5), None]


def test_first_rows_exact_without_a_row_limit(spark, tmp_dir):
    path = os.path.join(tmp_dir, "many")
    spark.range(0, 1000, 1, 7).write.parquet(path)
    src = spark.read.parquet(path)
    sizes = sorted(r["n"] for r in src.groupBy(F.spark_partition_id().alias("p"))
                   .agg(F.count(F.lit(1)).alias("n")).collect())
    assert len(sizes) > 1
    # mid-partition, exact partition boundary, everything, more than everything
    for limit in (1, 250, sizes[0], 999, 1000, 5000):
        got = first_rows(src, limit)
        rows = [r["id"] for r in got.collect()]
        assert len(rows) == min(limit, 1000), limit
        assert len(set(rows)) == len(rows)
    got = first_rows(src, 250)
    got.write.format("noop").mode("overwrite").save()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in plan and "LocalLimit" not in plan
    assert trim_frame(src, 3, order_by=["id"]).collect() == [(0,), (1,), (2,)]


def test_broadcast_decision_follows_the_proven_byte_bound(spark):
    """The raw host rows bound the de-duplicated ones; no limit collects rows in one task."""
    logs = logs_df(spark, [log(t(0), host="h1"), log(t(1), host="h2")])
    hosts = spark.createDataFrame([("h1", "eu", "a"), ("h1", "eu", "b"), ("h1", "us", "c"),
                                   ("h2", "us", "d")],
                                  "host string, region string, instance_type string")
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {}
        size = 4 * 3 * 8 + 4 * 2 + 4 * 2 + 4  # eight bytes a column, and the texts
        for limit in (size, size - 1):
            df = enrich_logs(logs, hosts, max_broadcast_bytes=limit)
            got = sorted((r["host"], r["region"], r["instance_type"]) for r in df.collect())
            assert got == [("h1", "eu", "a"), ("h2", "us", "d")]
            plans[limit] = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plans[size]
        assert "BroadcastHashJoin" not in plans[size - 1] and "SortMergeJoin" in plans[size - 1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
