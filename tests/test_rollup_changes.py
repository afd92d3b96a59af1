"""SLO roll-up and attribution rules."""

from __future__ import annotations

import datetime as dt

from opsfold.operators.changes import change_impact, deployment_intervals, deployments_in_force
from opsfold.operators.rollup import hourly_rollup, slo_daily, slo_hourly
from tests.helpers import deploys_df, log, logs_df, t


def test_error_rule(spark):
    df = logs_df(spark, [log(t(1), status=s) for s in (499, 500, None, 200)])
    assert slo_hourly(df).first()["error_rate"] == 0.25


def test_null_latency(spark):
    df = logs_df(spark, [log(t(1), latency=v) for v in (1.0, 2.0, None)])
    r = slo_hourly(df).first()
    assert (r["request_count"], r["avg_latency_ms"], r["p95_latency_ms"]) == (3, 1.5, 2.0)


def test_percentiles_are_observed_values(spark):
    df = logs_df(spark, [log(t(1), latency=float(v)) for v in range(1, 101)])
    r = slo_hourly(df).first()
    assert (r["p50_latency_ms"], r["p95_latency_ms"], r["p99_latency_ms"]) == (50.0, 95.0, 99.0)


def test_hourly_adds_up_to_daily(spark):
    df = logs_df(spark, [log(t(h, m), endpoint=f"/{h % 3}") for h in range(24) for m in (0, 30)])
    hourly = slo_hourly(df).groupBy("endpoint").sum("request_count").collect()
    daily = slo_daily(df).groupBy("endpoint").sum("request_count").collect()
    assert sorted(map(tuple, hourly)) == sorted(map(tuple, daily))
    assert isinstance(slo_daily(df).first()["time_bucket"], dt.date)


def _impact(spark, deploys, buckets, hours=6, service="svc", broadcast=None):
    logs = logs_df(spark, [log(b, service=service) for b in buckets])
    return {r["time_bucket"]: r for r in change_impact(
        logs, deploys_df(spark, deploys), window_hours=hours, broadcast=broadcast).collect()}


def test_mid_hour_deploy(spark):
    got = _impact(spark, [("svc", "v1", t(10, 15))], [t(10), t(11)])
    assert got[t(10)]["deploy_version"] is None
    assert got[t(11)]["deploy_version"] == "v1" and got[t(11)]["minutes_since_deploy"] == 45.0


def test_window_edge_inclusive(spark):
    got = _impact(spark, [("svc", "v1", t(10))], [t(16), t(17)])
    assert got[t(16)]["deploy_version"] == "v1"
    assert got[t(17)]["deploy_version"] is None


def test_replacement_half_open(spark):
    got = _impact(spark, [("svc", "v1", t(10)), ("svc", "v2", t(12))], [t(11), t(12)])
    assert got[t(11)]["deploy_version"] == "v1"
    assert got[t(12)]["deploy_version"] == "v2" and got[t(12)]["minutes_since_deploy"] == 0.0


def test_no_deploy_keeps_row(spark):
    for broadcast in (True, False):
        got = _impact(spark, [("other", "v1", t(10))], [t(11)], broadcast=broadcast)
        assert list(got) == [t(11)] and got[t(11)]["deploy_time"] is None
        assert got[t(11)]["minutes_since_deploy"] is None


def test_equal_deploy_times_highest_version_wins(spark):
    got = _impact(spark, [("svc", "v1", t(10)), ("svc", "v2", t(10))], [t(10)])
    assert got[t(10)]["deploy_version"] == "v2"
    iv = {r["version"]: r["next_deploy_time"] for r in deployment_intervals(
        deploys_df(spark, [("svc", "v1", t(10)), ("svc", "v2", t(10)), ("svc", "v3", t(12))])
    ).collect()}
    assert iv == {"v1": t(10), "v2": t(12), "v3": None}


def test_newer_deploy_outside_window_hides_older(spark):
    # the deploy in force is the latest one; an older one is never attributed after it
    got = _impact(spark, [("svc", "v1", t(0)), ("svc", "v2", t(2, 30))], [t(1), t(2), t(3)],
                  hours=1)
    assert got[t(1)]["deploy_version"] == "v1"
    assert got[t(2)]["deploy_version"] is None
    assert got[t(3)]["deploy_version"] == "v2"


def test_attribution_keeps_rollup_rows(spark):
    logs = logs_df(spark, [log(t(h), endpoint=e) for h in range(30) for e in ("/a", "/b")])
    deps = deploys_df(spark, [("svc", f"v{i}", t(i * 3, 20)) for i in range(10)])
    assert change_impact(logs, deps).count() == hourly_rollup(logs).count()


def test_deploy_hours_unique_per_service_hour(spark):
    deps = deploys_df(spark, [("svc", "v1", t(10)), ("svc", "v2", t(11, 30)),
                              ("svc", None, t(9)), ("x", "v", None)])
    owners = deployments_in_force(deps)
    assert owners.count() == owners.select("service", "time_bucket").distinct().count()


def test_attribution_broadcast_follows_the_proven_byte_bound(spark):
    """(N+1) x deployments bounds the (service, hour) table."""
    logs = logs_df(spark, [log(t(h)) for h in range(9, 20)])
    deploys = deploys_df(spark, [("svc", "v1", t(10)), ("svc", "v2", t(12))])
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        results, plans = {}, {}
        size = 7 * (2 * 3 * 8 + 2 * 3 + 2 * 2)
        for limit in (size, size - 7):
            df = change_impact(logs, deploys, window_hours=6, max_broadcast_bytes=limit)
            results[limit] = sorted((r["time_bucket"], r["deploy_version"]) for r in df.collect())
            plans[limit] = df._jdf.queryExecution().executedPlan().toString()
        assert results[size] == results[size - 7]
        assert [v for _, v in results[size]] == [None, "v1", "v1"] + ["v2"] * 7 + [None]
        assert "BroadcastHashJoin" in plans[size]
        assert "BroadcastHashJoin" not in plans[size - 7] and "SortMergeJoin" in plans[size - 7]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
