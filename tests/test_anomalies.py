"""Anomaly scoring rules and offender ranking."""

from __future__ import annotations

from opsfold.operators.anomalies import anomalies, anomaly_scores, top_offenders
from tests.helpers import log, logs_df, t


def _series(spark, rates, hours=None):
    """One log row per hour; the error rate of a bucket is 0 or 1 per row."""
    hours = hours or list(range(len(rates)))
    rows = []
    for h, r in zip(hours, rates):
        # two rows per bucket so that rate 0.5 is expressible
        n_err = round(r * 2)
        rows += [log(t(h), status=500 if i < n_err else 200, latency=10.0) for i in range(2)]
    return logs_df(spark, rows)


def _by_hour(df):
    return {r["hour_bucket"]: r for r in df.collect()}


def test_first_bucket_never_flagged(spark):
    r = anomaly_scores(_series(spark, [1.0])).first()
    assert r["error_anomaly"] is False and r["latency_anomaly"] is False
    assert r["baseline_error_avg"] is None


def test_zero_deviation_rise_flagged_with_zero_severity(spark):
    got = _by_hour(anomaly_scores(_series(spark, [0, 0, 0.5])))
    last = got[t(2)]
    assert last["error_anomaly"] is True
    assert last["error_zscore"] is None and last["severity"] == 0.0
    assert last["explanation"] == "error_rate 0.5000 > baseline 0.0000"


def test_drop_not_flagged(spark):
    got = _by_hour(anomaly_scores(_series(spark, [1, 0.5, 0])))
    assert not any(r["error_anomaly"] for r in got.values())


def test_baseline_uses_observed_buckets(spark):
    got = _by_hour(anomaly_scores(_series(spark, [0, 0.5, 1], hours=[0, 5, 6]),
                                  baseline_hours=2))
    assert got[t(6)]["baseline_error_avg"] == 0.25
    assert got[t(6)]["baseline_error_std"] == 0.25


def test_both_flags_explanation_and_offenders(spark):
    rows = []
    for h in range(4):
        bad = h == 3
        rows += [log(t(h), status=500 if bad else 200, latency=100.0 if bad else 10.0)]
    df = logs_df(spark, rows)
    flagged = anomalies(df)
    assert flagged.count() == 1
    r = flagged.first()
    assert r["error_anomaly"] and r["latency_anomaly"]
    assert r["explanation"].startswith("error_rate 1.0000 > baseline 0.0000; p95 100.00ms")
    off = top_offenders(flagged).first()
    assert off["anomaly_windows"] == 1 and off["explanations"] == r["explanation"]
    assert r["severity"] >= 0


def test_offenders_sorted_and_deduplicated(spark):
    rows = []
    for ep, spike in (("/a", 50.0), ("/b", 500.0)):
        for h in range(6):
            rows.append(log(t(h), endpoint=ep, latency=spike if h in (3, 5) else 10.0 + h % 2))
    ranked = top_offenders(anomalies(logs_df(spark, rows))).collect()
    assert [r["endpoint"] for r in ranked] == ["/b", "/a"]
    parts = ranked[0]["explanations"].split(" | ")
    assert parts == sorted(set(parts))


def test_format_guard_rounds_half_up(spark):
    # baseline avg of 38.57 and 38.58 is 38.575 up to float noise: printed 38.58
    rows = [log(t(0), latency=38.57), log(t(1), latency=38.58), log(t(2), latency=300.0)]
    r = anomalies(logs_df(spark, rows)).where("hour_bucket = '2024-01-01 02:00:00'").first()
    assert r["explanation"] == "p95 300.00ms > baseline 38.58ms"
