"""As-of joins, carried values, rolling frames over split keys and bounded flow arrays."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from opsfold.operators.anomalies import anomaly_scores
from opsfold.operators.asof import asof_join
from opsfold.operators.changes import attributed, change_impact, change_impact_asof
from opsfold.operators.enrich import enrich_logs
from opsfold.operators.frames import rolling
from opsfold.operators.scan import keyed_scan
from opsfold.operators.sessions import (
    TRACE_FLOW_FIELDS,
    flow_arrays,
    flow_steps,
    trace_flow_steps,
    trace_flows,
)
from opsfold.plans.fixtures import fixture_inputs
from tests.conftest import SF01
from tests.helpers import DAY, deploys_df, log, logs_df, t


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("target_rows", [10_000, 15, 3])
def test_carried_value_matches_a_window(spark, target_rows):
    rng = random.Random(3)
    rows = [("hot" if i % 2 else f"k{i % 5}", i // 3, rng.choice([None, None, None, i])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    got = keyed_scan(df, ["k"], ["t", "v"], "t", carry="v", carried="c", target_rows=target_rows)
    w = (Window.partitionBy("k").orderBy(F.col("t").asc_nulls_first(), F.col("v").asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, 0))
    want = df.withColumn("c", F.last("v", ignorenulls=True).over(w))
    assert rows_of(got.select("k", "t", "v", "c")) == rows_of(want)


def sides(seed):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot", "hot", "a", "b", None])
    at = lambda: rng.choice([None] + [DAY + dt.timedelta(minutes=rng.randrange(400))] * 9)
    left = [(key(), at(), i) for i in range(300)] + [("hot", DAY, -1)] * 2
    right = [(key(), at(), rng.choice(["v1", "v2", None]), i % 4) for i in range(60)]
    return left, right


def plain_asof(left, right, limit):
    out = Counter()
    null_first = lambda r: (r[1], r[2] is not None, r[2] or "", r[3])
    for k, at, x in left:
        fit = [r for r in right if k is not None and at is not None and r[0] == k and r[1] is not None
               and r[1] <= at]
        best = max(fit, key=null_first, default=None)
        if best is not None and limit is not None and at > best[1] + limit:
            best = None
        out[(k, at, x, *(best[1:] if best else (None, None, None)))] += 1
    return out


@pytest.mark.parametrize("target_rows", [10_000, 20, 3])
def test_asof_join(spark, target_rows):
    left, right = sides(target_rows)
    lefts = spark.createDataFrame(left, "k string, t timestamp, x int")
    rights = spark.createDataFrame(right, "k string, rt timestamp, version string, n int")
    for limit, tolerance in ((None, None), (dt.timedelta(minutes=25), F.expr("interval 25 minutes"))):
        got = asof_join(lefts, rights, ["k"], "t", "rt", ["version", "n"], tolerance=tolerance,
                        target_rows=target_rows)
        assert got.columns == ["k", "t", "x", "rt", "version", "n"]
        assert rows_of(got) == plain_asof(left, right, limit)
    none = asof_join(lefts, rights.limit(0), ["k"], "t", "rt", ["version"], target_rows=target_rows)
    assert none.where("rt is not null").count() == 0 and none.count() == len(left)


def test_asof_attribution_equals_the_expanded_join(spark):
    inputs = fixture_inputs(spark, SF01, skewed="service")
    logs = enrich_logs(inputs.logs, inputs.hosts)
    want = change_impact(logs, inputs.deployments)
    got = change_impact_asof(logs, inputs.deployments, target_rows=700)
    assert rows_of(got) == rows_of(want)
    # no row of the right side is multiplied by hours
    assert "sequence(" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_attribution_of_single_rows(spark):
    logs = logs_df(spark, [log(t(10, 14, 59)), log(t(10, 15)), log(t(16, 15)), log(t(16, 15, 1))])
    deploys = deploys_df(spark, [("svc", "v1", t(10, 15)), ("svc", "v2", None)])
    got = {r["timestamp"]: (r["deploy_version"], r["minutes_since_deploy"])
           for r in attributed(logs, deploys, time="timestamp").collect()}
    assert got == {t(10, 14, 59): (None, None), t(10, 15): ("v1", 0.0), t(16, 15): ("v1", 360.0),
                   t(16, 15, 1): (None, None)}


@pytest.mark.parametrize("target_rows,preceding", [(10_000, 24), (3, 24), (30, 24), (50, 1), (7, 7)])
def test_rolling_frames(spark, target_rows, preceding):
    rng = random.Random(preceding)
    rows = [("hot" if i % 4 else f"k{i % 3}", i, rng.choice([None, float(rng.randrange(9))])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t int, x double")
    make = {"n": lambda w: F.count("x").over(w), "total": lambda w: F.sum("x").over(w),
            "first": lambda w: F.first("t").over(w)}
    got = rolling(df, ["k"], ["t"], preceding, make, target_rows=target_rows)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(-preceding, -1)
    want = df.withColumns({name: f(w) for name, f in make.items()})
    assert got.columns == want.columns and rows_of(got) == rows_of(want)


def test_split_anomaly_scores_equal_whole_series(spark):
    rows = [log(t(h % 24, day=h // 24), latency=float(h % 11), status=500 if h % 17 == 0 else 200,
                endpoint="/hot" if h % 5 else "/cold") for h in range(240)]
    df = logs_df(spark, rows)
    assert rows_of(anomaly_scores(df, target_rows=3)) == rows_of(anomaly_scores(df))


def test_flow_arrays_are_bounded_and_whole(spark):
    inputs = fixture_inputs(spark, SF01, skewed=True)
    steps = trace_flow_steps(enrich_logs(inputs.logs, inputs.hosts), target_rows=1000)
    arrays = flow_arrays(steps, ["trace_id"], TRACE_FLOW_FIELDS, max_steps=50)
    sizes = arrays.select("trace_id", "part", F.size("request_flow").alias("n")).collect()
    assert max(r["n"] for r in sizes) == 50
    assert sum(r["trace_id"] == "t-hot" for r in sizes) == -(-sum(
        r["n"] for r in sizes if r["trace_id"] == "t-hot") // 50)
    back = flow_steps(arrays, ["trace_id"], TRACE_FLOW_FIELDS)
    assert rows_of(back.select(steps.columns)) == rows_of(steps)
    # a flow that fits is the nested flow of the trace, with step numbers
    few = logs_df(spark, [log(t(0, m), endpoint=f"/{m}") for m in (3, 1, 2)])
    (flow,) = flow_arrays(trace_flow_steps(few), ["trace_id"], TRACE_FLOW_FIELDS).collect()
    whole = trace_flows(few, include_flow=True).first()["request_flow"]
    assert [tuple(e)[1:] for e in flow["request_flow"]] == [tuple(e) for e in whole]
    assert [e["step"] for e in flow["request_flow"]] == [1, 2, 3]
