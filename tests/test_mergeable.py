"""Sketches, exact selection, heavy hitters and salted percentiles."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from opsfold.operators.heavy import can_sketch, heavy_candidates, heavy_hitters
from opsfold.operators.rollup import PERCENTILES, slo_daily
from opsfold.operators.selection import exact_quantile
from opsfold.operators.sketches import (
    daily_from_hourly,
    hourly_sketches,
    latency_sketch,
    merge_sketches,
    percentiles_of,
    rank_check,
    rank_error,
)
from opsfold.operators.skew import salted_endpoint_stats
from opsfold.plans.fixtures import fixture_inputs
from opsfold.operators.enrich import enrich_logs
from tests.conftest import SF01
from tests.helpers import log, logs_df, t


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rounded(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r) for r in df.collect())


def test_days_from_hourly_sketches(spark, tmp_dir):
    rows = [log(t(h, m), endpoint=f"/{h % 2}", status=500 if m % 9 == 0 else 200,
                latency=None if m % 4 == 0 else float(h * m % 37))
            for h in range(24) for m in range(0, 60, 3)]
    rows.append(log(t(3, day=1), endpoint="/null", latency=None))
    df = logs_df(spark, rows)
    hourly_sketches(df).write.parquet(f"{tmp_dir}/hourly")
    stored = spark.read.parquet(f"{tmp_dir}/hourly")
    got = daily_from_hourly(stored)
    text = plan(got)
    assert text.count("FileScan") == 1 and "latency_sketch" in text and "latency_ms#" not in text.split("FileScan")[1]
    assert rounded(got) == rounded(slo_daily(df))


def test_merged_percentiles_stay_within_the_rank_error(spark):
    logs = spark.range(60_000).select(
        F.lit("/e").alias("endpoint"), F.pmod(F.xxhash64("id"), F.lit(40)).alias("part"),
        F.pow(F.rand(3), 4).alias("latency_ms"))
    parts = logs.groupBy("endpoint", "part").agg(
        F.count(F.lit(1)).alias("request_count"), F.sum("latency_ms").alias("latency_sum"),
        F.count("latency_ms").alias("latency_n"), F.lit(0.0).alias("error_sum"),
        latency_sketch(k=200).alias("latency_sketch"))
    merged = merge_sketches(parts, ["endpoint"])
    found = merged.select("endpoint", *[c.alias(f"q{i}") for i, c in enumerate(
        percentiles_of("latency_sketch", "latency_n", PERCENTILES))])
    checks = rank_check(logs, found, ["endpoint"], PERCENTILES, k=200).collect()
    assert [r["within"] for r in checks] == [True] * 3 and checks[0]["latency_rows"] == 60_000
    # a value far off, and one that no row holds, are told apart
    wrong = found.select("endpoint", F.lit(0.9).alias("q0"), (F.col("q1") * 1.2).alias("q1"),
                         F.lit(5.0).alias("q2"))
    assert [r["within"] for r in rank_check(logs, wrong, ["endpoint"], PERCENTILES, k=200).collect()] \
        == [False] * 3
    assert rank_error(800) < rank_error(200) < 0.03


@pytest.mark.parametrize("buckets", [0, 1, 5, 16, 64])
def test_salted_p95(spark, buckets):
    logs = enrich_logs(*[getattr(fixture_inputs(spark, SF01), n) for n in ("logs", "hosts")])
    stats = salted_endpoint_stats(logs, salt_buckets=buckets, with_p95=True)
    found = stats.select("endpoint", F.col("p95_latency_ms").alias("q0"))
    checks = rank_check(logs, found, ["endpoint"], [0.95]).collect()
    assert len(checks) == 5 and all(r["within"] for r in checks)


@pytest.mark.parametrize("target_rows", [10_000, 20, 3])
def test_exact_quantile(spark, target_rows):
    rng = random.Random(5)
    rows = [("hot" if i % 3 else f"k{i % 7}", None if i % 50 == 0 else float(rng.randrange(60)))
            for i in range(900)] + [(None, 1.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    groups = defaultdict(list)
    for k, x in rows:
        if x is not None:
            groups[k].append(x)
    for q in (0.0, 0.5, 0.95, 1.0):
        got = {r["k"]: r["quantile"] for r in
               exact_quantile(df, ["k"], "x", q, target_rows=target_rows).collect()}
        want = {}
        for k, xs in groups.items():
            n = len(xs)
            want[k] = sorted(xs)[max(1, n - int(n - q * n)) - 1]
        assert got == want


def test_heavy_hitters_are_exact_and_count_only_candidates(spark):
    rng = random.Random(9)
    keys = ["hot"] * 4000 + [f"m{i % 20}" for i in range(3000)] + [f"c{i}" for i in range(5000)] + [None] * 500
    rng.shuffle(keys)
    df = spark.createDataFrame([(k, i % 2 if k == "hot" else 0) for i, k in enumerate(keys)], "k string, j int")
    df = df.repartition(8)
    for names, pick in ((["k"], lambda r: r[0]), (["k", "j"], lambda r: r)):
        counts = Counter(pick((k, i % 2 if k == "hot" else 0)) for i, k in enumerate(keys))
        for least in (100, 149, 400, 1999, 20_000):
            got = {tuple(r)[:-1]: r["_cnt"] for r in heavy_hitters(df, names, least).collect()}
            assert got == {k if isinstance(k, tuple) else (k,): n for k, n in counts.items() if n > least}
    found = heavy_hitters(df, ["k"], 400)
    # all rows meet the candidates before they are grouped
    grouped, _, below = plan(found).partition("partial_count(1)")
    assert "LeftSemi" not in grouped and "LeftSemi" in below and "keys=[k" not in below
    assert heavy_candidates(df, ["k"], 400 / len(keys)).count() <= 2 * len(keys) / 400
    assert not can_sketch(1e-9)
    with pytest.raises(ValueError):
        heavy_candidates(df, ["k"], 1e-9)
    assert heavy_hitters(df.limit(0), ["k"], 5).collect() == []
