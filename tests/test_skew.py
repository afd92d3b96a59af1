"""Skew study: hot key, salting (rules 20-21, D1, D4), partition profile, timings."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from opsfold.functions.columns import salt
from opsfold.operators.skew import (
    endpoint_stats,
    hot_endpoint,
    partition_skew,
    salted_endpoint_stats,
    skew_study,
)
from tests.conftest import SF01
from tests.helpers import log, logs_df, t


def _skewed(spark, n_hot=300, n_cold=60):
    rows = [log(t(0, i % 60), endpoint="/hot", latency=None if i % 10 == 0 else float(i),
                user=f"u{i}", trace=None if i % 3 else f"t{i}") for i in range(n_hot)]
    rows += [log(t(1, i % 60), endpoint=f"/c{i % 3}", latency=float(i)) for i in range(n_cold)]
    return logs_df(spark, rows)


def test_hot_endpoint_and_ties(spark):
    r = hot_endpoint(_skewed(spark)).first()
    assert (r["endpoint"], r["request_count"], r["total_rows"]) == ("/hot", 300, 360)
    assert abs(r["share"] - 300 / 360) < 1e-12
    tie = logs_df(spark, [log(t(0), endpoint="/b"), log(t(0), endpoint="/a")])
    assert hot_endpoint(tie).first()["endpoint"] == "/a"


def test_empty_input_gives_one_row(spark):
    empty = _skewed(spark).limit(0)
    rows = hot_endpoint(empty).collect()
    assert len(rows) == 1 and rows[0]["endpoint"] is None and rows[0]["share"] == 0.0
    study = skew_study(spark, empty, target_partitions=4, salt_buckets=4).first()
    assert study["top_endpoint"] is None and study["top_endpoint_share"] == 0.0


def test_salted_equals_unsalted_with_nulls(spark):
    df = _skewed(spark)
    want = {r["endpoint"]: (r["request_count"], r["avg_latency_ms"])
            for r in endpoint_stats(df, with_p95=False).collect()}
    for buckets in (0, 1, 3, 16):
        got = {r["endpoint"]: (r["request_count"], r["avg_latency_ms"])
               for r in salted_endpoint_stats(df, salt_buckets=buckets).collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9


def test_salt_expression(spark):
    df = spark.createDataFrame([("t", "u", "h"), (None, "u", "h"), (None, None, None)],
                               "trace_id string, user_id string, host string")
    got = [r["s"] for r in df.select(salt(F.lit(True), 0).alias("s")).collect()]
    assert got == [0, 0, 0]  # divisor is at least 1
    vals = [r["s"] for r in df.select(salt(F.lit(True), 8).alias("s")).collect()]
    assert all(0 <= v < 8 for v in vals)
    assert [r["s"] for r in df.select(salt(F.lit(False), 8).alias("s")).collect()] == [0, 0, 0]


def test_profile_counts_a_real_layout(spark):
    df = _skewed(spark)
    plan = partition_skew(df, target_partitions=8, salt_buckets=8)._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2 and "SPARK_PARTITION_ID" in plan
    assert "hash(" not in plan.replace("xxhash64(", "")  # no model of the partitioner
    prof = {r["phase"]: r for r in partition_skew(df, target_partitions=8, salt_buckets=8).collect()}
    # four endpoints, each in one partition; the hot one alone holds 300 rows
    assert prof["before"]["max_partition_rows"] >= 300
    assert prof["before"]["non_empty_partitions"] <= 4


def test_salt_only_for_the_hot_key(spark):
    from opsfold.operators.skew import _with_salt

    rows = _with_salt(_skewed(spark), 8).groupBy("endpoint").agg(
        F.min("salt"), F.max("salt"), F.count_distinct("salt")).collect()
    got = {r[0]: tuple(r)[1:] for r in rows}
    assert got.pop("/hot") == (0, 7, 8)
    assert set(got.values()) == {(0, 0, 1)}


def test_known_hot_key_salts_like_the_found_one(spark):
    from opsfold.operators.skew import _with_salt

    df = _skewed(spark)
    cols = [c for c in df.columns]
    found = sorted(tuple(r) for r in _with_salt(df, 8).select(*cols, "salt").collect())
    given = sorted(tuple(r) for r in _with_salt(df, 8, hot_key="/hot").select(*cols, "salt")
                   .collect())
    assert found == given
    assert {r["salt"] for r in _with_salt(df, 8, hot_key=None).collect()} == {0}
    # with the key given, salting is a projection: no join, no aggregation to find it
    given_plan = _with_salt(df, 8, hot_key="/hot")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in given_plan and "Aggregate" not in given_plan


def test_partition_profile_and_study(spark):
    df = _skewed(spark)
    prof = {r["phase"]: r for r in partition_skew(df, target_partitions=8, salt_buckets=8).collect()}
    for phase in ("before", "after"):
        p = prof[phase]
        assert p["avg_partition_rows"] * p["non_empty_partitions"] == 360
    assert prof["after"]["max_partition_rows"] < prof["before"]["max_partition_rows"]
    study = skew_study(spark, df, target_partitions=8, salt_buckets=8).first()
    assert study["top_endpoint"] == "/hot" and study["salt_buckets"] == 8
    assert study["before_max_partition_rows"] == prof["before"]["max_partition_rows"]
    assert study["after_max_partition_rows"] == prof["after"]["max_partition_rows"]
    assert study["after_min_partition_rows"] == prof["after"]["min_partition_rows"]
    assert study["runtime_before_ms"] >= 0 and study["runtime_after_ms"] >= 0
    laid = skew_study(spark, df, target_partitions=8, salt_buckets=8,
                      materialize_layout=True).first()
    assert laid["after_max_partition_rows"] == study["after_max_partition_rows"]


def test_endpoint_p95_within_rank_error(spark):
    """percentile_approx(.., 1000) stays within n/1000 ranks of the exact quantile."""
    import __spark_entry__ as entry

    got = {r["endpoint"]: (r["request_count"], r["p95_latency_ms"])
           for r in entry.q_endpoint_stats(spark, SF01).collect()}
    con = duckdb.connect()
    for name in ("events", "supplier", "nation", "region"):
        con.execute(f"create view {name} as select * from '{SF01}/{name}.parquet'")
    sql = entry.oracle_prefix() + " select endpoint, list_sort(list(latency_ms)) from enriched group by 1"
    for endpoint, values in con.execute(sql).fetchall():
        n, p95 = got[endpoint]
        assert n == len(values)
        lo, hi = values.index(p95), len(values) - 1 - values[::-1].index(p95)
        target = 0.95 * n
        assert lo - n / 1000 - 1 <= target <= hi + n / 1000 + 1
