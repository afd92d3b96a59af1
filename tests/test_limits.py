"""Exact limits without a single-task merge: partition-order and ordered forms."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from opsfold.operators.limits import first_file_rows, first_rows, top_rows
from opsfold.sources.sinks import trim_dataset


def _key(row):
    # ascending, nulls first
    return tuple((v is not None, v) for v in row)


def test_top_rows_equals_brute_force_sort(spark):
    rows = [(i % 7 if i % 11 else None, (i * 37) % 101, f"r{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b int, c string").repartition(5)
    order = ["a", "b"]
    want_all = sorted(((a, b) for a, b, _ in rows), key=_key)
    for limit in (0, 1, 37, 500, 999, 1000, 2000):
        for target in (40, 10_000):  # many order buckets / a single one
            got = top_rows(df, limit, order, target_rows=target).collect()
            assert len(got) == min(limit, 1000), (limit, target)
            assert len({r["c"] for r in got}) == len(got)
            assert sorted(((r["a"], r["b"]) for r in got), key=_key) == want_all[:limit]


def test_top_rows_ranks_only_one_bucket(spark):
    df = spark.range(0, 2000, 1, 8).withColumn("k", (F.col("id") * 7919) % 2000)
    got = top_rows(df, 250, ["k"], target_rows=100)
    got.write.format("noop").mode("overwrite").save()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan
    assert sorted(r["k"] for r in got.collect()) == list(range(250))


def test_first_rows_zero_and_all(spark):
    df = spark.range(0, 30, 1, 3)
    assert first_rows(df, 0).count() == 0
    assert first_rows(df, 30).count() == 30


def test_first_rows_over_a_hash_shuffle(spark):
    df = spark.range(0, 1000, 1, 4).repartition(6, "id").withColumn("v", F.col("id") * 3)
    for limit in (1, 333, 1000):
        rows = [r["id"] for r in first_rows(df, limit).collect()]
        assert len(rows) == limit and len(set(rows)) == limit


def _check_subset(got, df, limit):
    assert got.count() == min(limit, df.count())
    assert got.exceptAll(df).count() == 0


def test_first_rows_when_jobs_see_different_partitions(spark):
    # AQE coalesces the pruned count of this shuffle, but not its write of wide rows.
    wide = F.repeat(F.sha2(F.col("id").cast("string"), 256), 10)
    df = spark.range(0, 20_000, 1, 4).repartition("id").withColumn("w", wide)
    for limit in (3000, 7001):
        _check_subset(first_rows(df, limit), df, limit)


def test_first_rows_of_copies(spark, monkeypatch):
    from opsfold.operators import limits

    monkeypatch.setattr(limits, "RANKED_ROWS", 10)
    df = spark.range(0, 900, 1, 5).selectExpr("id % 3 as a", "if(id % 3 = 0, null, 'x') as b")
    for limit in (1, 299, 300, 650, 899, 900, 901):
        _check_subset(first_rows(df, limit), df, limit)


def test_first_file_rows_reads_only_needed_files(spark, tmp_dir):
    spark.range(0, 5000, 1, 10).write.parquet(f"{tmp_dir}/in")
    df = spark.read.parquet(f"{tmp_dir}/in")
    parallelism = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = first_file_rows(spark, f"{tmp_dir}/in", 1203)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "512")  # other splits than the count saw
        _check_subset(got, df, 1203)
        assert got.select(F.input_file_name()).distinct().count() <= 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", parallelism)
    assert trim_dataset(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", 1203).kept_rows == 1203


def test_trim_refuses_its_input_by_any_name(spark, tmp_dir):
    source = f"{tmp_dir}/in"
    spark.range(100).write.parquet(source)
    for target in (source, f"file:{source}", f"file://{source}/", f"{source}/", f"{source}/sub",
                   f"{tmp_dir}", f"{tmp_dir}/x/../in", f"file:///{source}"):
        with pytest.raises(ValueError):
            trim_dataset(spark, source, target, 10)
        with pytest.raises(ValueError):
            trim_dataset(spark, f"file:{source}", target, 10)
    assert spark.read.parquet(source).count() == 100
    trim_dataset(spark, source, f"{tmp_dir}/in2", 10)
    with pytest.raises(Exception, match="exist"):
        trim_dataset(spark, source, f"{tmp_dir}/in2", 10)
