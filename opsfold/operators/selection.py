"""Exact percentiles by distributed selection.

A percentile is the value at one rank of a group.  The group's rows are cut into order buckets
(:func:`assign_chunks`), rows per bucket are counted, and only the bucket that holds the rank is
ranked.  No aggregate buffer holds a group's values, whatever the size of the group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsfold.operators.scan import DEFAULT_TARGET_ROWS, assign_chunks


def exact_quantile(df: DataFrame, keys: list[str], value: str, q: float, *,
                   name: str = "quantile", target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Per group the smallest value with at least a share ``q`` of the group's values at or below it.

    Null values are left out; a group without values has no row.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    chunked, _ = assign_chunks(rows, keys, ["_v"], target_rows=target_rows)
    sizes = chunked.groupBy(*keys, "_sub").agg(F.count(F.lit(1)).alias("_n"))
    of_key = Window.partitionBy(*keys)  # one row per order bucket
    before = of_key.orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_n").over(of_key)
    placed = sizes.withColumns({
        "_before": F.coalesce(F.sum("_n").over(before), F.lit(0)),
        "_rank": F.greatest(F.lit(1), total - F.floor(total - F.lit(q) * total))})
    cut = placed.where((F.col("_before") < F.col("_rank"))
                       & (F.col("_rank") <= F.col("_before") + F.col("_n")))
    cut = cut.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_sub").alias("_c_sub"),
                     (F.col("_rank") - F.col("_before")).alias("_take"))
    on = chunked["_sub"] == cut["_c_sub"]
    for k in keys:
        on = on & chunked[k].eqNullSafe(cut[f"_c_{k}"])
    in_bucket = Window.partitionBy(*keys, "_sub").orderBy("_v")
    return (chunked.join(cut, on).withColumn("_at", F.row_number().over(in_bucket))
            .where(F.col("_at") == F.col("_take")).select(*keys, F.col("_v").alias(name)))
