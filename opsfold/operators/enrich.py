"""Host enrichment: attach region and instance type to each log row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsfold.config import MAX_BROADCAST_BYTES, fits, materialize
from opsfold.operators.heavy import can_sketch, heavy_hitters

# Fixed value: default for hosts without metadata.
UNKNOWN = "unknown"


def dedupe_hosts(hosts: DataFrame) -> DataFrame:
    """One row per non-null host.

    Rule for duplicates: the smallest region wins, non-null before null, then the
    smallest instance type (same null rule).  ``min`` over a struct is a partial
    aggregate, so many copies of one host are combined map-side.
    """
    pick = F.min(F.struct(
        F.col("region").isNull().alias("r_null"), F.col("region").alias("region"),
        F.col("instance_type").isNull().alias("t_null"),
        F.col("instance_type").alias("instance_type"),
    )).alias("pick")
    return (hosts.where(F.col("host").isNotNull())
            .groupBy("host").agg(pick)
            .select("host", "pick.region", "pick.instance_type"))


def _hybrid_join(base: DataFrame, meta: DataFrame, hot_rows: int) -> DataFrame:
    """Left join on host: hosts of more than ``hot_rows`` rows by broadcast, all others by shuffle.

    Hot hosts number at most rows / ``hot_rows``; they are found by a sketch and an exact count of
    its candidates.  Rows without a host match nothing and are not shuffled either.
    """
    total = base.count()
    if total <= hot_rows or not can_sketch(hot_rows / total):
        return base.join(meta, on="host", how="left")
    hot = materialize(heavy_hitters(base.where(F.col("host").isNotNull()), ["host"], hot_rows).select("host"))
    of_hot = hot.join(meta, on="host", how="left").withColumn("_hot", F.lit(True))
    spread = (base.join(F.broadcast(of_hot), on="host", how="left")
              .where(F.col("_hot") | F.col("host").isNull()).drop("_hot"))
    rest = (base.where(F.col("host").isNotNull())
            .join(F.broadcast(hot), on="host", how="left_anti")
            .join(meta.hint("merge"), on="host", how="left"))
    return spread.unionByName(rest)


def enrich_logs(logs: DataFrame, hosts: DataFrame, *, broadcast: bool | None = None,
                max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                hot_rows: int | None = None) -> DataFrame:
    """Left-join de-duplicated host metadata onto logs; missing values become ``unknown``.

    Log rows are never multiplied (hosts are de-duplicated first) and a
    ``region``/``instance_type`` already present in the logs is replaced.  The
    host side is broadcast only when it holds at most ``max_broadcast_bytes``
    (one counting job over the hosts); otherwise the join shuffles and AQE
    splits a hot host's partition.  With ``hot_rows``, the hosts of more log rows than that are
    joined by broadcast even then, so that none of them is shuffled.
    """
    meta = dedupe_hosts(hosts)
    if broadcast is None:
        # The raw host rows bound the de-duplicated ones.
        broadcast = fits(hosts.select("host", "region", "instance_type"), max_broadcast_bytes)
    if broadcast:
        meta = F.broadcast(meta)
    base = logs.drop("region", "instance_type")
    if broadcast or hot_rows is None:
        joined = base.join(meta, on="host", how="left")
    else:
        joined = _hybrid_join(base, meta, hot_rows)
    return joined.withColumns({
        "region": F.coalesce(F.col("region"), F.lit(UNKNOWN)),
        "instance_type": F.coalesce(F.col("instance_type"), F.lit(UNKNOWN)),
    })
