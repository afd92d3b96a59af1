"""As-of join by a merge scan: each left row with the latest right row at or before its time.

Both sides are put into one timeline per key and scanned once; the last right row seen is carried
along.  A key that holds a large share of either side is cut into sub-chunks of time by
:func:`keyed_scan`, which also carries the match across their edges.  The right side is not
expanded by time buckets, so any time grain and any tolerance cost the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsfold.operators.scan import DEFAULT_TARGET_ROWS, keyed_scan


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
              right_columns: list[str], *, tolerance: Column | None = None,
              target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """``left`` with ``right_time`` and ``right_columns`` of its match (null if none).

    The match has equal keys and the greatest ``right_time <= left_time``; of equal times, the one
    with the greatest ``right_columns`` in order, nulls first.  With ``tolerance`` (an interval) a
    match older than that counts as none, though an older right row never takes its place.  Null keys
    and null times match nothing.  Every left row stays, once.
    """
    payload = [right_time, *right_columns]
    row = F.struct(*[F.col(c) for c in left.columns])
    kind = left.select(row.alias("_l")).schema["_l"].dataType
    match = F.struct(*[F.col(c) for c in payload])
    match_kind = right.select(match.alias("_r")).schema["_r"].dataType
    known = F.col(right_time).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    lefts = left.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(left_time).alias("_t"),
                        F.lit(1).alias("_side"), F.lit(None).cast(match_kind).alias("_r"), row.alias("_l"))
    rights = right.where(known).select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                                       F.col(right_time).alias("_t"), F.lit(0).alias("_side"),
                                       match.alias("_r"), F.lit(None).cast(kind).alias("_l"))
    names = [f"_k_{k}" for k in keys]
    scanned = keyed_scan(lefts.unionByName(rights), names, ["_t", "_side", "_r"], "_t",
                         carry="_r", carried="_match", target_rows=target_rows)
    found = scanned.where(F.col("_side") == 1)
    near = F.col("_match").isNotNull() & F.col("_t").isNotNull()
    if tolerance is not None:
        near = near & (F.col("_t") <= F.col(f"_match.{right_time}") + tolerance)
    return found.select("_l.*", *[F.when(near, F.col(f"_match.{c}")).alias(c) for c in payload])
