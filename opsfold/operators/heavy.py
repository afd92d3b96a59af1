"""Heavy hitters by mergeable frequent-items sketches and one exact count of the candidates.

Counting all keys shuffles about one row per key and task.  A frequent-items sketch instead keeps a
bounded number of keys per task; sketches are merged in two levels, and only the keys that may be
heavy are then counted exactly, over the rows that hold them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A sketch that tracks M keys is off by less than this factor / M of all rows.
_SKETCH_ERROR = 3.5
MAX_TRACKED = 1_000_000
MERGE_GROUPS = 64


def can_sketch(min_share: float) -> bool:
    """Whether a sketch can find every key with that share of all rows."""
    return 0 < min_share and 2 * _SKETCH_ERROR / min_share <= MAX_TRACKED


def heavy_candidates(df: DataFrame, keys: list[str], min_share: float) -> DataFrame:
    """``_h``: hashes of keys that may hold ``min_share`` of all rows, and of no more than
    ``2 / min_share`` keys altogether.  Every key that does hold it is among them.

    With an error below half of ``min_share``, a heavy key is tracked and its estimate is above that
    of all but the ``2 / min_share`` most frequent keys.
    """
    if not can_sketch(min_share):
        raise ValueError(f"min_share {min_share} is too small for a sketch of {MAX_TRACKED} keys")
    tracked = min(MAX_TRACKED, 2 ** math.ceil(math.log2(max(64, 2 * _SKETCH_ERROR / min_share))))
    top = min(tracked, math.ceil(2 / min_share))
    hashed = df.select(F.xxhash64(*[F.struct(F.col(k)) for k in keys]).alias("_h"),
                       F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("_g"))
    parts = hashed.groupBy("_g").agg(F.expr(f"approx_top_k_accumulate(_h, {tracked})").alias("_s"))
    whole = parts.agg(F.expr(f"approx_top_k_combine(_s, {tracked})").alias("_s"))
    found = whole.select(F.explode(F.expr(f"approx_top_k_estimate(_s, {top})")).alias("x"))
    return found.select(F.col("x.item").alias("_h"))


def heavy_hitters(df: DataFrame, keys: list[str], min_rows: int, total: int | None = None) -> DataFrame:
    """(keys, ``_cnt``): every key with more than ``min_rows`` rows, exactly counted."""
    total = df.count() if total is None else total
    if total <= min_rows:
        return df.limit(0).groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    # At most 2 * total / min_rows rows of 8 bytes, which the sketch's limit bounds in turn.
    found = F.broadcast(heavy_candidates(df, keys, min_rows / total))
    rows = df.select(*keys, F.xxhash64(*[F.struct(F.col(k)) for k in keys]).alias("_h"))
    counts = rows.join(found, "_h", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    return counts.where(F.col("_cnt") > min_rows)
