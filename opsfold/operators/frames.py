"""Rolling row frames within a key whose rows are split over several tasks.

A frame of the ``n`` rows before a row needs only those rows.  Rows are numbered within their key
by the skew-safe scan and dealt to blocks of consecutive numbers; each block also receives the last
``n`` rows of the block before it (its halo), evaluates the plain window and drops the halo again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from opsfold.operators.scan import DEFAULT_TARGET_ROWS, keyed_scan


def rolling(df: DataFrame, keys: list[str], order: list[str], preceding: int,
            columns: dict[str, Callable[[WindowSpec], Column]], *,
            target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Add ``columns``: expressions over the ``preceding`` rows before each row of its key.

    Equal to ``rowsBetween(-preceding, -1)`` in ascending nulls-first ``order``.  A block holds
    ``max(target_rows, preceding)`` rows of a key and at most ``preceding`` more.
    """
    size = max(int(target_rows), int(preceding), 1)
    numbered = keyed_scan(df, keys, order, order[0], pos="_at", prev="_before",
                          target_rows=target_rows)
    block = F.floor((F.col("_at") - 1) / F.lit(size)).cast("long")
    late = F.pmod(F.col("_at") - 1, F.lit(size)) >= size - preceding
    blocks = F.when(late, F.array(block, block + 1)).otherwise(F.array(block))
    dealt = (numbered.drop("_before").withColumn("_own", block)
             .withColumn("_block", F.explode(blocks)))
    frame = Window.partitionBy(*keys, "_block").orderBy("_at").rowsBetween(-preceding, -1)
    return (dealt.withColumns({name: make(frame) for name, make in columns.items()})
            .where(F.col("_block") == F.col("_own")).drop("_own", "_block", "_at"))
