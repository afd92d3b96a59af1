"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Every row gets its number in key order, 0 to n - 1.  A keyed Feistel network
over Z_a x Z_b with a * b >= n permutes the numbers; numbers that leave the
range walk on along their cycle until they are back in it.  Shard and slot
follow from the permuted number by division, so both can be computed for any
row number, and the inverse gives the row number for any shard and slot.

Law ``rows``: shard sizes differ by one row at most, slots are 0, 1, 2, ...

Cases: null texts count no bytes and have the checksum of no bytes; null keys
sort first; rows with equal keys are told apart by their text and, if they are
equal in that too, are interchangeable; an empty table gives an empty result;
columns other than the key and the text are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsfold.llm.frames import stored

ROUNDS = 4
MAX_WALK = 64
ROWS_PER_TASK = 2_000_000  # that a task sorts, where the default number of partitions gives more
_IN_PART = 33  # bits that monotonically_increasing_id() has for rows of one partition


def number_rows(df: DataFrame, keys: list[str], name: str = "row_number") -> DataFrame:
    """``df`` with gapless numbers from 0 in the order of ``keys`` (nulls first).

    Rows are range-partitioned and sorted once; counts per partition (one row
    each) give the first number of every partition.  There are as many partitions
    as the session sets, and more for more than ``ROWS_PER_TASK`` rows in each.
    """
    local, part = "__local", "__part"
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_PER_TASK))
    ordered = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
               .withColumn(local, F.monotonically_increasing_id()))
    ordered = stored(ordered.withColumn(part, F.shiftright(local, _IN_PART))
                     .withColumn(local, F.col(local).bitwiseAND((1 << _IN_PART) - 1)), "numbered")
    counts = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    # The task that sums up reads one row per partition.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    # ``first`` has one row per partition: one for ``ROWS_PER_TASK`` rows, or as many as the session sets.
    return (ordered.join(F.broadcast(first), part).withColumn(name, F.col("__first") + F.col(local))
            .drop(local, part, "__first"))


def _sides(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, -(-max(n, 1) // a)


def _step(left: Column, right: Column, i: Column, seed: int, size: int, sign: int) -> Column:
    return F.pmod(left + sign * F.pmod(F.xxhash64(right, i, F.lit(seed)), F.lit(size)), F.lit(size))


def _network(x: Column, n: int, seed: int, inverse: bool) -> Column:
    a, b = _sides(n)
    state = F.struct(F.pmod(x, F.lit(a)).alias("l"), F.floor(x / F.lit(a)).cast("long").alias("r"))
    rounds = range(ROUNDS)

    def forward(s: Column, i: Column) -> Column:
        left = _step(s["l"], s["r"], i, seed, a, 1)
        return F.struct(left.alias("l"), _step(s["r"], left, -i, seed, b, 1).alias("r"))

    def backward(s: Column, i: Column) -> Column:
        right = _step(s["r"], s["l"], -i, seed, b, -1)
        return F.struct(_step(s["l"], right, i, seed, a, -1).alias("l"), right.alias("r"))

    order = [i + 1 for i in (reversed(rounds) if inverse else rounds)]
    return F.aggregate(F.array(*map(F.lit, order)), state, backward if inverse else forward,
                       lambda s: s["r"] * F.lit(a) + s["l"])


def permuted(x: Column, n: int, seed: int = 0, inverse: bool = False) -> Column:
    """The place of row number ``x`` among ``n`` (or, inverted, the row number of a place).

    Fewer than a of the a * b numbers lie outside the range, so a walk ends
    within a steps; for large n a walk of ``MAX_WALK`` steps has a chance of
    about n ** -32, and it would raise an error rather than give a wrong place.
    """
    steps = min(_sides(n)[0], MAX_WALK)
    inside = x.between(0, n - 1)
    start = _network(x, n, seed, inverse)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start,
                         lambda y, _: F.when(y < n, y).otherwise(_network(y, n, seed, inverse)))
    return F.when(inside, F.when(walked < n, walked).otherwise(
        F.raise_error(F.lit("cycle walk did not end")).cast("long")))


def shard_rows(docs: DataFrame, shards: int, seed: int = 0, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number."""
    if shards < 1:
        raise ValueError(f"shards must be positive: {shards}")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"), F.xxhash64(text).alias("__tie"))
    numbered = number_rows(narrow, ["doc_id", "__tie"])
    n = numbered.count()
    place = permuted(F.col("row_number"), n, seed)
    return (numbered.withColumn("__place", place)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                    F.pmod("__place", F.lit(shards)).cast("int").alias("shard"),
                    F.floor(F.col("__place") / F.lit(shards)).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "row_number"))


def row_of(shard: Column, slot: Column, shards: int, n: int, seed: int = 0) -> Column:
    """The row number at a slot of a shard: random access to the shuffled order."""
    return permuted(slot * F.lit(shards) + shard, n, seed, inverse=True)
