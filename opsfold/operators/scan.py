"""Skew-safe ordered scan within a key: position, previous/next value, running flag count.

``Window.partitionBy(key)`` sends every row of one key to one task, so a key
holding a third of all rows becomes a single straggler.  This operator keeps
the plain window for ordinary keys and splits only hot keys:

1. rows per key are counted (a partial aggregate).  Keys with more than
   ``target_rows`` rows are hot; there are at most rows / ``target_rows`` of them;
2. a hot key is cut into sub-chunks of its order by split points, which come from
   a deterministic hash sample of ``SAMPLES_PER_CHUNK`` rows per sub-chunk.  A key
   gets at most ``FANOUT`` sub-chunks at a time, so its sample and its split
   points stay bounded; sub-chunks that are still large are cut again, all of
   them in parallel, until none is;
3. each row of a hot key finds its sub-chunk by binary search over its key's
   split points; rows of other keys skip the search;
4. the window runs per ``(key, sub-chunk)`` (one hash shuffle);
5. sub-chunk boundaries of hot keys are repaired from a per-(hot key,
   sub-chunk) summary, at most ``sum(ceil(c / target_rows))`` rows.

Split points and summary are broadcast up to ``MAX_BROADCAST_ROWS`` rows, and
joined by shuffle beyond that.

Chunk ids are a deterministic function of each row and of a checkpointed
split table, so every branch of the plan (and every task retry, even after an
executor is lost) sees the same ones.
Results equal ``row_number``, ``lag``, ``lead`` and a running ``sum`` of a flag
over ``Window.partitionBy(key).orderBy(order...)`` with ascending, nulls-first
order and ties broken by a hash of the whole row (identical rows are
interchangeable).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsfold.config import materialize

FlagFn = Callable[[Column, Column], Column]

DEFAULT_TARGET_ROWS = 2_000_000
SAMPLES_PER_CHUNK = 60
FANOUT = 1000
MAX_LEVELS = 5  # FANOUT ** MAX_LEVELS sub-chunks of one key
MAX_BROADCAST_ROWS = 500_000
_HASH_SPACE = 1 << 30


def _on(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def _sized(right: DataFrame, rows: int) -> DataFrame:
    """``right`` with a broadcast hint when it is known to be small."""
    return F.broadcast(right) if rows <= MAX_BROADCAST_ROWS else right


def _hot_keys(base: DataFrame, keys: list[str], target_rows: int,
              slack: int = 1) -> tuple[DataFrame | None, int, int, int]:
    """Checkpointed (keys, _cnt, _chunks) of hot keys; their number, max and total sub-chunks.

    Every key over ``slack * target_rows`` rows is hot.
    """
    counts = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    chunks = F.least(F.ceil(F.col("_cnt") / F.lit(target_rows)), F.lit(FANOUT)).cast("long")
    hot = materialize(counts.where(F.col("_cnt") > slack * target_rows).withColumn("_chunks", chunks))
    total = hot.agg(F.count(F.lit(1)).alias("n"), F.max("_chunks").alias("most"),
                    F.sum("_chunks").alias("all")).first()
    if not total["n"]:
        return None, 0, 0, 0
    return hot, total["n"], total["most"], total["all"]


def _split_points(base: DataFrame, hot: DataFrame, n_hot: int, keys: list[str],
                  sort_cols: list[str], level: int) -> DataFrame:
    """Checkpointed (keys, _splits): sorted sub-chunk start points of each hot key.

    A key's sample has about ``SAMPLES_PER_CHUNK * FANOUT`` rows at most.  With so
    many samples to a sub-chunk its size stays within twice the target.
    """
    rate = F.least(F.lit(1.0), F.col("_chunks") * F.lit(SAMPLES_PER_CHUNK) / F.col("_cnt"))
    info = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_chunks",
                      rate.alias("_rate"))
    draw = F.pmod(F.xxhash64(F.col("_tb"), F.lit(17 + level)), F.lit(_HASH_SPACE)) / F.lit(_HASH_SPACE)
    sample = (base.join(_sized(info, n_hot), _on(base, info, [(k, f"_h_{k}") for k in keys]))
              .where(draw < F.col("_rate"))
              .select(*keys, *sort_cols, "_chunks"))
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in sort_cols])
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    idx = F.floor((F.row_number().over(w) - 1) * F.col("_chunks") / n)
    marked = sample.withColumn("_idx", idx).withColumn(
        "_prev_idx", F.lag("_idx").over(w))
    starts = marked.where(F.col("_prev_idx").isNotNull() & (F.col("_idx") != F.col("_prev_idx")))
    point = F.struct(*[F.col(c) for c in sort_cols])
    return materialize(
        starts.groupBy(*keys).agg(F.sort_array(F.collect_list(point)).alias("_splits")))


def _sub_chunk(df: DataFrame, sort_cols: list[str], depth: int) -> DataFrame:
    """Add the number of split points <= the row's sort key to ``_sub`` (binary search)."""
    # One higher-order ``aggregate`` over ``depth`` steps keeps the expression
    # linear in size (chained projections would be inlined into one tree).
    x = F.struct(*[F.col(c) for c in sort_cols])
    splits = F.col("_splits")
    init = F.struct(F.lit(0).alias("lo"), F.size(splits).alias("hi"))

    def step(acc: Column, _: Column) -> Column:
        lo, hi = acc["lo"], acc["hi"]
        mid = F.shiftright(lo + hi, 1)
        go = F.coalesce(F.try_element_at(splits, mid + 1) <= x, F.lit(False))
        active = lo < hi
        return F.struct(F.when(active & go, mid + 1).otherwise(lo).alias("lo"),
                        F.when(active & ~go, mid).otherwise(hi).alias("hi"))

    found = F.when(splits.isNull(), F.lit(0)).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.lit(depth)), init, step, lambda acc: acc["lo"]))
    return df.withColumns({"_sub": F.col("_sub") * F.lit(FANOUT) + found.cast("long"),
                           "_hot": F.col("_hot") | splits.isNotNull()}).drop("_splits")


def assign_chunks(df: DataFrame, keys: list[str], order: list[str], *,
                  target_rows: int = DEFAULT_TARGET_ROWS) -> tuple[DataFrame, int]:
    """Add ``_tb`` (row hash tie-break) and ``_sub``: the row's sub-chunk of its key.

    Within a key, sub-chunks follow the ascending nulls-first order of
    ``(*order, _tb)``: every row of sub-chunk ``i`` sorts before every row of
    ``i + 1``.  Keys with at most ``target_rows`` rows are one sub-chunk (0).
    No sub-chunk passes about twice ``target_rows``, except for rows that are
    equal in every column, which have no order to split by.
    With hot keys present a boolean ``_hot`` column is added too, and the
    second value returned is the number of their sub-chunks (else 0).
    """
    base = df.withColumn("_tb", F.xxhash64(*[F.col(c) for c in df.columns]))
    sort_cols = [*order, "_tb"]
    out = base.withColumns({"_sub": F.lit(0).cast("long"), "_hot": F.lit(False)})
    total, group = 0, list(keys)
    for level in range(MAX_LEVELS):
        hot, n_hot, most, chunks = _hot_keys(out, group, target_rows, 1 if level == 0 else 2)
        if hot is None:
            break
        total += chunks
        splits = _split_points(out, hot, n_hot, group, sort_cols, level)
        right = splits.select(*[F.col(k).alias(f"_s_{k}") for k in group], "_splits")
        joined = (out.join(_sized(right, chunks), _on(out, right, [(k, f"_s_{k}") for k in group]),
                           "left").drop(*[f"_s_{k}" for k in group]))
        depth = max(1, math.ceil(math.log2(most + 1)))
        out = _sub_chunk(joined, sort_cols, depth)
        group = [*keys, "_sub"]
        if most < FANOUT:  # every key got all the sub-chunks it needs
            break
    return (out, total) if total else (out.drop("_hot"), 0)


def keyed_scan(df: DataFrame, keys: list[str], order: list[str], value: str, *,
               flag: FlagFn | None = None, pos: str = "_pos", prev: str = "_prev",
               nxt: str | None = None, run: str = "_run", start: str | None = None,
               carry: str | None = None, carried: str = "_carried",
               target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Add ``pos`` (1-based), ``prev`` (``value`` at the previous row), optionally
    ``nxt`` (at the next row) and, with ``flag``, ``run`` = running sum of
    ``flag(value, prev)`` within each key, in ascending nulls-first ``order``.

    ``start`` (needs ``flag``) names a column with the position of the latest
    row at or before this one whose flag is 1 (null if none).

    ``carry`` names a column whose last non-null value at or before each row is
    added as ``carried``.

    ``flag`` receives the row's value and the previous row's value (null at
    the key's first row) and returns 0/1.  While planning it checkpoints the
    keys over ``target_rows`` (one counting job) and, if any, their split
    points; everything else is lazy.
    """
    chunked, n_chunks = assign_chunks(df, keys, order, target_rows=target_rows)
    sort_cols = [*order, "_tb"]

    w = Window.partitionBy(*keys, "_sub").orderBy(*[F.col(c).asc_nulls_first() for c in sort_cols])

    def local(frame: DataFrame) -> DataFrame:
        """Window functions within each (key, sub-chunk)."""
        out = frame.withColumns({
            "_lpos": F.row_number().over(w),
            "_lprev": F.lag(value).over(w),
            "_lnext": F.lead(value).over(w),
            "_llast": F.lead(F.lit(1)).over(w).isNull(),
        })
        if flag is not None:
            out = out.withColumn("_lflag", flag(F.col(value), F.col("_lprev")).cast("long"))
            upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            out = out.withColumns({
                "_lrun": F.sum("_lflag").over(upto),
                "_lstart": F.max(F.when(F.col("_lflag") == 1, F.col("_lpos"))).over(upto),
            })
        if carry:
            out = out.withColumn("_lcarry", F.last(carry, ignorenulls=True).over(
                w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        return out

    loc = local(chunked)

    if not n_chunks:
        cols = {pos: F.col("_lpos").cast("long"), prev: F.col("_lprev")}
        if nxt:
            cols[nxt] = F.col("_lnext")
        if flag is not None:
            cols[run] = F.col("_lrun").cast("long")
            if start:
                cols[start] = F.col("_lstart").cast("long")
        if carry:
            cols[carried] = F.col("_lcarry")
        return loc.withColumns(cols).drop(
            "_tb", "_sub", "_lpos", "_lprev", "_lnext", "_llast", "_lflag", "_lrun", "_lstart",
            "_lcarry")

    # Boundary repair, hot keys only: one summary row per (hot key, sub-chunk).
    # The hot rows are filtered before their own window, so this branch shuffles
    # only them, not the whole input a second time.
    sel = local(chunked.where(F.col("_hot")))
    aggs = [F.count(F.lit(1)).alias("_n"),
            F.max_by(F.col(value), F.col("_lpos")).alias("_last"),
            F.min_by(F.col(value), F.col("_lpos")).alias("_first")]
    if flag is not None:
        aggs.append(F.sum(F.when(F.col("_lpos") > 1, F.col("_lflag")).otherwise(F.lit(0)))
                    .alias("_inner"))
        aggs.append(F.max(F.when((F.col("_lpos") > 1) & (F.col("_lflag") == 1), F.col("_lpos")))
                    .alias("_inner_last"))
    if carry:  # rows without a value have no place among those compared
        aggs.append(F.max_by(F.col(carry), F.when(F.col(carry).isNotNull(), F.col("_lpos")))
                    .alias("_last_carry"))
    summ = sel.groupBy(*keys, "_sub").agg(*aggs)
    cw = Window.partitionBy(*keys).orderBy("_sub")
    before = cw.rowsBetween(Window.unboundedPreceding, -1)
    fix = summ.withColumns({
        "_cprev": F.lag("_last").over(cw),
        "_cnext": F.lead("_first").over(cw),
        "_opos": F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long"),
    })
    if flag is not None:
        null_value = F.lit(None).cast(df.schema[value].dataType)
        true_first = flag(F.col("_first"), F.col("_cprev")).cast("long")
        local_first = flag(F.col("_first"), null_value).cast("long")
        fix = fix.withColumns({"_delta": true_first - local_first,
                               "_tfirst": true_first,
                               "_cflags": true_first + F.col("_inner")})
        # global position of the chunk's last true start, then carried forward
        last_start = (F.when(F.col("_inner_last").isNotNull(), F.col("_inner_last") + F.col("_opos"))
                      .when(F.col("_tfirst") == 1, F.col("_opos") + 1))
        fix = fix.withColumns({
            "_orun": F.coalesce(F.sum("_cflags").over(before), F.lit(0)),
            "_cstart": F.max(last_start).over(before),
        })
    else:
        fix = fix.withColumns({"_delta": F.lit(0), "_orun": F.lit(0), "_tfirst": F.lit(None),
                               "_cstart": F.lit(None)})
    fix = fix.withColumn("_ccarry", F.last("_last_carry", ignorenulls=True).over(before)
                         if carry else F.lit(None))
    fix = fix.select(*[F.col(k).alias(f"_f_{k}") for k in keys],
                     F.col("_sub").alias("_f_sub"), "_cprev", "_cnext", "_opos", "_orun",
                     "_delta", "_tfirst", "_cstart", "_ccarry")

    cond = _on(loc, fix, [(k, f"_f_{k}") for k in keys]) & (loc["_sub"] == fix["_f_sub"])
    out = loc.join(_sized(fix, n_chunks), cond, "left")
    matched = F.col("_opos").isNotNull()
    cols = {
        pos: (F.col("_lpos") + F.coalesce(F.col("_opos"), F.lit(0))).cast("long"),
        prev: F.when((F.col("_lpos") == 1) & matched, F.col("_cprev"))
               .otherwise(F.col("_lprev")),
    }
    if nxt:
        cols[nxt] = F.when(F.col("_llast") & matched, F.col("_cnext")).otherwise(F.col("_lnext"))
    if flag is not None:
        cols[run] = (F.col("_lrun") + F.coalesce(F.col("_orun"), F.lit(0))
                     + F.coalesce(F.col("_delta"), F.lit(0))).cast("long")
        if start:
            carried = F.col("_lstart").isNull() | ((F.col("_lstart") == 1) & (F.col("_tfirst") == 0))
            cols[start] = F.when(matched, F.when(carried, F.col("_cstart"))
                                 .otherwise(F.col("_lstart") + F.col("_opos"))
                                 ).otherwise(F.col("_lstart")).cast("long")
    if carry:
        cols[carried] = F.coalesce(F.col("_lcarry"), F.col("_ccarry"))
    out = out.withColumns(cols)
    return out.drop("_tb", "_sub", "_hot", "_lpos", "_lprev", "_lnext", "_llast", "_lflag", "_lrun",
                    "_lstart", "_cprev", "_cnext", "_opos", "_orun", "_delta", "_tfirst",
                    "_cstart", "_lcarry", "_ccarry",
                    *[f"_f_{k}" for k in keys], "_f_sub")
