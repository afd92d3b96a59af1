"""Scalar column helpers.

Each returns a ``Column`` built from ``pyspark.sql.functions``; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsfold.config import ERROR_STATUS

# Session id layout and explanation clause formats.
SESSION_ID_SEPARATOR = "-"
SESSION_INDEX_WIDTH = 8
SESSION_INDEX_PAD = "0"
ERROR_CLAUSE = "error_rate %.4f > baseline %.4f"
LATENCY_CLAUSE = "p95 %.2fms > baseline %.2fms"
CLAUSE_SEPARATOR = "; "
# Numbers are formatted from the value rounded to this many places, so float
# summation noise (38.574999999999996 vs 38.575) cannot flip a printed digit.
FORMAT_GUARD_DIGITS = 9
EXPLANATIONS_SEPARATOR = " | "


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def error_flag(status: str | Column = "status_code") -> Column:
    """1.0 for status >= 500, else 0.0; a null status is not an error."""
    return F.when(_c(status) >= ERROR_STATUS, F.lit(1.0)).otherwise(F.lit(0.0))


def hour_bucket(ts: str | Column = "timestamp") -> Column:
    return F.date_trunc("hour", _c(ts))


def day_bucket(ts: str | Column = "timestamp") -> Column:
    return F.to_date(_c(ts))


def minutes_between(later: str | Column, earlier: str | Column) -> Column:
    """Whole-second difference in minutes, as a double (sub-second parts dropped)."""
    return (F.unix_timestamp(_c(later)) - F.unix_timestamp(_c(earlier))) / F.lit(60.0)


def session_id(user: str | Column, index: str | Column) -> Column:
    """``<user>-<index padded to 8>``; longer indices keep all their digits."""
    digits = _c(index).cast("string")
    width = F.greatest(F.length(digits), F.lit(SESSION_INDEX_WIDTH))
    return F.concat_ws(SESSION_ID_SEPARATOR, _c(user), F.lpad(digits, width, SESSION_INDEX_PAD))


def explanation(error_anomaly: str | Column, latency_anomaly: str | Column,
                error_rate: str | Column, error_avg: str | Column,
                p95: str | Column, p95_avg: str | Column) -> Column:
    """One clause per raised flag, joined with ``"; "`` (empty when none)."""
    def g(c):
        return F.round(_c(c), FORMAT_GUARD_DIGITS)
    return F.concat_ws(
        CLAUSE_SEPARATOR,
        F.when(_c(error_anomaly), F.format_string(ERROR_CLAUSE, g(error_rate), g(error_avg))),
        F.when(_c(latency_anomaly), F.format_string(LATENCY_CLAUSE, g(p95), g(p95_avg))),
    )


def salt(is_hot: Column, buckets: int,
         sources: tuple[str, ...] = ("trace_id", "user_id", "host")) -> Column:
    """Salt for rows of the hot key: ``pmod(xxhash64(coalesce(sources)), buckets)``.

    Other rows get 0.  The divisor is at least 1; all-null sources still hash
    (to the seed), so they land in one bucket.
    """
    divisor = max(int(buckets), 1)
    source = F.coalesce(*[F.col(s) for s in sources])
    return F.when(is_hot, F.pmod(F.xxhash64(source), F.lit(divisor))).otherwise(F.lit(0)).cast("long")
