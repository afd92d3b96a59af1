"""Column expressions shared by the operators (all JVM-side built-ins)."""

from opsfold.functions.columns import (
    day_bucket,
    error_flag,
    explanation,
    hour_bucket,
    minutes_between,
    salt,
    session_id,
)

__all__ = ["day_bucket", "error_flag", "explanation", "hour_bucket", "minutes_between",
           "salt", "session_id"]
