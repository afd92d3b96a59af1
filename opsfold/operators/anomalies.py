"""Rolling-baseline anomaly scoring, flagging and offender ranking.

The baseline of a bucket is the previous ``baseline_hours`` observed buckets of
its series (a row frame, gaps not filled).  The window runs on the hourly
roll-up, whose series hold at most one row per hour, so even the hottest
series is bounded by the number of hours covered, not by request volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from opsfold.config import DEFAULT_BASELINE_HOURS, SIGMA
from opsfold.functions.columns import EXPLANATIONS_SEPARATOR, explanation
from opsfold.operators.frames import rolling
from opsfold.operators.rollup import SERIES_KEYS, hourly_rollup

SCORE_COLUMNS = ["service", "endpoint", "region", "hour_bucket", "request_count", "error_rate",
                 "p95_latency_ms", "baseline_error_avg", "baseline_error_std",
                 "baseline_p95_avg", "baseline_p95_std", "error_zscore", "p95_zscore",
                 "error_anomaly", "latency_anomaly", "severity", "explanation"]


def _over(aggregate, column: str):
    def make(frame: WindowSpec) -> Column:
        return aggregate(column).over(frame)
    return make


_BASELINE = {
    "baseline_error_avg": _over(F.avg, "error_rate"),
    "baseline_error_std": _over(F.stddev_pop, "error_rate"),
    "baseline_p95_avg": _over(F.avg, "p95_latency_ms"),
    "baseline_p95_std": _over(F.stddev_pop, "p95_latency_ms"),
}


def anomaly_scores(logs: DataFrame, *, baseline_hours: int = DEFAULT_BASELINE_HOURS,
                   sigma: float = SIGMA, rollup: DataFrame | None = None,
                   target_rows: int | None = None) -> DataFrame:
    """Every hourly bucket with its baseline, z-scores, flags, severity and text.

    ``target_rows`` splits longer series (a finer time grain, say) into blocks of so many rows.

    * std is the population deviation; a z-score is null unless std > 0
    * a flag needs a baseline and a one-sided rise above avg + sigma * std, so
      with std = 0 any rise is flagged (at severity 0) and drops never are
    * severity = max(z_err or 0, z_p95 or 0)
    """
    hourly = rollup if rollup is not None else hourly_rollup(logs)
    hourly = hourly.select(*SERIES_KEYS, F.col("time_bucket").alias("hour_bucket"),
                           "request_count", "error_rate", "p95_latency_ms")
    k = F.lit(float(sigma))
    if target_rows is None:
        w = (Window.partitionBy(*SERIES_KEYS).orderBy("hour_bucket")
             .rowsBetween(-baseline_hours, -1))
        scored = hourly.withColumns({name: make(w) for name, make in _BASELINE.items()})
    else:
        scored = rolling(hourly, SERIES_KEYS, ["hour_bucket"], baseline_hours, _BASELINE,
                         target_rows=target_rows)
    scored = scored.withColumns({
        "error_zscore": F.when(F.col("baseline_error_std") > 0.0,
                               (F.col("error_rate") - F.col("baseline_error_avg"))
                               / F.col("baseline_error_std")),
        "p95_zscore": F.when(F.col("baseline_p95_std") > 0.0,
                             (F.col("p95_latency_ms") - F.col("baseline_p95_avg"))
                             / F.col("baseline_p95_std")),
        "error_anomaly": F.col("baseline_error_avg").isNotNull()
        & (F.col("error_rate") > F.col("baseline_error_avg") + k * F.col("baseline_error_std")),
        "latency_anomaly": F.col("baseline_p95_avg").isNotNull()
        & (F.col("p95_latency_ms") > F.col("baseline_p95_avg") + k * F.col("baseline_p95_std")),
    })
    scored = scored.withColumns({
        "severity": F.greatest(F.coalesce(F.col("error_zscore"), F.lit(0.0)),
                               F.coalesce(F.col("p95_zscore"), F.lit(0.0))),
        "explanation": explanation("error_anomaly", "latency_anomaly", "error_rate",
                                   "baseline_error_avg", "p95_latency_ms", "baseline_p95_avg"),
    })
    return scored.select(*SCORE_COLUMNS)


def anomalies(logs: DataFrame, *, baseline_hours: int = DEFAULT_BASELINE_HOURS,
              sigma: float = SIGMA, rollup: DataFrame | None = None,
              scores: DataFrame | None = None) -> DataFrame:
    """Buckets where either flag is true (a null flag counts as false)."""
    if scores is None:
        scores = anomaly_scores(logs, baseline_hours=baseline_hours, sigma=sigma, rollup=rollup)
    return scores.where(F.col("error_anomaly") | F.col("latency_anomaly"))


def top_offenders(anomalous: DataFrame) -> DataFrame:
    """Series ranked by max severity, then number of anomalous buckets.

    Ties are broken on the series keys; explanations are de-duplicated and
    sorted before joining with ``" | "`` so the text is stable.
    """
    ranked = anomalous.groupBy(*SERIES_KEYS).agg(
        F.count(F.lit(1)).alias("anomaly_windows"),
        F.max("severity").alias("max_severity"),
        F.max("p95_latency_ms").alias("peak_p95_ms"),
        F.max("error_rate").alias("peak_error_rate"),
        F.array_join(F.array_sort(F.collect_set("explanation")),
                     EXPLANATIONS_SEPARATOR).alias("explanations"),
    )
    return ranked.orderBy(F.col("max_severity").desc(), F.col("anomaly_windows").desc(),
                          *[F.col(k).asc_nulls_first() for k in SERIES_KEYS])
