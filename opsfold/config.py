"""Session settings and pipeline parameters."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results.
DEFAULT_SESSION_TIMEOUT_MINUTES = 30
DEFAULT_ATTRIBUTION_WINDOW_HOURS = 6
DEFAULT_BASELINE_HOURS = 24
DEFAULT_SALT_BUCKETS = 16
DEFAULT_TARGET_PARTITIONS = 64
DEFAULT_INPUT_FORMAT = "parquet"
SIGMA = 3.0
ERROR_STATUS = 500
PERCENTILE_ACCURACY = 1000
PREVIEW_ROWS = 20
TRIM_LIMIT = 100_000

# Broadcast only sides of at most so many bytes; above that the plan falls back to
# a shuffle join (AQE may still split skewed partitions of that join).
MAX_BROADCAST_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class Params:
    """Keyword parameters of the pipeline (the reference parses them from argv)."""

    session_timeout_minutes: int = DEFAULT_SESSION_TIMEOUT_MINUTES
    attribution_window_hours: int = DEFAULT_ATTRIBUTION_WINDOW_HOURS
    baseline_hours: int = DEFAULT_BASELINE_HOURS
    salt_buckets: int = DEFAULT_SALT_BUCKETS
    target_partitions: int = DEFAULT_TARGET_PARTITIONS
    input_format: str = DEFAULT_INPUT_FORMAT
    # True caches the enriched logs shared by the products on the executors.  By
    # default each product re-reads only its own columns from parquet instead.
    persist_enriched: bool = False

    def __post_init__(self) -> None:
        for name in ("session_timeout_minutes", "attribution_window_hours", "baseline_hours",
                     "salt_buckets", "target_partitions"):
            value = getattr(self, name)
            if not isinstance(value, int) or isinstance(value, bool):
                raise ValueError(f"{name} must be an int, got {value!r}")
            if value < 0 or (name in ("baseline_hours", "target_partitions") and value < 1):
                raise ValueError(f"{name} out of range: {value}")
        if not isinstance(self.persist_enriched, bool):
            raise ValueError(f"persist_enriched must be a bool, got {self.persist_enriched!r}")


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every operator relies on.

    UTC makes hour/day buckets independent of the machine; nanosecond parquet
    timestamps are read as bigint so the loader can normalise them; AQE
    coalesces small shuffles and splits skewed join partitions.
    """
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", "UTC")
    conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set ``fallback`` only if unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints.

    Uses the context's checkpoint folder or ``spark.checkpoint.dir``.  Only a
    local master with neither set gets a fresh temporary folder (tests,
    benches); on a cluster that would be machine-local, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="opsfold-ckpt-"))


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    For small planning tables that later stages must see identically, even
    when executors are lost and tasks are retried.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_dir(spark)}/opsfold/{name}-{uuid.uuid4().hex}"


def table_bytes(df: DataFrame) -> tuple[int, int]:
    """Rows and estimated bytes of ``df``, by one partial aggregate.

    Text and binary columns count their length, other columns eight bytes; no
    row travels further than its own task.
    """
    wide = [f.name for f in df.schema.fields
            if f.dataType.typeName() in ("string", "binary", "varchar", "char")]
    fixed = 8 * (len(df.columns) - len(wide)) + 8 * len(wide)
    sums = [F.sum(F.octet_length(F.col(f"`{c}`"))) for c in wide]
    row = df.agg(F.count(F.lit(1)), *sums).first()
    return row[0], fixed * row[0] + sum(x or 0 for x in row[1:])


def fits(df: DataFrame, max_bytes: int) -> bool:
    """True when ``df`` is proven to hold at most ``max_bytes`` bytes."""
    return table_bytes(df)[1] <= max_bytes
