"""Readers (parquet, CSV, JSON, any installed format) and sinks."""

from opsfold.sources.readers import (
    Inputs,
    coerce_deployments,
    coerce_hosts,
    coerce_logs,
    load_inputs,
    normalize_time,
    read_table,
)
from opsfold.sources.sinks import (
    preview,
    trim_dataset,
    trim_frame,
    validate_outputs,
    write_parquet,
)

__all__ = ["Inputs", "coerce_deployments", "coerce_hosts", "coerce_logs", "load_inputs",
           "normalize_time", "read_table", "preview", "trim_dataset", "trim_frame",
           "validate_outputs", "write_parquet"]
