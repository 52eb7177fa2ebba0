"""One audit row per load."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Names, order and types of the audit columns.
AUDIT_COLUMNS = {
    "dataset": "string",
    "sys_level": "string",
    "timestamp_utc": "string",
    "src_count": "bigint",
    "curated_count": "bigint",
    "rejected_count": "bigint",
    "status": "string",
}


def append_audit(
    spark: SparkSession,
    path: str,
    dataset: str,
    sys_level: str,
    src_count: int | None,
    curated_count: int | None,
    rejected_count: int | None,
    status: str,
    at: datetime | None = None,
) -> None:
    """Append one row; a count is NULL when the load failed before knowing it."""
    at = at or datetime.now(timezone.utc).replace(tzinfo=None)
    row = (dataset, sys_level, at.isoformat(), src_count, curated_count, rejected_count, status)
    values = [
        F.lit(value).cast(dtype).alias(name)
        for value, (name, dtype) in zip(row, AUDIT_COLUMNS.items())
    ]
    spark.sql("SELECT 1").select(*values).write.mode("append").parquet(path)
