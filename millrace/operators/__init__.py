"""DataFrame-to-DataFrame operators. All are lazy; none starts a job."""

from .conform import conform_columns, mask_sensitive
from .latest import latest_per_key
from .quality import (
    as_written,
    judge,
    rejected_rows,
    rule_counts,
    split,
    split_summary,
    valid_rows,
)
from .reports import reconcile, schema_report
from .rows import keep_where, normalize_domicile, stamp_load, with_domicile
from .upsert import upsert_rows

__all__ = [
    "as_written",
    "conform_columns",
    "judge",
    "keep_where",
    "latest_per_key",
    "mask_sensitive",
    "normalize_domicile",
    "reconcile",
    "rejected_rows",
    "rule_counts",
    "schema_report",
    "split",
    "split_summary",
    "stamp_load",
    "upsert_rows",
    "valid_rows",
    "with_domicile",
]
