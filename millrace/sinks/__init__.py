"""Everything that writes: staging, curated output, rejects, audit, catalog tables."""

from .audit import append_audit
from .curated import write_curated_files
from .published import Dataset, read_published
from .rejects import (
    publish_rejects,
    register_reject_partition,
    register_rejects,
    write_rejects,
    write_rejects_partition,
)
from .staging import write_staging
from .tables import (
    create_table,
    merge_into_table,
    publish_table,
    read_table,
    replace_table,
    table_name,
)

__all__ = [
    "Dataset",
    "append_audit",
    "create_table",
    "merge_into_table",
    "publish_rejects",
    "publish_table",
    "read_published",
    "read_table",
    "register_reject_partition",
    "register_rejects",
    "replace_table",
    "table_name",
    "write_curated_files",
    "write_rejects",
    "write_rejects_partition",
    "write_staging",
]
