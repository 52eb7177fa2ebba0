"""Reading source files and dataset specifications."""

from .drift import file_schemas, schema_report_files
from .files import load_spec, read_source, source_count

__all__ = ["file_schemas", "load_spec", "read_source", "schema_report_files", "source_count"]
