"""Millrace: metadata-driven data curation on Spark DataFrames."""

from .plans.load import LoadOptions, LoadPaths, LoadResult, run_load
from .sources.files import load_spec, read_source
from .spec import ColumnSpec, DatasetSpec, TableSpec

__all__ = [
    "ColumnSpec",
    "DatasetSpec",
    "LoadOptions",
    "LoadPaths",
    "LoadResult",
    "TableSpec",
    "load_spec",
    "read_source",
    "run_load",
]
