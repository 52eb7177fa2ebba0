"""End-to-end loads composed from the operators and sinks."""

from .load import LoadOptions, LoadPaths, LoadResult, run_load

__all__ = ["LoadOptions", "LoadPaths", "LoadResult", "run_load"]
