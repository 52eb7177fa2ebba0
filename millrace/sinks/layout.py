"""How rows are spread over tasks before a partitioned write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.columns import col


def gathered(df: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """Bring equal partition values together so each becomes a few large files.

    Without this every task holds every value and writes a file for each. The hint
    leaves sizes to AQE, which splits a partition value that holds a large share of
    the rows over many tasks and packs small ones together.
    """
    if not partition_columns:
        return df
    return df.hint("rebalance", *[col(c) for c in partition_columns])
