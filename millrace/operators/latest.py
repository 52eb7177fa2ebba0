"""Keyed dedupe: one row per key, the most recent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import RESERVED_PREFIX, orderable, quoted, require

_RANK = RESERVED_PREFIX + "rank"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    recency: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the first row of each key by ``recency``, all descending, NULLs last.

    Rows with a NULL key form one group. Either list empty: the input, unchanged.
    Ties go to ``tie_break``, by default every other sortable column, so that the
    same input always gives the same rows however it is partitioned; ``()`` leaves
    ties to Spark and lets unused columns be pruned.

    The "row number, then = 1" form is what Spark turns into a group limit *before*
    the shuffle: each map task sends at most one row per key, so a key holding a
    third of the table reaches its reducer as one row per map task.
    """
    if not keys or not recency:
        return df
    key_names = require(df, keys, "dedupe key")
    order = require(df, recency, "dedupe recency")
    if tie_break is None:
        used = {*key_names, *order}
        rest = [f.name for f in df.schema if f.name not in used and orderable(f.dataType)]
    else:
        rest = require(df, tie_break, "dedupe tie-break")
    partition = ", ".join(quoted(c) for c in key_names)
    ordering = ", ".join(f"{quoted(c)} DESC NULLS LAST" for c in [*order, *rest])
    rank = F.expr(f"row_number() OVER (PARTITION BY {partition} ORDER BY {ordering})")
    return df.withColumn(_RANK, rank).filter(f"{_RANK} = 1").drop(_RANK)
