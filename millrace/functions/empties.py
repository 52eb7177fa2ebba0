"""Empty strings in partition columns.

Spark's file writers store an empty string in a partition column as NULL. Files that this
package writes hold a stand-in instead, which readers of this package turn back, so that
``''`` and NULL stay two values. Values that look like the stand-in get one more underscore
in front, and lose it again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import col, find

#: What an empty string is stored as.
EMPTY = "__empty__"


def stored(value: Column) -> Column:
    return (
        F.when(value == "", F.lit(EMPTY))
        .when(value.rlike(rf"\A_*{EMPTY}\z"), F.concat(F.lit("_"), value))
        .otherwise(value)
    )


def restored(value: Column) -> Column:
    return (
        F.when(value == EMPTY, F.lit(""))
        .when(value.rlike(rf"\A_+{EMPTY}\z"), F.substring(value, 2, 1 << 30))
        .otherwise(value)
    )


def _texts(df: DataFrame, columns: Sequence[str]) -> list[str]:
    named = [find(df, c) for c in columns]
    return [c for c in named if c is not None and isinstance(df.schema[c].dataType, T.StringType)]


def with_stored(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with its partition columns as they are to be written."""
    texts = _texts(df, columns)
    return df.withColumns({c: stored(col(c)) for c in texts}) if texts else df


def with_restored(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows read from files, with the partition values that were given to the writer."""
    texts = _texts(df, columns)
    return df.withColumns({c: restored(col(c)) for c in texts}) if texts else df
