"""Curated rows as Parquet files partitioned by tag."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.columns import Names, find
from ..functions.tags import DEFAULT_TAG, TAG_COLUMN
from ..operators.rows import with_domicile
from .layout import gathered
from .published import Dataset


def write_curated_files(
    df: DataFrame,
    path: str,
    full_load: bool,
    domicile: str = DEFAULT_TAG,
    single_tag: bool = False,
    watch: Callable[[DataFrame], DataFrame] = lambda df: df,
    run: str | None = None,
) -> T.StructType:
    """Publish in place of all tags (full load) or add as is; returns the written schema.

    Adding does not look at the rows already there, but takes the place of what the same
    ``run`` added before. ``single_tag`` says that all rows share one tag, which saves the
    shuffle that gathers rows by tag; a tag added here is such a constant. ``watch`` may
    observe the rows as they are written.
    """
    single_tag = single_tag or find(df, TAG_COLUMN) is None
    if find(df, TAG_COLUMN) is None:
        df = with_domicile(df, domicile)
    rows = watch(df if single_tag else gathered(df, [TAG_COLUMN]))
    dataset = Dataset(df.sparkSession, path)
    if full_load:
        dataset.replace(rows, [TAG_COLUMN])
    else:
        dataset.append(rows, [TAG_COLUMN], run)
    return df.schema


def with_earlier_columns(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """``schema`` and the columns that only rows of earlier runs have."""
    known = Names(spark.createDataFrame([], schema))
    earlier = Dataset(spark, path).schema()
    return T.StructType([*schema, *[f for f in earlier if known.find(f.name) is None]])
