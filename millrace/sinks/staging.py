"""Raw copy of a load, partitioned by the hour it ran in."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from ..operators.rows import STAMP_COLUMNS, stamp_load
from .published import Dataset, Part


def write_staging(
    df: DataFrame,
    path: str,
    full_load: bool,
    load_ts: datetime | None = None,
    run: str | None = None,
) -> Part:
    """Publish the rows, partitioned by ``load_dt`` and ``load_hr``; returns their part.

    A full load replaces all earlier history, an incremental one adds to it, in place of
    what the same ``run`` added before. Both partition values are constants, so every
    task writes one file and no shuffle is needed.
    """
    rows, dataset = stamp_load(df, load_ts), Dataset(df.sparkSession, path)
    if full_load:
        return dataset.replace(rows, STAMP_COLUMNS)
    return dataset.append(rows, STAMP_COLUMNS, run)
