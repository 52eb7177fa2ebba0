"""Row filter, tenant tag and load stamp."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, find, quoted
from ..functions.tags import DEFAULT_TAG, TAG_COLUMN, normalized_tag, repaired_tag


def keep_where(df: DataFrame, condition: str | None) -> DataFrame:
    """Rows for which a SQL boolean expression is true; blank keeps everything."""
    condition = (condition or "").strip()
    return df.filter(condition) if condition else df


def with_domicile(df: DataFrame, default: str = DEFAULT_TAG) -> DataFrame:
    """Every row gets a tag: added when the column is absent, repaired when present.

    A column that differs only in case (``DOMICILE``) is the same column to Spark,
    so it is repaired in place, under the canonical name.
    """
    present = find(df, TAG_COLUMN)
    if present is None:
        return df.withColumn(TAG_COLUMN, F.lit(default))
    return _replace(df, present, repaired_tag(col(present), default))


def normalize_domicile(df: DataFrame, default: str = DEFAULT_TAG) -> DataFrame:
    """``with_domicile`` that also trims and lower-cases each row's tag."""
    present = find(df, TAG_COLUMN)
    if present is None:
        return df.withColumn(TAG_COLUMN, F.lit(default))
    return _replace(df, present, normalized_tag(col(present), default))


def _replace(df: DataFrame, present: str, tag: Column) -> DataFrame:
    return df.select(
        *[tag.alias(TAG_COLUMN) if c == present else quoted(c) for c in df.columns]
    )


#: The columns of the load stamp.
STAMP_COLUMNS = ("load_dt", "load_hr")


def stamp_load(df: DataFrame, load_ts: datetime | None = None) -> DataFrame:
    """Add ``load_dt`` and ``load_hr``, in the session time zone.

    ``load_ts`` fixes the moment: a naive value is wall-clock time as it stands, an
    aware one is an instant. Without it Spark's own clock is used. Columns that already
    have these names are an error.
    """
    taken = [c for c in df.columns if c.lower() in STAMP_COLUMNS]
    if taken:
        raise ValueError(f"rows already have the column {', '.join(taken)}")
    if load_ts is None:
        moment = F.current_timestamp()
    elif load_ts.tzinfo is None:
        moment = F.lit(load_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    else:
        moment = F.lit(load_ts)
    return df.withColumns({"load_dt": F.to_date(moment), "load_hr": F.hour(moment)})
