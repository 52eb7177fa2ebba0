"""The tenant tag (``domicile``) carried by every row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tag column, its default, and the spellings that mean "no tag".
TAG_COLUMN = "domicile"
DEFAULT_TAG = "global"
BLANK_TAGS = ("", "null", "none")


def repaired_tag(tag: Column, default: str) -> Column:
    """``default`` for a missing tag; any other value exactly as it is.

    The cast comes first, so a tag column that a reader inferred as a number is
    compared as text instead of failing under ANSI mode.
    """
    text = tag.cast("string")
    blank = text.isNull() | F.lower(text).isin(*BLANK_TAGS)
    return F.when(blank, F.lit(default)).otherwise(text)


def normalized_tag(tag: Column, default: str = DEFAULT_TAG) -> Column:
    """Trimmed, lower-case tag, or ``default`` when nothing is left."""
    text = F.lower(F.trim(tag.cast("string")))
    return F.when(text.isNull() | text.isin(*BLANK_TAGS), F.lit(default)).otherwise(text)


def normalized_name(tag: str | None, default: str = DEFAULT_TAG) -> str:
    """``normalized_tag`` for the one tag written in a dataset specification."""
    text = (tag or "").strip().lower()
    return default if text in BLANK_TAGS else text
