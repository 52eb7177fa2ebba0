"""Masks for sensitive columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What replaces every value of a column at each sensitivity level.
MASKS = {
    "pii": "********",
    "phi": "#####",
    "confidential": "XXX-CONFIDENTIAL-XXX",
}
UNMASKED = "none"


def level_of(sensitivity: str | None) -> str:
    """Sensitivity in the spelling ``MASKS`` uses; nothing given means unmasked."""
    return (sensitivity or UNMASKED).strip().lower() or UNMASKED


def mask_literal(level: str) -> Column | None:
    """The constant for a level, or ``None`` when the level has no mask."""
    return F.lit(MASKS[level]) if level in MASKS else None
