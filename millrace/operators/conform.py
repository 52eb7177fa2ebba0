"""Renames, casts and masks, each as a single projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.casts import cast_sql
from ..functions.columns import Names, check_distinct, quoted
from ..functions.masks import UNMASKED, level_of, mask_literal
from ..spec import ColumnSpec


def conform_columns(
    df: DataFrame, columns: Sequence[ColumnSpec], cast_mode: str = "try"
) -> DataFrame:
    """Rename and cast the declared columns; undeclared ones pass through.

    All renames happen at once, so names can be swapped. A declared column that is
    absent is skipped, unless it would have to be cast. A column already carrying
    its target name counts as renamed.
    """
    names = Names(df)
    declared = {names.find(spec.source): spec for spec in columns}
    absent = [spec for spec in columns if names.find(spec.source) is None]
    for spec in absent:
        renamed = names.find(spec.target)
        if renamed is not None and renamed not in declared:
            declared[renamed] = spec
        elif spec.is_cast:
            raise ValueError(f"cannot cast {spec.target}: no column {spec.source}")

    out, out_names = [], []
    for field in df.schema:
        name, value = field.name, quoted(field.name)
        spec = declared.get(name)
        if spec is not None:
            if spec.is_cast:
                value = cast_sql(value, field.dataType, spec.target_type, cast_mode)
            name = spec.target
        out_names.append(name)
        out.append(f"{value} AS {quoted(name)}")
    check_distinct(df.sparkSession, out_names, "conform_columns")
    return df.selectExpr(*out)


def mask_sensitive(
    df: DataFrame, columns: Sequence[ColumnSpec], on_unknown: str = "error"
) -> DataFrame:
    """Replace every value, NULLs too, of tagged columns by the mask of their level.

    The masked source column is then unused, so Catalyst drops it from the scan.
    ``on_unknown="keep"`` leaves columns of an unknown level as they are.
    """
    names, masks = Names(df), {}
    for spec in columns:
        level = level_of(spec.sensitivity)
        present = names.find(spec.target)
        if level == UNMASKED or present is None:
            continue
        literal = mask_literal(level)
        if literal is None:
            if on_unknown == "keep":
                continue
            raise ValueError(f"{spec.target}: unknown sensitivity level {level!r}")
        masks[present] = literal
    if not masks:
        return df
    return df.select(
        *[masks[c].alias(c) if c in masks else quoted(c) for c in df.columns]
    )
