"""Keyed upsert for storage without row-level operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import RESERVED_PREFIX, Names, col, orderable, quoted, require

_MATCHES = RESERVED_PREFIX + "matches"
_SPREAD = RESERVED_PREFIX + "spread"


def upsert_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a match, plus all source rows, with the target's columns.

    Source columns that the target lacks are an error.

    Because a matched row is replaced whole, that equals "matched: update all, not
    matched: insert all". As in MERGE, NULL keys never match, and it is an error for
    one target row to be matched by several source rows: the job that evaluates the
    result then fails, before it commits anything.

    Only the distinct source keys are joined, counted map-side first, so a hot source
    key costs one row per task. The target is the outer side, which AQE splits when
    one of its keys is hot. Rows with a NULL key match nothing wherever they go, so
    they are spread over all tasks instead of meeting in one. Nothing is broadcast
    unless AQE measures the keys to be small.
    """
    names = target.columns
    arriving = _arriving(target, source)
    key_names = list(dict.fromkeys(require(target, keys, "upsert key")))
    key_columns = [col(k) for k in key_names]
    # Joined on the hash as well, so these few keys are shuffled once more than they
    # would have to be; AQE only splits hot target keys when the join reads shuffles.
    counts = (
        arriving.filter(_all_present(key_columns))
        .groupBy(*key_columns)
        .agg(F.count(F.lit(1)).alias(_MATCHES))
        .select(
            *[col(k).alias(_joined(k)) for k in key_names],
            F.xxhash64(*key_columns).alias(_joined(_SPREAD)),
            _MATCHES,
        )
    )
    hashable = [col(f.name) for f in target.schema if orderable(f.dataType)]
    spread = F.when(_all_present(key_columns), F.xxhash64(*key_columns)).otherwise(
        F.xxhash64(*hashable)
    )
    on = [col(k) == col(_joined(k)) for k in [*key_names, _SPREAD]]
    several = F.raise_error(F.lit("upsert: several source rows match one target row"))
    unmatched = (
        target.withColumn(_SPREAD, spread)
        .join(counts, on, "left")
        .filter(
            F.when(col(_MATCHES).isNull(), F.lit(True))
            .when(col(_MATCHES) == 1, F.lit(False))
            .otherwise(several.cast("boolean"))
        )
        .select(*[quoted(c) for c in names])
    )
    return unmatched.unionByName(arriving)


def _arriving(target: DataFrame, source: DataFrame) -> DataFrame:
    """Source rows with the target's columns and types."""
    known = Names(target)
    extra = [c for c in source.columns if known.find(c) is None]
    if extra:
        raise ValueError(f"upsert: the target has no column {', '.join(extra)}")
    return source.select(
        *[
            _as_stored(source.schema[present], field)
            for present, field in zip(require(source, target.columns, "upsert source"), target.schema)
        ]
    )


def source_keys(
    target: DataFrame, source: DataFrame, keys: Sequence[str]
) -> tuple[list[str], DataFrame]:
    """Names of the key columns, and their distinct values in the source, as the target
    stores them and without NULLs, which match nothing."""
    names = list(dict.fromkeys(require(target, keys, "upsert key")))
    values = _arriving(target, source).select(*[col(k) for k in names])
    return names, values.filter(_all_present([col(k) for k in names])).distinct()


def _as_stored(given: T.StructField, stored: T.StructField) -> Column:
    value = col(given.name)
    if given.dataType != stored.dataType:
        value = value.cast(stored.dataType)
    return value if given.name == stored.name else value.alias(stored.name)


def _joined(name: str) -> str:
    return f"{RESERVED_PREFIX}source_{name}"


def _all_present(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
