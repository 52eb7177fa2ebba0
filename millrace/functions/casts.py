"""Casts that do not stop a load, as SQL text: one call per column, however wide.

``try_cast`` gives NULL for a value that does not fit, but finds out by raising and
catching an exception: some 10 to 15 microseconds a value, fifty times the cost of a
cast that works. ``cast_sql`` therefore first asks a comparison that every convertible
value passes, and leaves only the values that pass to ``try_cast``.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T

CAST_MODES = ("try", "session")

_INTEGRAL_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
#: Slack of the range tests, which compare as doubles; values inside it are tried.
_SLACK = 1.001

# First letters of text that is a special number or a truth value.
_NUMBER_WORDS = "IiNn"
_TRUTH_WORDS = "TtYyFfNn"


@cache
def parsed(type_text: str) -> T.DataType:
    """The Spark type a declaration names; fails on anything that is not a type."""
    return T.DataType.fromDDL(type_text)


def cast_sql(value: str, source: T.DataType, target_type: str, mode: str = "try") -> str:
    """SQL for ``value``, itself SQL of type ``source``, as ``target_type``.

    ``try`` gives NULL for a value that does not fit, whatever the session says.
    ``session`` is a plain cast: an error under ANSI mode, Spark's legacy rules
    (``'9.7'`` becomes 9, numbers wrap) when the session turned ANSI mode off.
    """
    if mode not in CAST_MODES:
        raise ValueError(f"cast mode must be one of {CAST_MODES}, not {mode!r}")
    target = parsed(target_type)
    if mode == "session":
        return f"CAST({value} AS {target_type})"
    test = plausible_sql(value, source, target)
    tried = f"try_cast({value} AS {target_type})"
    return tried if test is None else f"CASE WHEN {test} THEN {tried} END"


def misfit_sql(value: str, source: T.DataType, target_type: str) -> str:
    """SQL that is true where a value is present but ``target_type`` cannot hold it."""
    return f"{value} IS NOT NULL AND ({cast_sql(value, source, target_type)}) IS NULL"


def plausible_sql(value: str, source: T.DataType, target: T.DataType) -> str | None:
    """A cheap test that no convertible value fails; None when none is worth it."""
    if source.simpleString() == "string":  # not a collated one
        return _plausible_text(value, target)
    if isinstance(source, T.NumericType):
        limit = _limit(source, target)
        if limit is not None:
            bound = f"{limit * _SLACK + 1!r}D"
            return f"CAST({value} AS DOUBLE) BETWEEN -{bound} AND {bound}"
    return None


def _plausible_text(text: str, target: T.DataType) -> str | None:
    if isinstance(target, T.BooleanType):
        words = _TRUTH_WORDS
    elif isinstance(target, (T.FloatType, T.DoubleType)):
        words = _NUMBER_WORDS
    elif isinstance(target, T.NumericType):
        words = ""
    else:
        return None
    # Compared bytewise: blanks, signs and digits sort before ":", letters after it,
    # and whatever sorts after them, such as other scripts' digits, is tried too.
    possible = [f"{text} < ':'", f"{text} >= chr(127)"]
    possible += [f"({text} >= '{c}' AND {text} < '{chr(ord(c) + 1)}')" for c in words]
    return f"{text} <> '' AND ({' OR '.join(possible)})"


def _limit(source: T.NumericType, target: T.DataType) -> float | None:
    """Largest magnitude ``target`` holds, if ``source`` can exceed it."""
    room = _magnitude(target)
    return room if room is not None and _magnitude(source, float("inf")) > room else None


def _magnitude(kind: T.DataType, unbounded: float | None = None) -> float | None:
    if type(kind) in _INTEGRAL_BITS:
        return 2.0 ** (_INTEGRAL_BITS[type(kind)] - 1)
    if isinstance(kind, T.DecimalType):
        return 10.0 ** (kind.precision - kind.scale)
    return unbounded
