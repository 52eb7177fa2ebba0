"""Data-quality judgement: one projection decides every row, writers only filter it.

``judge`` adds two columns. ``__dq_outcome`` is ``valid``, ``reject`` or ``lost``;
``dq_reasons`` lists the rules a row failed, as ``column:null`` / ``column:regex``.

* ``flag`` mode tests all rules on every row. A NULL passes a regex rule.
* ``cascade`` mode stops at the first rule that a row does not pass. A NULL neither
  passes nor fails a regex rule; a row that meets one is ``lost``: in neither output.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import RESERVED_PREFIX, col
from ..functions.rules import Rule, declared_rules
from ..spec import DQ_MODES, ColumnSpec

OUTCOME = RESERVED_PREFIX + "dq_outcome"
REASONS = "dq_reasons"
VALID, REJECT, LOST = "valid", "reject", "lost"


def judge(df: DataFrame, columns: Sequence[ColumnSpec], mode: str = "flag") -> DataFrame:
    """Add the outcome and the reasons of every row; see the module text."""
    rules = declared_rules(df, columns, _checked(mode))
    outcome, reasons = _VERDICTS[mode](rules)
    return df.select("*", outcome.alias(OUTCOME), reasons.alias(REASONS))


def _checked(mode: str) -> str:
    if mode not in DQ_MODES:
        raise ValueError(f"mode must be one of {DQ_MODES}, not {mode!r}")
    return mode


def _no_reasons() -> Column:
    return F.array().cast("array<string>")


def _flag_verdict(rules: Sequence[Rule]) -> tuple[Column, Column]:
    if not rules:
        return F.lit(VALID), _no_reasons()
    reasons = _failed_names(rules)
    outcome = F.when(F.size(reasons) == 0, F.lit(VALID)).otherwise(F.lit(REJECT))
    return outcome, reasons


def _failed_names(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row fails, as an array.

    ``array_remove`` compiles into the surrounding stage; ``array_compact`` and
    ``filter``, which take a lambda, would interrupt code generation.
    """
    names = [F.when(r.failed, F.lit(r.name)).otherwise(F.lit("")) for r in rules]
    return F.array_remove(F.array(*names), "")


def _cascade_verdict(rules: Sequence[Rule]) -> tuple[Column, Column]:
    if not rules:
        return F.lit(VALID), _no_reasons()
    first = _first_outcome(rules)
    outcome = (
        F.when(first.isNull(), F.lit(VALID))
        .when(first == LOST, F.lit(LOST))
        .otherwise(F.lit(REJECT))
    )
    reasons = F.when(first.isNotNull() & (first != LOST), F.array(first)).otherwise(_no_reasons())
    return outcome, reasons


def _first_outcome(rules: Sequence[Rule]) -> Column:
    """Name of the first rule a row fails, ``lost`` at an undecided one, else NULL."""
    case = None
    for rule in rules:
        branches = [(rule.failed, rule.name)]
        if rule.undecided is not None:
            branches.append((rule.undecided, LOST))
        for condition, result in branches:
            case = (F if case is None else case).when(condition, F.lit(result))
    return case


_VERDICTS = {"flag": _flag_verdict, "cascade": _cascade_verdict}


def as_written(judged: DataFrame, outcome: str, reasons: bool = False) -> DataFrame:
    """The rows with one outcome, without helper columns; ``reasons`` keeps the list."""
    rows = judged.filter(col(OUTCOME) == outcome).drop(OUTCOME)
    return rows if reasons else rows.drop(REASONS)


def valid_rows(judged: DataFrame) -> DataFrame:
    return as_written(judged, VALID)


def rejected_rows(judged: DataFrame, reasons: bool = False) -> DataFrame:
    return as_written(judged, REJECT, reasons)


def split(
    df: DataFrame, columns: Sequence[ColumnSpec], mode: str = "flag"
) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``, both with the columns of ``df``.

    The valid side is a plain conjunction, so its not-null tests reach the scan.
    To write both sides, ``judge`` once, write that, and filter what was written.
    """
    rules = declared_rules(df, columns, _checked(mode))
    if not rules:
        return df, df.filter(F.lit(False))
    if mode == "flag":
        valid = df.filter(reduce(lambda a, b: a & b, [~r.failed for r in rules]))
        return valid, df.filter(reduce(lambda a, b: a | b, [r.failed for r in rules]))
    valid = df.filter(reduce(lambda a, b: a & b, [r.passed for r in rules]))
    return valid, df.filter(_first_outcome(rules) != LOST)


def outcome_metrics() -> list[Column]:
    """Aggregates over judged rows; usable in ``agg`` and in ``observe``."""
    return [F.count_if(col(OUTCOME) == o).alias(o) for o in (VALID, REJECT, LOST)]


def rule_metrics(rules: Sequence[str]) -> list[Column]:
    """Failures of each named rule over judged rows, same two uses."""
    return [F.count_if(F.array_contains(REASONS, rule)).alias(rule) for rule in rules]


def rule_names(df: DataFrame, columns: Sequence[ColumnSpec], mode: str = "flag") -> list[str]:
    return [r.name for r in declared_rules(df, columns, mode)]


def rule_counts(df: DataFrame, columns: Sequence[ColumnSpec], mode: str = "flag") -> DataFrame:
    """``(rule, rows)`` for every rule that some row failed, and for ``lost`` rows.

    Grouped on the rule name after a map-side partial count, so at most one row per
    rule leaves each task.
    """
    rules = declared_rules(df, columns, _checked(mode))
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, rows bigint")
    if mode == "cascade":
        named = df.select(_first_outcome(rules).alias("rule")).filter("rule IS NOT NULL")
    else:
        named = df.select(F.explode(_failed_names(rules)).alias("rule"))
    return named.groupBy("rule").agg(F.count(F.lit(1)).alias("rows"))


def split_summary(df: DataFrame, columns: Sequence[ColumnSpec], mode: str = "flag") -> DataFrame:
    """One row ``(valid, reject, lost)`` from one pass."""
    return judge(df, columns, mode).agg(*outcome_metrics())
