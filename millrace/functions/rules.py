"""Null and regex rules declared on columns, as boolean expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import ColumnSpec
from .columns import col, require


@dataclass(frozen=True)
class Rule:
    """One rule. ``undecided`` marks rows the rule neither passes nor fails."""

    name: str
    failed: Column
    undecided: Column | None = None

    @property
    def passed(self) -> Column:
        """True where the rule is decided and met."""
        return ~self.failed if self.undecided is None else ~self.failed & ~self.undecided


def matches(value: Column, pattern: str) -> Column:
    """Unanchored regex search in the text form of a value; NULL stays NULL."""
    return value.cast("string").rlike(pattern)


def null_rule(name: str) -> Rule:
    return Rule(f"{name}:null", col(name).isNull())


def regex_rule(name: str, pattern: str) -> Rule:
    found = matches(col(name), pattern)
    return Rule(f"{name}:regex", F.coalesce(~found, F.lit(False)), found.isNull())


def declared_rules(
    df: DataFrame, columns: Sequence[ColumnSpec], mode: str = "flag"
) -> list[Rule]:
    """The rules of ``columns`` in order, each column's null rule before its regex.

    Cascade mode takes a regex literally; flag mode ignores blanks around it.
    """
    wanted = [(c, c.regex if mode == "cascade" else c.regex.strip()) for c in columns]
    wanted = [(c, pattern) for c, pattern in wanted if pattern or not c.nullable]
    names = require(df, [c.target for c, _ in wanted], "quality rule")
    rules = []
    for (spec, pattern), name in zip(wanted, names):
        if not spec.nullable:
            rules.append(null_rule(name))
        if pattern:
            rules.append(regex_rule(name, pattern))
    return rules
