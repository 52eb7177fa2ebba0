"""Schema conformance and row-count reconciliation as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import misfit_sql
from ..functions.columns import Names, col, quoted
from ..spec import ColumnSpec

_REPORT = "column string, issue string, severity string, nulls bigint, bad_casts bigint"


@dataclass(frozen=True)
class SchemaIssue:
    """A declared column (missing or ok) or an undeclared one (extra)."""

    column: str
    issue: str
    severity: str


def schema_issues(
    df: DataFrame,
    columns: Sequence[ColumnSpec],
    allow_extra: bool = True,
    allow_missing: bool = False,
) -> list[SchemaIssue]:
    """Compare column names only: no job, just the schema."""
    names, issues, declared = Names(df), [], set()
    for spec in columns:
        present = names.find(spec.source)
        if present is None:
            severity = "warn" if allow_missing else "error"
            issues.append(SchemaIssue(spec.source, "missing", severity))
        else:
            declared.add(present)
            issues.append(SchemaIssue(spec.source, "ok", "info"))
    severity = "info" if allow_extra else "warn"
    extra = [c for c in df.columns if c not in declared]
    return issues + [SchemaIssue(c, "extra", severity) for c in extra]


def raise_on_error(issues: Sequence[SchemaIssue]) -> None:
    bad = [i.column for i in issues if i.severity == "error"]
    if bad:
        raise ValueError(f"schema check: missing columns: {', '.join(bad)}")


def conformance_metrics(df: DataFrame, columns: Sequence[ColumnSpec]) -> list[Column]:
    """Per present column: NULLs, and values its target type cannot hold.

    Plain aggregates, so one pass serves any number of columns and a load can attach
    them to a write it does anyway. Named ``nulls_<i>`` and ``bad_casts_<i>``.
    """
    names, types = Names(df), {f.name: f.dataType for f in df.schema}
    nulls, misfits = {}, {}
    for i, spec in enumerate(columns):
        name = names.find(spec.source)
        if name is None:
            continue
        nulls[i] = f"{quoted(name)} IS NULL"
        misfits[i] = (
            misfit_sql(quoted(name), types[name], spec.target_type) if spec.is_cast else "false"
        )
    if not _all_resolve(df, misfits.values()):
        # Where no such cast exists, every value present is lost.
        for i, test in misfits.items():
            if not _all_resolve(df, [test]):
                misfits[i] = f"NOT ({nulls[i]})"
    return [
        F.expr(f"count_if({test}) AS {kind}_{i}")
        for kind, tests in (("nulls", nulls), ("bad_casts", misfits))
        for i, test in tests.items()
    ]


def _all_resolve(df: DataFrame, expressions: Iterable[str]) -> bool:
    try:
        df.selectExpr(*expressions)
    except AnalysisException:
        return False
    return True


def schema_report(
    df: DataFrame,
    columns: Sequence[ColumnSpec],
    check: bool = True,
    allow_extra: bool = True,
    allow_missing: bool = False,
    strict: bool = False,
) -> DataFrame:
    """One row per declared or extra column: issue, severity, NULLs, bad casts.

    Counts are NULL where a column is missing or undeclared. All counts come from a
    single aggregation; ``strict`` raises on an error before any job runs.
    """
    if not check:
        return df.sparkSession.createDataFrame([], _REPORT)
    issues = schema_issues(df, columns, allow_extra, allow_missing)
    if strict:
        raise_on_error(issues)
    metrics = conformance_metrics(df, columns)
    index = {spec.source: i for i, spec in enumerate(columns)}
    lines = []
    for issue in issues:
        counted = issue.issue == "ok"
        i = index.get(issue.column)
        lines.append(
            F.struct(
                F.lit(issue.column).alias("column"),
                F.lit(issue.issue).alias("issue"),
                F.lit(issue.severity).alias("severity"),
                (col(f"nulls_{i}") if counted else F.lit(None).cast("bigint")).alias("nulls"),
                (col(f"bad_casts_{i}") if counted else F.lit(None).cast("bigint")).alias(
                    "bad_casts"
                ),
            )
        )
    if not lines:
        return df.sparkSession.createDataFrame([], _REPORT)
    return df.agg(*(metrics or [F.count(F.lit(1))])).select(F.inline(F.array(*lines)))


def loss_pct(src: Column, rejected: Column) -> Column:
    """Share of source rows not published, in percent with two decimals."""
    return F.when(src > 0, F.round(rejected / src * 100, 2)).otherwise(F.lit(0.0))


def reconcile(source: DataFrame, curated: DataFrame) -> DataFrame:
    """One row ``(src, curated, rejected, loss_pct, matched)``.

    ``rejected`` is everything that did not arrive: quality rejects, rows removed as
    duplicates, rows lost in cascade mode. Neither side is shuffled: each is counted
    per task and only the partial counts meet.
    """
    sides = source.select(F.lit(1).alias("s"), F.lit(0).alias("c")).unionAll(
        curated.select(F.lit(0).alias("s"), F.lit(1).alias("c"))
    )
    counts = sides.agg(
        F.count_if(F.col("s") == 1).alias("src"), F.count_if(F.col("c") == 1).alias("curated")
    ).withColumn("rejected", F.col("src") - F.col("curated"))
    return counts.select(
        "src",
        "curated",
        "rejected",
        loss_pct(F.col("src"), F.col("rejected")).alias("loss_pct"),
        (F.col("src") == F.col("curated")).alias("matched"),
    )
