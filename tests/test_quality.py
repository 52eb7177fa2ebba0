from __future__ import annotations

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace import ColumnSpec
from millrace.operators import (
    judge,
    reconcile,
    rejected_rows,
    rule_counts,
    schema_report,
    split,
    split_summary,
    valid_rows,
)
from millrace.operators.quality import LOST, OUTCOME, REJECT, VALID

COLUMNS = (
    ColumnSpec("a", "a", "string", "string", nullable=False, regex="^[xy]"),
    ColumnSpec("b", "b", "int", "int", nullable=False),
    ColumnSpec("c", "c", "string", "string", regex="z"),
    ColumnSpec("d", "d", "string", "string"),
)
SCHEMA = "a string, b int, c string, d string"
text = st.sampled_from([None, "x", "yz", "z", "q", ""])
records = st.lists(st.tuples(text, st.sampled_from([None, 1]), text, text), min_size=1, max_size=30)


def rules():
    """(name, test) pairs; a test gives True, False or None for undecided."""

    def found(pattern, value):
        return None if value is None else bool(re.search(pattern, value))

    return [
        ("a:null", lambda r: r[0] is not None),
        ("a:regex", lambda r: found("^[xy]", r[0])),
        ("b:null", lambda r: r[1] is not None),
        ("c:regex", lambda r: found("z", r[2])),
    ]


def flag(row):
    failed = [name for name, test in rules() if test(row) is False]
    return (REJECT if failed else VALID), failed


def cascade(row):
    for name, test in rules():
        if test(row) is None:
            return LOST, []
        if test(row) is False:
            return REJECT, [name]
    return VALID, []


MODELS = {"flag": flag, "cascade": cascade}


@pytest.mark.parametrize("mode", MODELS)
@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(records)
def test_against_brute_force(spark, mode, data):
    df = spark.createDataFrame(data, SCHEMA)
    judged = judge(df, COLUMNS, mode).collect()
    for row in judged:
        assert (row[OUTCOME], row["dq_reasons"]) == MODELS[mode](tuple(row)[:4])

    sides = {VALID: [], REJECT: [], LOST: []}
    for row in data:
        sides[MODELS[mode](row)[0]].append(row)
    valid, rejected = split(df, COLUMNS, mode)
    assert valid.columns == rejected.columns == df.columns
    assert Counter(map(tuple, valid.collect())) == Counter(sides[VALID])
    assert Counter(map(tuple, rejected.collect())) == Counter(sides[REJECT])

    summary = split_summary(df, COLUMNS, mode).first().asDict()
    assert summary == {outcome: len(rows) for outcome, rows in sides.items()}

    expected = Counter(name for row in data for name in MODELS[mode](row)[1])
    if mode == "cascade" and sides[LOST]:
        expected[LOST] = len(sides[LOST])
    counts = {r.rule: r.rows for r in rule_counts(df, COLUMNS, mode).collect()}
    assert counts == dict(expected)


@pytest.mark.parametrize("mode", MODELS)
def test_no_rules(spark, mode):
    df = spark.range(3)
    judged = judge(df, [], mode)
    assert valid_rows(judged).count() == 3
    assert rejected_rows(judged, reasons=True).count() == 0
    assert split(df, [], mode)[0].count() == 3 and split(df, [], mode)[1].count() == 0
    assert rule_counts(df, [], mode).count() == 0


def test_regex_on_other_types_and_blank_patterns(spark):
    df = spark.createDataFrame([(12, "p"), (34, "q")], "n int, s string")
    number = ColumnSpec("n", "n", "int", "int", regex="^1")
    blank = ColumnSpec("s", "s", "string", "string", regex="   ")
    assert [r.n for r in split(df, [number, blank])[0].collect()] == [12]


def test_blanks_around_a_pattern_count_in_cascade_mode_only(spark):
    df = spark.createDataFrame([("x",), ("x ",)], "s string")
    spec = [ColumnSpec("s", "s", "string", "string", regex="x ")]
    assert split(df, spec, "flag")[0].count() == 2
    assert split(df, spec, "cascade")[0].count() == 1


def test_rule_on_an_absent_column(spark):
    with pytest.raises(ValueError, match="quality rule: no such column: zz"):
        judge(spark.range(1), [ColumnSpec("zz", "zz", "int", "int", nullable=False)])


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        judge(spark.range(1), [], "other")


# --- reports -------------------------------------------------------------------


def report(df, columns, **options):
    return {r["column"]: tuple(r)[1:] for r in schema_report(df, columns, **options).collect()}


def test_schema_report(spark):
    df = spark.createDataFrame(
        [("1", None, [1]), ("x", 2, [2]), (None, 3, None)], "A string, e int, list array<int>"
    )
    columns = [
        ColumnSpec("a", "a", "string", "int"),
        ColumnSpec("list", "list", "array<int>", "date"),
        ColumnSpec("gone", "gone", "int", "int"),
    ]
    assert report(df, columns) == {
        "a": ("ok", "info", 1, 1),
        "list": ("ok", "info", 1, 2),
        "gone": ("missing", "error", None, None),
        "e": ("extra", "info", None, None),
    }
    tolerant = report(df, columns, allow_extra=False, allow_missing=True)
    assert tolerant["gone"][1] == "warn" and tolerant["e"][1] == "warn"
    assert report(df, columns, check=False) == {}
    with pytest.raises(ValueError, match="missing columns: gone"):
        schema_report(df, columns, strict=True)


def test_schema_report_with_nothing_present(spark):
    df = spark.range(2)
    assert report(df, [ColumnSpec("x", "x", "int", "int")]) == {
        "x": ("missing", "error", None, None),
        "id": ("extra", "info", None, None),
    }


@pytest.mark.parametrize(
    "src, curated, expected",
    [
        (0, 0, (0, 0, 0, 0.0, True)),
        (3, 3, (3, 3, 0, 0.0, True)),
        (3, 2, (3, 2, 1, 33.33, False)),
        (2, 3, (2, 3, -1, -50.0, False)),
    ],
)
def test_reconcile(spark, src, curated, expected):
    assert tuple(reconcile(spark.range(src), spark.range(curated)).first()) == expected
