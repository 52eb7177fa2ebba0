from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from millrace import ColumnSpec
from millrace.operators import (
    conform_columns,
    keep_where,
    mask_sensitive,
    normalize_domicile,
    stamp_load,
    with_domicile,
)
from millrace.runtime import settings


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- filter --------------------------------------------------------------------


@pytest.mark.parametrize("condition", [None, "", "  "])
def test_blank_condition_keeps_everything(spark, condition):
    assert keep_where(spark.range(3), condition).count() == 3


def test_null_condition_drops_the_row(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    assert rows(keep_where(df, "a > 1")) == [(3,)]


# --- tenant tag ----------------------------------------------------------------


def test_tag_added(spark):
    assert rows(with_domicile(spark.range(1), "emea")) == [(0, "emea")]


def test_tag_repaired_in_place_and_otherwise_untouched(spark):
    values = [None, "", "NULL", "None", " us ", "EU"]
    df = spark.createDataFrame([(v, 1) for v in values], "domicile string, a int")
    out = with_domicile(df, "x")
    assert out.columns == ["domicile", "a"]
    assert [r[0] for r in rows(out)] == ["x", "x", "x", "x", " us ", "EU"]


def test_upper_case_tag_is_repaired_not_replaced(spark):
    df = spark.createDataFrame([("us",), (None,)], "DOMICILE string")
    out = with_domicile(df)
    assert out.columns == ["domicile"] and rows(out) == [("us",), ("global",)]


def test_numeric_tag_does_not_fail(spark):
    df = spark.createDataFrame([(1,), (None,)], "domicile int")
    assert rows(with_domicile(df)) == [("1",), ("global",)]


def test_tag_normalized(spark):
    df = spark.createDataFrame([(" Us ",), (" NONE ",), (None,)], "domicile string")
    assert rows(normalize_domicile(df)) == [("us",), ("global",), ("global",)]
    assert rows(normalize_domicile(spark.range(1))) == [(0, "global")]


# --- load stamp ----------------------------------------------------------------


def test_naive_stamp_is_wall_clock_time(spark):
    with settings(spark, {"spark.sql.session.timeZone": "Asia/Tokyo"}):
        out = rows(stamp_load(spark.range(1), datetime(2024, 3, 5, 23, 30)))
    assert out == [(0, date(2024, 3, 5), 23)]


def test_aware_stamp_is_an_instant_in_the_session_zone(spark):
    with settings(spark, {"spark.sql.session.timeZone": "Asia/Tokyo"}):
        moment = datetime(2024, 3, 5, 23, 30, tzinfo=timezone.utc)
        out = rows(stamp_load(spark.range(1), moment))
    assert out == [(0, date(2024, 3, 6), 8)]


def test_stamp_defaults_to_now(spark):
    out = stamp_load(spark.range(1))
    assert dict(out.dtypes)["load_dt"] == "date" and dict(out.dtypes)["load_hr"] == "int"
    assert out.filter("load_dt >= current_date() - 1").count() == 1


# --- rename and cast -----------------------------------------------------------


def test_swapped_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    swap = [ColumnSpec("a", "b", "int", "int"), ColumnSpec("b", "a", "int", "bigint")]
    out = conform_columns(df, swap)
    assert out.dtypes == [("b", "int"), ("a", "bigint"), ("c", "int")]
    assert rows(out) == [(1, 2, 3)]


def test_source_names_match_without_case(spark):
    out = conform_columns(spark.range(1), [ColumnSpec("ID", "key", "bigint", "bigint")])
    assert out.columns == ["key"]


def test_odd_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a b", "c.d", "e`f"])
    columns = [
        ColumnSpec("a b", "x.y", "bigint", "string"),
        ColumnSpec("c.d", "z z", "bigint", "int"),
    ]
    out = conform_columns(df, columns)
    assert out.columns == ["x.y", "z z", "e`f"] and rows(out) == [("1", 2, 3)]


def test_values_that_do_not_fit_become_null(spark):
    texts = ["abc", "9", " 9 ", "9.7", "1e2", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    spec = [ColumnSpec("t", "t", "string", "int")]
    assert [r[0] for r in rows(conform_columns(df, spec))] == [None, 9, 9, None, None, None]


def test_session_cast_mode_follows_the_session(spark):
    df = spark.createDataFrame([("9.7",), ("abc",)], "t string")
    spec = [ColumnSpec("t", "t", "string", "int")]
    with settings(spark, {"spark.sql.ansi.enabled": "false"}):
        assert rows(conform_columns(df, spec, cast_mode="session")) == [(9,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform_columns(df, spec, cast_mode="session").collect()
    with pytest.raises(ValueError, match="cast mode"):
        conform_columns(df, spec, cast_mode="guess")


def test_absent_columns(spark):
    df = spark.createDataFrame([("5",)], "done string")
    plain = ColumnSpec("gone", "other", "int", "int")
    renamed = ColumnSpec("raw", "done", "string", "int")
    assert rows(conform_columns(df, [plain, renamed])) == [(5,)]
    with pytest.raises(ValueError, match="cannot cast other"):
        conform_columns(df, [ColumnSpec("gone", "other", "string", "int")])


def test_rename_onto_an_existing_column(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="duplicate column"):
        conform_columns(df, [ColumnSpec("a", "B", "int", "int")])


# --- masks ---------------------------------------------------------------------


def masked(level, **kw):
    return ColumnSpec("a", "a", "int", "int", sensitivity=level, **kw)


@pytest.mark.parametrize(
    "level, mask",
    [("pii", "********"), (" PHI ", "#####"), ("confidential", "XXX-CONFIDENTIAL-XXX")],
)
def test_every_value_is_masked(spark, level, mask):
    df = spark.createDataFrame([(1, 1), (None, 2)], "a int, b int")
    assert rows(mask_sensitive(df, [masked(level)])) == [(mask, 1), (mask, 2)]


@pytest.mark.parametrize("level", [None, "none", "NONE", ""])
def test_unmasked_levels(spark, level):
    df = spark.createDataFrame([(1,)], "a int")
    assert mask_sensitive(df, [masked(level)]) is df


def test_mask_of_absent_column_and_unknown_level(spark):
    df = spark.range(1)
    assert mask_sensitive(df, [masked("pii")]) is df
    with_a = df.withColumn("a", F.lit(1))
    with pytest.raises(ValueError, match="unknown sensitivity level 'secret'"):
        mask_sensitive(with_a, [masked("secret")])
    assert mask_sensitive(with_a, [masked("secret")], on_unknown="keep") is with_a
