"""``cast_sql`` must give exactly what ``try_cast`` gives, for any pair of types."""

from __future__ import annotations

import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions.casts import cast_sql, parsed, plausible_sql

TEXTS = [
    None, "", " ", "\t", "0", "1", "-1", "+7", " 42 ", "\t42\n", "\x0042", "\x7f42", "1e2", "9.7",
    ".5", "-.5", "1.", "+", "-", ".", "abc", "N/A", "nan", "NaN", "inf", "-inf", "+Infinity",
    "Infinity", "INF", "0x1F", "1f", "1d", "t", "TRUE", " yes", "y", "no", "F", "false", "on",
    "127", "128", "-128", "-129", "32768", "2147483647", "2147483648", "-2147483648",
    "-2147483649", "9223372036854775807", "9223372036854775808", "99999.99", "99999.995",
    "100000", "1e400", "٣", "１２", "−5", "~1", ":1", "é", "2024-01-31", "2024-02-30",
]
INTEGERS = [0, 1, -1]
for bits in (7, 15, 31, 63):
    INTEGERS += [2**bits - 1, -(2**bits), *([2**bits, -(2**bits) - 1] if bits < 63 else [])]
for digits in (3, 5):
    INTEGERS += [10**digits - 1, 10**digits, -(10**digits)]
DOUBLES = [None, float("nan"), float("inf"), float("-inf"), 0.5, -0.5, 1e300, 99999.994, 99999.996]
DOUBLES += [float(i) for i in INTEGERS] + [i + 0.5 for i in INTEGERS]
DECIMALS = [Decimal(i) / 2 for i in INTEGERS if abs(i) < 10**18]

TARGETS = [
    "tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "string",
    "decimal(7,2)", "decimal(5,0)", "decimal(38,18)", "date", "timestamp_ntz",
]
SOURCES = {
    "string": TEXTS,
    "bigint": [None, *INTEGERS],
    "int": [None, *[i for i in INTEGERS if -(2**31) <= i < 2**31]],
    "double": DOUBLES,
    "float": [d for d in DOUBLES if d is None or abs(d) < 1e38 or d != d],
    "decimal(20,1)": [None, *DECIMALS],
    "boolean": [None, True, False],
}


@pytest.mark.parametrize("source", SOURCES)
def test_same_as_try_cast(spark, source):
    df = spark.createDataFrame([(v,) for v in SOURCES[source]], f"v {source}")
    kind = df.schema["v"].dataType
    for target in TARGETS:
        if target in ("date", "timestamp_ntz") and source != "string":
            continue
        ours = F.expr(cast_sql("v", kind, target))
        different = df.filter(~ours.eqNullSafe(F.col("v").try_cast(target)))
        assert [r.v for r in different.collect()] == [], (source, target)


@pytest.mark.parametrize("source, target", [("int", "bigint"), ("int", "double"), ("date", "int")])
def test_no_test_where_nothing_is_gained(source, target):
    assert plausible_sql("v", parsed(source), parsed(target)) is None


def test_a_column_that_does_not_fit_is_not_slow(spark):
    """200,000 words read as numbers; by exceptions alone this takes seconds."""
    df = spark.range(0, 200_000, 1, 1).select(F.concat(F.lit("N"), "id").alias("v"))
    bad = df.select(F.expr(cast_sql("v", df.schema["v"].dataType, "int")).alias("n"))
    bad.agg(F.count("n")).collect()
    start = time.perf_counter()
    assert bad.agg(F.count("n")).first()[0] == 0
    assert time.perf_counter() - start < 1.0
