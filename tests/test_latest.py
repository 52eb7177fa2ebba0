from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import latest_per_key

SCHEMA = "k1 int, k2 string, u1 int, u2 int, x int"
small = st.one_of(st.none(), st.integers(0, 2))
records = st.lists(
    st.tuples(small, st.sampled_from([None, "a", "b"]), small, small, st.integers(0, 9)),
    min_size=1,
    max_size=40,
)


def descending(row):
    """Sort key that puts larger values first and NULLs last."""
    return tuple((v is not None, v if v is not None else 0) for v in row[2:])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(records)
def test_against_brute_force(spark, data):
    best = {}
    for row in data:
        key = row[:2]
        if key not in best or descending(row) > descending(best[key]):
            best[key] = row
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    out = latest_per_key(df, ["k1", "k2"], ["u1", "u2"])
    assert Counter(map(tuple, out.collect())) == Counter(best.values())


def test_null_recency_is_last_and_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (None, 1), (None, 2)], "k int, u int")
    out = latest_per_key(df, ["k"], ["u"])
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 5), (None, 2)]


@pytest.mark.parametrize("keys, recency", [([], ["id"]), (["id"], []), ([], [])])
def test_unchanged_without_keys_or_recency(spark, keys, recency):
    df = spark.range(3)
    assert latest_per_key(df, keys, recency) is df


def test_ties_do_not_depend_on_partitioning(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    keys = ["l_orderkey"]  # many lines per order share a ship date
    few = latest_per_key(lines.coalesce(1), keys, ["l_shipdate"])
    many = latest_per_key(lines.repartition(13), keys, ["l_shipdate"])
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()


def test_idempotent_and_one_row_per_key(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    once = latest_per_key(lines, ["l_partkey"], ["l_shipdate"])
    twice = latest_per_key(once, ["l_partkey"], ["l_shipdate"])
    assert once.groupBy("l_partkey").count().filter("count > 1").isEmpty()
    assert once.exceptAll(twice).isEmpty()


def test_columns_that_cannot_be_sorted_or_look_like_helpers(spark):
    df = spark.range(4).select(
        F.lit(1).alias("k"),
        "id",
        F.create_map(F.lit("a"), "id").alias("m"),
        F.col("id").alias("rn"),
        F.col("id").alias("a b"),
    )
    out = latest_per_key(df, ["k"], ["a b"])
    assert out.columns == df.columns
    assert out.first().rn == 3


def test_explicit_tie_break(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 1, 2)], "k int, u int, t int")
    assert latest_per_key(df, ["k"], ["u"], tie_break=["t"]).first().t == 2
    assert latest_per_key(df, ["k"], ["u"], tie_break=()).count() == 1


def test_unknown_columns(spark):
    with pytest.raises(ValueError, match="dedupe key: no such column: nope"):
        latest_per_key(spark.range(1), ["nope"], ["id"])


def test_hot_key(spark):
    """A third of all rows on one key, NULL keys on another third."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), "id"
    )
    out = latest_per_key(df.repartition(8), ["k"], ["id"])
    assert out.count() == 10_000 + 2
    assert out.filter("k = 0").first().id == 29_997
    assert out.filter("k IS NULL").first().id == 29_999
