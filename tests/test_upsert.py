from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import upsert_rows

SCHEMA = "k int, tag string, v int"
keys = st.one_of(st.none(), st.integers(0, 4))
tags = st.sampled_from([None, "a", "b"])
target_rows = st.lists(st.tuples(keys, tags, st.integers(0, 3)), max_size=25)
source_rows = st.lists(st.tuples(keys, tags, st.integers(10, 13)), max_size=12)


def merge(target, source):
    """Row-by-row MERGE; None when a target row matches several source rows."""
    out = []
    for row in target:
        hits = [s for s in source if None not in row[:2] and s[:2] == row[:2]]
        if len(hits) > 1:
            return None
        if not hits:
            out.append(row)
    return Counter(out + source)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(target_rows, source_rows)
def test_against_brute_force(spark, target, source):
    merged = upsert_rows(
        spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA), ["k", "tag"]
    )
    expected = merge(target, source)
    if expected is None:
        with pytest.raises(Exception, match="several source rows match one target row"):
            merged.collect()
    else:
        assert Counter(map(tuple, merged.collect())) == expected


def test_columns_are_matched_by_name_and_cast_to_the_target(spark):
    target = spark.createDataFrame([(1, 10)], "k bigint, v bigint")
    source = spark.createDataFrame([(20, 1)], "V int, K int")
    merged = upsert_rows(target, source, ["k"])
    assert merged.dtypes == target.dtypes
    assert [tuple(r) for r in merged.collect()] == [(1, 20)]


def test_same_batch_twice_is_the_same_as_once(spark):
    target = spark.range(10).withColumn("v", F.lit(0))
    batch = spark.range(5, 15).withColumn("v", F.lit(1))
    once = upsert_rows(target, batch, ["id"])
    twice = upsert_rows(once, batch, ["id"])
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()
    assert once.count() == 15


def test_absent_key(spark):
    with pytest.raises(ValueError, match="no such column: nope"):
        upsert_rows(spark.range(1), spark.range(1), ["nope"])


def test_column_types_that_cannot_be_hashed(spark):
    target = spark.range(3).withColumn("m", F.create_map(F.lit("a"), "id"))
    assert upsert_rows(target, target.filter("id = 1"), ["id"]).count() == 3
