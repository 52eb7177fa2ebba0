"""Empty strings and NULL in partition columns stay two values, and match as such."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace import sinks
from millrace.functions.empties import restored, stored as as_stored

from .test_sinks import bag, database, parquet_table, stored  # noqa: F401

SCHEMA = "id int, v string, domicile string"
FIRST = [(1, "a", ""), (2, "b", ""), (3, "c", None), (4, "d", "us"), (5, "e", "__empty__"), (6, "f", "___empty__")]


@pytest.mark.parametrize("batch, gone", [
    ([(1, "B", "")], [1]),
    ([(1, "B", ""), (9, "n", "us")], [1]),
    ([(1, "B", None)], []),  # NULL keys match nothing, as in MERGE
    ([(5, "B", "__empty__"), (6, "B", ""), (5, "C", "")], [5]),
])
@pytest.mark.parametrize("parts", [("domicile",), ("domicile", "v")])
def test_empty_values_match_themselves_only(spark, database, batch, gone, parts):  # noqa: F811
    table = parquet_table(database, *parts)
    sinks.create_table(spark, table, spark.createDataFrame(FIRST, SCHEMA).schema)
    sinks.replace_table(spark.createDataFrame(FIRST, SCHEMA), table)
    sinks.merge_into_table(spark.createDataFrame(batch, SCHEMA), table, ["id", "domicile"])
    expected = Counter([r for r in FIRST if r[0] not in gone] + batch)
    assert bag(sinks.read_table(spark, table).select("id", "v", "domicile")) == expected


def test_upserting_an_empty_value_again_leaves_one_row(spark, database):  # noqa: F811
    table = parquet_table(database, "domicile")
    for v in "abc":
        sinks.create_table(spark, table, spark.createDataFrame([], SCHEMA).schema)
        sinks.merge_into_table(spark.createDataFrame([(1, v, "")], SCHEMA), table, ["id", "domicile"])
    assert bag(sinks.read_table(spark, table)) == {(1, "c", ""): 1}


def test_empty_values_of_curated_files(spark, folder):
    sinks.write_curated_files(spark.createDataFrame(FIRST, SCHEMA), folder, full_load=True)
    assert bag(sinks.read_published(spark, folder)) == Counter(FIRST)


def test_the_stand_in_can_be_told_from_values_like_it(spark):
    values = ["", "_", "x", "__empty__", "___empty__", "____empty__", "_empty__", "__empty__\n", "a__empty__", None]
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", as_stored(F.col("v")).alias("s"))
    rows = df.select("v", "s", restored(F.col("s")).alias("r")).collect()
    assert [r["r"] for r in rows] == values
    assert len({r["s"] for r in rows}) == len(values) and "" not in {r["s"] for r in rows}
