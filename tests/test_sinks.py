from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace import TableSpec, sinks
from millrace.functions.columns import quoted
from millrace.runtime import settings, stored_bytes
from millrace.sinks import tables

HOUR_7, HOUR_8 = datetime(2024, 3, 5, 7), datetime(2024, 3, 5, 8)


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def parquet_table(database, *partition_columns):
    return TableSpec("spark_catalog", database, "t", partition_columns, "parquet")


def stored(spark, table):
    return spark.table(sinks.table_name(table))


# --- files ---------------------------------------------------------------------


def test_staging_history(spark, folder):
    df = spark.range(2)
    sinks.write_staging(df, folder, full_load=True, load_ts=HOUR_7)
    sinks.write_staging(df, folder, full_load=False, load_ts=HOUR_7)
    sinks.write_staging(df, folder, full_load=False, load_ts=HOUR_8)
    hours = sinks.read_published(spark, folder).groupBy("load_hr").count()
    assert bag(hours) == {(7, 4): 1, (8, 2): 1}
    sinks.write_staging(df, folder, full_load=True, load_ts=HOUR_8)
    assert sinks.read_published(spark, folder).count() == 2


def test_a_repeated_run_takes_its_own_place(spark, folder):
    for n, run in ((2, "a"), (3, "b"), (5, "a"), (7, None), (7, None)):
        sinks.write_staging(spark.range(n), folder, full_load=False, load_ts=HOUR_7, run=run)
    assert sinks.read_published(spark, folder).count() == 3 + 5 + 7 + 7


def test_curated_modes_and_partition_types(spark, folder):
    df = spark.createDataFrame([(1, "001"), (2, "us")], "id int, domicile string")
    schema = sinks.write_curated_files(df, folder, full_load=True)
    sinks.write_curated_files(df, folder, full_load=False)
    both = sinks.read_published(spark, folder, schema)
    assert both.schema["domicile"].dataType.simpleString() == "string"
    assert bag(both) == {(1, "001"): 2, (2, "us"): 2}
    sinks.write_curated_files(df.filter("id = 2"), folder, full_load=True)
    assert bag(sinks.read_published(spark, folder, schema)) == {(2, "us"): 1}


def test_curated_overwrite_ignores_the_sessions_overwrite_mode(spark, folder):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        one = spark.createDataFrame([(1, "a")], "id int, domicile string")
        schema = sinks.write_curated_files(one, folder, full_load=True)
        two = spark.createDataFrame([(2, "b")], "id int, domicile string")
        sinks.write_curated_files(two, folder, full_load=True)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert bag(sinks.read_published(spark, folder, schema)) == {(2, "b"): 1}


def test_curated_adds_the_tag(spark, folder):
    schema = sinks.write_curated_files(spark.range(1), folder, True, domicile="emea")
    assert bag(sinks.read_published(spark, folder, schema)) == {(0, "emea"): 1}


def test_partition_values_become_few_files(spark, folder, tmp_path):
    df = spark.range(0, 8000, 1, 8).select(
        "id", F.concat(F.lit("tag"), F.col("id") % 5).alias("domicile")
    )
    sinks.write_curated_files(df, folder, full_load=True)
    for part in range(5):
        assert len(list(tmp_path.glob(f"out/_parts/*/domicile=tag{part}/*.parquet"))) == 1


def test_rejects_are_cleared_by_a_run_without_any(spark, folder):
    df = spark.range(3)
    sinks.write_rejects(df, folder)
    sinks.write_rejects(df.filter("id < 0"), folder)
    assert sinks.read_published(spark, folder).count() == 0


def test_reject_hours(spark, folder):
    df = spark.range(3)
    for hr, rows in (("07", df), ("08", df), ("07", df.filter("id = 0"))):
        sinks.write_rejects_partition(rows, folder, "2024-03-05", hr)
    sinks.write_rejects_partition(df.filter("id < 0"), folder, "2024-03-05", "08")
    hours = sinks.read_published(spark, folder).groupBy("hr").count()
    assert bag(hours) == {("07", 1): 1}  # the second run of hour 08 had none
    with pytest.raises(ValueError, match="HR"):
        sinks.write_rejects_partition(df.withColumn("HR", F.lit(1)), folder, "2024-03-05", "07")


def test_reject_folders_are_escaped_as_spark_does(spark, folder, database):
    df = spark.range(2)
    sinks.write_rejects_partition(df, folder, "5:3/24", "7=a b")
    name = sinks.register_reject_partition(spark, database, "r", folder, df.schema, "5:3/24", "7=a b")
    assert bag(spark.table(name)) == {(0, "5:3/24", "7=a b"): 1, (1, "5:3/24", "7=a b"): 1}


def test_audit_grows(spark, folder):
    for status in ("SUCCESS", "FAILED"):
        sinks.append_audit(spark, folder, "d", "dev", 3, None, 1, status, at=HOUR_7)
    row = ("d", "dev", "2024-03-05T07:00:00", 3, None, 1)
    assert bag(spark.read.parquet(folder)) == {(*row, "SUCCESS"): 1, (*row, "FAILED"): 1}


# --- reject tables -------------------------------------------------------------


def test_reject_table_follows_the_files(spark, folder, database):
    df = spark.createDataFrame([(1, ["a:null"])], "`a b` int, dq_reasons array<string>")
    sinks.write_rejects(df, folder)
    name = sinks.register_rejects(spark, database, "r", folder, df.schema)
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, ["a:null"])]
    wider = df.withColumn("c", F.lit(2))
    sinks.write_rejects(wider, folder)
    sinks.register_rejects(spark, database, "r", folder, wider.schema)
    assert spark.table(name).columns == ["a b", "dq_reasons", "c"]


def test_reject_table_is_created_with_its_database(spark, folder):
    name = f"db_{uuid.uuid4().hex}"
    sinks.write_rejects(spark.range(1), folder)
    sinks.register_rejects(spark, name, "r", folder, spark.range(1).schema)
    assert spark.table(f"{name}.r").count() == 1
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_first_reject_partition_is_visible(spark, folder, database):
    df = spark.range(2)
    sinks.write_rejects_partition(df, folder, "2024-03-05", "07")
    args = (spark, database, "r", folder, df.schema, "2024-03-05", "07")
    name = sinks.register_reject_partition(*args)
    assert spark.table(name).count() == 2
    sinks.write_rejects_partition(df.filter("id = 0"), folder, "2024-03-05", "07")
    sinks.register_reject_partition(*args)
    assert [tuple(r) for r in spark.table(name).collect()] == [(0, "2024-03-05", "07")]


# --- curated tables ------------------------------------------------------------

ROWS = [(1, "a", "us"), (2, "b", "us"), (3, "c", "eu"), (None, "n", "eu")]
BATCH = [(2, "B", "us"), (4, "D", "us"), (None, "N", "us")]
AFTER = [(1, "a", "us"), (3, "c", "eu"), (None, "n", "eu"), *BATCH]
SCHEMA = "id int, v string, domicile string"


def test_table_is_replaced_whole(spark, database):
    table = parquet_table(database, "domicile")
    df = spark.createDataFrame(ROWS, SCHEMA)
    sinks.publish_table(df, table, full_load=True)
    assert bag(stored(spark, table)) == Counter(ROWS)
    sinks.publish_table(df.filter("id = 3"), table, full_load=True)
    assert bag(stored(spark, table)) == {(3, "c", "eu"): 1}


@pytest.mark.parametrize("partition_columns", [("domicile",), ("domicile", "id"), ("v",), ()])
def test_table_merge(spark, database, partition_columns):
    """Partitioned inside the key: touched partitions only. Otherwise: rewritten."""
    table = parquet_table(database, *partition_columns)
    sinks.publish_table(spark.createDataFrame(ROWS, SCHEMA), table, full_load=True)
    batch = spark.createDataFrame(BATCH, SCHEMA)
    sinks.publish_table(batch, table, full_load=False, keys=["id", "domicile"])
    rows = stored(spark, table).select("id", "v", "domicile")
    assert bag(rows) == Counter(AFTER)
    sinks.publish_table(
        batch.filter("id IS NOT NULL"), table, full_load=False, keys=["id", "domicile"]
    )
    assert bag(stored(spark, table).select("id", "v", "domicile")) == Counter(AFTER)


@pytest.mark.parametrize("partition_columns", [("domicile",), ("domicile", "id")])
def test_table_merge_into_several_partitions(spark, database, partition_columns):
    table = parquet_table(database, *partition_columns)
    sinks.publish_table(spark.createDataFrame(ROWS, SCHEMA), table, full_load=True)
    batch = [*BATCH, (3, "C", "eu")]
    sinks.publish_table(
        spark.createDataFrame(batch, SCHEMA), table, full_load=False, keys=["id", "domicile"]
    )
    expected = Counter([*AFTER, (3, "C", "eu")])
    expected.subtract([(3, "c", "eu")])
    assert bag(stored(spark, table).select("id", "v", "domicile")) == +expected


def files_of(spark, table):
    """Name and time of every data file of a table."""
    location = tables.stored_table(spark, table).location.removeprefix("file:")
    found = Path(location).rglob("*.parquet")
    return {str(p.relative_to(location)): p.stat().st_mtime_ns for p in found if "/_" not in str(p.relative_to(location))}


def test_merge_leaves_other_partitions_alone(spark, database):
    table = parquet_table(database, "domicile")
    sinks.publish_table(spark.createDataFrame(ROWS, SCHEMA), table, full_load=True)
    before = files_of(spark, table)
    batch = spark.createDataFrame(BATCH, SCHEMA)
    sinks.publish_table(batch, table, full_load=False, keys=["id", "domicile"])
    after = files_of(spark, table)
    eu = lambda files: {f: t for f, t in files.items() if f.startswith("domicile=eu/")}
    assert eu(before) == eu(after) and before != after


@pytest.mark.parametrize("partition_columns", [("v",), ()])
def test_merge_rewrites_only_files_with_a_match(spark, database, partition_columns):
    """Twenty files of fifty keys each; the batch meets two of them."""
    table = parquet_table(database, *partition_columns)
    rows = spark.range(0, 1000, 1, 20).select(
        F.col("id").cast("int"), F.concat(F.lit("v"), F.floor(F.col("id") / 50)).alias("v"), F.lit("us").alias("domicile")
    )
    sinks.create_table(spark, table, rows.schema)
    sinks.replace_table(rows, table, single_valued=True)
    before = files_of(spark, table)
    batch = spark.createDataFrame([(3, "w", "us"), (777, "w", "us"), (5000, "w", "us"), (4, "w", "eu")], SCHEMA)
    sinks.merge_into_table(batch, table, ["id", "domicile"])
    after = files_of(spark, table)
    gone, new = set(before) - set(after), set(after) - set(before)
    assert len(before) == 20 and len(gone) == 2 and new
    assert all(after[f] == before[f] for f in set(before) - gone)
    found = bag(stored(spark, table).select("id", "v", "domicile"))
    expected = Counter((i, f"v{i // 50}", "us") for i in range(1000) if i not in (3, 777))
    assert found == expected + Counter(map(tuple, batch.collect()))


def test_merge_reads_matched_files_only(spark, database):
    table = parquet_table(database)
    rows = spark.range(0, 1000, 1, 20).select(F.col("id").cast("int"), F.lit("v").alias("v"), F.lit("us").alias("domicile"))
    sinks.create_table(spark, table, rows.schema)
    sinks.replace_table(rows, table)
    target = stored(spark, table)
    batch = spark.createDataFrame([(3, "w", "us"), (777, "w", "us")], SCHEMA)
    files = tables._files_with(target, batch, ["id"])
    assert len(files) == 2
    scan = tables._in_files(target, ", ".join(tables.sql_text(f) for f in files))
    assert len(scan.collect()) == 100
    leaf = scan._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert leaf.metrics().apply("numFiles").value() == 2


def test_names_and_folders_with_odd_characters(spark, tmp_path):
    """Paths come back from Spark encoded; folder names of partitions are escaped."""
    database = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/a b%20c/{database}'")
    table = parquet_table(database, "domicile")
    rows = [(1, "a", "x y/z"), (2, "b", "50%"), (3, "c", "é=1")]
    sinks.publish_table(spark.createDataFrame(rows, SCHEMA), table, full_load=True)
    batch = [(1, "A", "x y/z"), (2, "B", "50%"), (3, "C", "é=1"), (4, "D", "#")]
    for _ in range(2):
        sinks.publish_table(spark.createDataFrame(batch, SCHEMA), table, full_load=False, keys=["id", "domicile"])
    assert bag(stored(spark, table)) == Counter(batch)
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_a_table_that_lists_its_partitions_in_the_catalog(spark, database):
    """Made by someone else: replaced, merged into and replaced again."""
    table = parquet_table(database, "domicile")
    spark.sql(f"CREATE TABLE {sinks.table_name(table)} ({SCHEMA}) USING parquet PARTITIONED BY (domicile)")
    assert tables.stored_table(spark, table).tracked
    rows = spark.createDataFrame(ROWS, SCHEMA)
    sinks.publish_table(rows, table, full_load=True)
    sinks.publish_table(spark.createDataFrame(BATCH, SCHEMA), table, full_load=False, keys=["id", "domicile"])
    assert bag(stored(spark, table)) == Counter(AFTER)
    sinks.publish_table(rows.filter("id = 3"), table, full_load=True)
    assert bag(stored(spark, table)) == {(3, "c", "eu"): 1}


def test_empty_batch(spark, database):
    table = parquet_table(database, "domicile")
    sinks.publish_table(spark.createDataFrame(ROWS, SCHEMA), table, full_load=True)
    empty = spark.createDataFrame([], SCHEMA)
    sinks.publish_table(empty, table, full_load=False, keys=["id", "domicile"])
    assert bag(stored(spark, table)) == Counter(ROWS)


def test_failed_merge_changes_nothing(spark, database):
    table = parquet_table(database, "domicile")
    sinks.publish_table(spark.createDataFrame(ROWS, SCHEMA), table, full_load=True)
    twice = spark.createDataFrame([(2, "x", "us"), (2, "y", "us")], SCHEMA)
    with pytest.raises(Exception, match="several source rows match one target row"):
        sinks.publish_table(twice, table, full_load=False, keys=["id", "domicile"])
    assert bag(stored(spark, table)) == Counter(ROWS)


def test_names_that_need_quoting(spark, tmp_path):
    database = f"1_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {quoted(database)} LOCATION '{tmp_path}/q'")
    table = TableSpec("spark_catalog", database, "select", ("the tag",), "parquet")
    df = spark.createDataFrame([(1, "x")], "`a b` int, `the tag` string")
    sinks.create_table(spark, table, df.schema)
    sinks.replace_table(df, table)
    sinks.merge_into_table(df, table, ["a b", "the tag"])
    assert bag(stored(spark, table)) == {(1, "x"): 1}
    spark.sql(f"DROP DATABASE {quoted(database)} CASCADE")


def test_row_level_provider_uses_merge(spark, database):
    """Resolves as a MERGE; the Parquet table behind it then refuses the command."""
    table = parquet_table(database, "domicile")
    df = spark.createDataFrame(ROWS, SCHEMA)
    sinks.publish_table(df, table, full_load=True)
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        sinks.merge_into_table(df, replace(table, provider="iceberg"), ["id", "domicile"])


def test_file_table_at_a_location(spark, database, folder):
    table = replace(parquet_table(database, "domicile"), location=folder)
    sinks.publish_table(spark.createDataFrame(ROWS, SCHEMA), table, full_load=True)
    assert sinks.read_table(spark, table).count() == 4
    assert tables.stored_table(spark, table).location.rstrip("/").startswith(f"file:{folder}/")


def test_partition_values_are_compared_as_stored(spark, database):
    table = parquet_table(database, "part")
    first = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "part int, id int, v string")
    sinks.create_table(spark, table, first.select("id", "v", "part").schema)
    sinks.replace_table(first, table)
    batch = spark.createDataFrame([("001", 1, "A"), ("003", 3, "C")], "part string, id int, v string")
    sinks.merge_into_table(batch, table, ["part", "id"])
    assert bag(stored(spark, table)) == Counter([(1, "A", 1), (2, "b", 2), (3, "C", 3)])


def test_more_than_a_thousand_partitions_are_pruned(spark, database):
    table = parquet_table(database, "part")
    rows = spark.range(0, 1_300).select("id", F.lit("v").alias("v"), (F.col("id") + 1).alias("part"))
    with settings(spark, {"spark.sql.shuffle.partitions": "4"}):
        sinks.create_table(spark, table, rows.schema)
        sinks.replace_table(rows, table)
        batch = rows.filter("part <= 1100").withColumn("v", F.lit("w"))
        touched, one = tables._touched(stored(spark, table), batch, ["part"])
        plan = touched._jdf.queryExecution().toString()
        assert not one and "PartitionFilters: [isnotnull(part" in plan
        assert touched.count() == 1_100
        sinks.merge_into_table(batch, table, ["id", "part"])
        assert bag(stored(spark, table).groupBy("v").count()) == {("v", 200): 1, ("w", 1_100): 1}


def test_upsert_is_sized_by_the_whole_table(spark, database, monkeypatch):
    """A partition stands for 64 bytes of the target here."""
    table = parquet_table(database)
    sinks.publish_table(spark.createDataFrame(ROWS, SCHEMA), table, full_load=True)
    seen = []
    monkeypatch.setattr("millrace.runtime.SHUFFLE_BYTES", 64)
    find = tables._files_with
    look = lambda *a: seen.append(int(spark.conf.get("spark.sql.shuffle.partitions"))) or find(*a)
    monkeypatch.setattr(tables, "_files_with", look)
    batch = spark.createDataFrame(BATCH, SCHEMA)
    size = stored_bytes(spark, tables.stored_table(spark, table).location)
    sinks.publish_table(batch, table, full_load=False, keys=["id", "domicile"])
    assert seen[0] * 64 >= size > 1_000


# --- writes that fail ----------------------------------------------------------


def failing(spark, schema):
    """Rows whose evaluation fails in a task, after some are written."""
    df = spark.createDataFrame([(i, "x", "us") for i in range(50)], schema)
    bad = F.when(F.col("id") == 49, F.raise_error(F.lit("injected"))).otherwise(F.col("v"))
    return df.withColumn("v", bad)


@pytest.mark.parametrize("partition_columns", [("domicile",), ("v",), ()])
@pytest.mark.parametrize("full_load", [True, False])
@pytest.mark.parametrize("single_tag", [True, False])
def test_failed_write_leaves_the_table(spark, database, partition_columns, full_load, single_tag):
    table = parquet_table(database, *partition_columns)
    sinks.publish_table(spark.createDataFrame(ROWS, SCHEMA), table, full_load=True)
    with pytest.raises(Exception, match="injected"):
        sinks.publish_table(
            failing(spark, SCHEMA), table, full_load, keys=["id", "domicile"], single_tag=single_tag
        )
    spark.catalog.refreshTable(sinks.table_name(table))
    assert bag(stored(spark, table).select("id", "v", "domicile")) == Counter(ROWS)


@pytest.mark.parametrize("single_tag", [True, False])
def test_failed_curated_write_leaves_the_files(spark, folder, single_tag):
    schema = sinks.write_curated_files(spark.createDataFrame(ROWS, SCHEMA), folder, full_load=True)
    with pytest.raises(Exception, match="injected"):
        sinks.write_curated_files(failing(spark, SCHEMA), folder, True, single_tag=single_tag)
    assert bag(sinks.read_published(spark, folder, schema)) == Counter(ROWS)


# --- columns -------------------------------------------------------------------


@pytest.mark.parametrize("full_load", [True, False])
def test_new_columns_are_refused_or_added(spark, database, full_load):
    table = parquet_table(database, "domicile")
    df = spark.createDataFrame(ROWS, SCHEMA)
    sinks.publish_table(df, table, full_load=True)
    wider = spark.createDataFrame(BATCH, SCHEMA).withColumn("extra", F.lit(7))
    keys = ["id", "domicile"]
    with pytest.raises(ValueError, match="extra"):
        sinks.publish_table(wider, table, full_load, keys)
    assert bag(stored(spark, table)) == Counter(ROWS)
    sinks.publish_table(wider, replace(table, evolve=True), full_load, keys)
    rows = bag(stored(spark, table).select("id", "v", "domicile", "extra"))
    old = [] if full_load else [r for r in AFTER if r not in BATCH]
    assert rows == Counter([(*r, 7) for r in BATCH] + [(*r, None) for r in old])


def test_keys_are_compared_as_spark_resolves_them(spark, database):
    table = parquet_table(database, "domicile")
    sinks.publish_table(spark.createDataFrame(ROWS, SCHEMA), table, full_load=True)
    batch = spark.createDataFrame(BATCH, SCHEMA)
    sinks.merge_into_table(batch, table, ["ID", "id", "DOMICILE", "domicile"])
    assert bag(stored(spark, table)) == Counter(AFTER)


def test_orc_table(spark, database):
    table = replace(parquet_table(database, "domicile"), provider="ORC")
    sinks.publish_table(spark.createDataFrame(ROWS, SCHEMA), table, full_load=True)
    batch = spark.createDataFrame(BATCH, SCHEMA)
    sinks.publish_table(batch, table, full_load=False, keys=["id", "domicile"])
    assert bag(stored(spark, table)) == Counter(AFTER)
