"""Publishing by reference: what readers see at each step, and what a stopped run leaves."""

from __future__ import annotations

import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace import sinks
from millrace.runtime import child_names, write_text
from millrace.sinks import file_commit, published, tables
from millrace.sinks.published import Dataset

from .test_sinks import AFTER, BATCH, ROWS, SCHEMA, bag, database, parquet_table, stored  # noqa: F401


class Stopped(BaseException):
    """The driver is gone: nothing that would tidy up runs."""


def stop(*args, **kwargs):
    raise Stopped


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def visible(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("*") if p.is_file() and ".crc" not in p.name)


# --- datasets ------------------------------------------------------------------


def test_old_rows_are_readable_until_the_switch(spark, folder, monkeypatch):
    dataset = Dataset(spark, folder)
    dataset.replace(spark.range(3))
    seen = []
    switch = published.write_text
    monkeypatch.setattr(published, "write_text", lambda *a: seen.append(ids(sinks.read_published(spark, folder))) or switch(*a))
    dataset.replace(spark.range(5), then=lambda part: seen.append(ids(sinks.read_published(spark, folder))))
    assert seen == [[0, 1, 2], [0, 1, 2, 3, 4]]


def test_a_reader_that_began_before_the_switch_sees_no_mixture(spark, folder):
    dataset = Dataset(spark, folder)
    dataset.replace(spark.range(3))
    planned = sinks.read_published(spark, folder)
    dataset.append(spark.range(5))
    assert ids(planned) == [0, 1, 2] and len(ids(sinks.read_published(spark, folder))) == 8


def test_no_file_is_moved(spark, folder):
    """What is listed after further runs are the files the first run wrote."""
    dataset = Dataset(spark, folder)
    part = dataset.append(spark.range(3))
    before = {p: (p.stat().st_ino, p.stat().st_mtime_ns) for p in Path(dataset.location(part)).rglob("*.parquet")}
    dataset.append(spark.range(2), key="k")
    dataset.append(spark.range(1), key="k")
    assert before == {p: (p.stat().st_ino, p.stat().st_mtime_ns) for p in Path(dataset.location(part)).rglob("*.parquet")}
    assert ids(dataset.read()) == [0, 0, 1, 2]


@pytest.mark.parametrize("mode", ["replace", "append"])
@pytest.mark.parametrize("step", ["write", "entry", "half an entry", "clear"])
def test_a_stop_after_each_step(spark, folder, monkeypatch, mode, step):
    """Readers see the old rows, or from the entry on the new ones; the next run succeeds
    and leaves nothing else behind."""
    dataset = Dataset(spark, folder)
    dataset.replace(spark.range(3))
    publish = lambda n: dataset.replace(spark.range(n)) if mode == "replace" else dataset.append(spark.range(n), key="run")
    if step == "write":
        with pytest.raises(Stopped):
            dataset._publish(spark.range(9), (), None, lambda p: True, None, write=lambda df, to: (df.write.parquet(to), stop()))
        spark.range(9).write.parquet(f"{folder}/_parts/__part=left")  # as if it had not been tidied up
    elif step == "entry":
        monkeypatch.setattr(published, "write_text", stop)
    elif step == "half an entry":
        monkeypatch.setattr(published, "write_text", lambda s, p, text: (write_text(s, p, text[:20]), stop()))
    else:
        monkeypatch.setattr(Dataset, "clear", stop)
    if step != "write":
        with pytest.raises(Stopped):
            publish(5)
    monkeypatch.undo()
    old, new = [0, 1, 2], [0, 1, 2, 3, 4] if mode == "replace" else [0, 0, 1, 1, 2, 2, 3, 4]
    assert ids(sinks.read_published(spark, folder)) == (new if step == "clear" else old)
    publish(2)
    assert ids(sinks.read_published(spark, folder)) == ([0, 1] if mode == "replace" else [0, 0, 1, 1, 2])
    assert len(child_names(spark, f"{folder}/_log")) == 1
    assert len(child_names(spark, f"{folder}/_parts")) == len(dataset.parts())


def test_a_write_that_fails_leaves_nothing(spark, folder):
    dataset = Dataset(spark, folder)
    dataset.replace(spark.range(3))
    before = visible(folder)
    bad = spark.range(50).select(F.when(F.col("id") == 49, F.raise_error(F.lit("injected"))).otherwise(F.col("id")).alias("id"))
    for publish in (dataset.replace, dataset.append):
        with pytest.raises(Exception, match="injected"):
            publish(bad)
    assert visible(folder) == before


def test_two_runs_at_a_time_are_noticed(spark, folder, monkeypatch):
    dataset = Dataset(spark, folder)
    dataset.replace(spark.range(1))
    other = lambda df, to: (df.write.parquet(to), Dataset(spark, folder).append(spark.range(2)))
    names = child_names(spark, f"{folder}/_log")
    monkeypatch.setattr(published, "child_names", lambda s, p: names if p.endswith("_log") else child_names(s, p))
    monkeypatch.setattr(Dataset, "clear", lambda self: None)
    with pytest.raises(Exception, match="already exists|AlreadyExists"):
        dataset.append(spark.range(3), write=other)


def test_plain_files_are_a_part_until_they_are_replaced(spark, folder):
    spark.createDataFrame(ROWS, SCHEMA).write.partitionBy("domicile").parquet(folder)
    dataset = Dataset(spark, folder)
    assert ids(sinks.read_published(spark, folder).na.drop()) == [1, 2, 3]
    dataset.append(spark.createDataFrame([(9, "z", "us")], SCHEMA), ["domicile"])
    assert ids(dataset.read().na.drop()) == [1, 2, 3, 9]
    dataset.replace(spark.createDataFrame([(8, "y", "eu")], SCHEMA), ["domicile"])
    assert bag(dataset.read()) == {(8, "y", "eu"): 1}
    assert [n for n in child_names(spark, folder) if not n.startswith("_")] == []


def test_columns_and_types_may_change_between_parts(spark, folder):
    dataset = Dataset(spark, folder)
    dataset.append(spark.createDataFrame([(1, "7", "x")], "id int, n string, OLD string"))
    dataset.append(spark.createDataFrame([(2, 8, 1.5)], "id int, n int, new double"))
    assert dataset.read().dtypes == [("id", "int"), ("n", "int"), ("new", "double"), ("OLD", "string")]
    assert bag(dataset.read()) == Counter([(1, 7, None, "x"), (2, 8, 1.5, None)])


def test_an_empty_dataset(spark, folder):
    assert Dataset(spark, folder).parts() == []
    assert sinks.read_published(spark, folder, spark.range(1).schema).count() == 0
    Dataset(spark, folder).replace(spark.createDataFrame([], SCHEMA), ["domicile"])
    assert sinks.read_published(spark, folder).count() == 0
    assert sinks.read_published(spark, folder).columns == ["id", "v", "domicile"]


# --- rejects by hour -----------------------------------------------------------


def test_all_hours_can_be_read_while_one_is_replaced(spark, folder):
    for hr in ("07", "08"):
        sinks.write_rejects_partition(spark.range(3), folder, "2024-03-05", hr)
    seen = []
    look = lambda: seen.append(bag(sinks.read_published(spark, folder).groupBy("hr").count()))
    rows = spark.range(1)
    dataset = Dataset(spark, folder)
    dataset.append(
        rows, ("dt", "hr"), key="2024-03-05/07", schema=dataset.schema(), then=lambda part: look(),
        write=lambda df, to: (df.write.parquet(f"{to}/dt=2024-03-05/hr=07"), look()),
    )
    assert seen == [{("07", 3): 1, ("08", 3): 1}, {("07", 1): 1, ("08", 3): 1}]


def test_hours_can_be_read_with_leftovers_present(spark, folder):
    sinks.write_rejects_partition(spark.range(3), folder, "2024-03-05", "07")
    spark.range(2).write.parquet(f"{folder}/_parts/__part=left/dt=2024-03-05/hr=07")
    write_text(spark, f"{folder}/_log/{2:020d}.json", '{"schemas"')
    assert bag(sinks.read_published(spark, folder).groupBy("dt", "hr").count()) == {("2024-03-05", "07", 3): 1}
    sinks.write_rejects_partition(spark.range(1), folder, "2024-03-05", "08")
    assert bag(sinks.read_published(spark, folder).groupBy("hr").count()) == {("07", 3): 1, ("08", 1): 1}


def test_a_reject_table_never_points_at_deleted_files(spark, folder, database, monkeypatch):  # noqa: F811
    name = sinks.publish_rejects(spark.range(3), folder, database, "r")
    monkeypatch.setattr(Dataset, "clear", lambda self: None)  # stops before the old ones are deleted
    sinks.publish_rejects(spark.range(2), folder, database, "r")
    monkeypatch.undo()
    assert ids(spark.table(name)) == [0, 1]
    Dataset(spark, folder).clear()
    spark.catalog.refreshTable(name)
    assert ids(spark.table(name)) == [0, 1]


# --- tables --------------------------------------------------------------------


@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("step", ["write", "marker", "switch", "delete"])
def test_a_replacement_that_stops(spark, database, folder, monkeypatch, external, step):  # noqa: F811
    table = parquet_table(database, "domicile")
    if external:
        table = tables.TableSpec("spark_catalog", database, "t", ("domicile",), "parquet", folder)
    sinks.publish_table(spark.createDataFrame(ROWS, SCHEMA), table, full_load=True)
    later = spark.createDataFrame([(7, "new", "us")], SCHEMA)
    sql, finish = type(spark).sql, tables.finish_switch
    if step == "marker":
        monkeypatch.setattr(tables, "write_text", lambda s, p, text: (write_text(s, p, text[:9]), stop()))
    elif step == "write":
        monkeypatch.setattr(tables, "delete", lambda *a: None)
        monkeypatch.setattr(tables, "with_stored", lambda df, parts: df.withColumn("v", F.raise_error(F.lit("gone")).cast("string")))
    elif step == "switch":
        monkeypatch.setattr(type(spark), "sql", lambda self, text, *a: stop() if "SET LOCATION" in text else sql(self, text, *a))
    else:
        calls = []
        monkeypatch.setattr(tables, "finish_switch", lambda *a: stop() if calls else calls.append(finish(*a)))
    with pytest.raises((Stopped, Exception)):
        sinks.replace_table(later, table)
    monkeypatch.undo()
    spark.catalog.refreshTable(sinks.table_name(table))
    assert bag(stored(spark, table)) == Counter([(7, "new", "us")] if step == "delete" else ROWS)
    sinks.replace_table(spark.createDataFrame(ROWS, SCHEMA), table)
    assert bag(stored(spark, table)) == Counter(ROWS)
    held = tables.stored_table(spark, table)
    root = Path(tables._root(held).removeprefix("file:"))
    beside = [p.name for p in (root / "_versions" if external else root.parent).iterdir() if "crc" not in p.name]
    assert beside == [held.location.rpartition("/")[2]]


def test_a_dropped_table_can_be_created_again(spark, database):  # noqa: F811
    table = parquet_table(database, "domicile")
    for rows in (ROWS, BATCH):
        sinks.publish_table(spark.createDataFrame(rows, SCHEMA), table, full_load=True)
        assert bag(stored(spark, table)) == Counter(rows)
        spark.sql(f"DROP TABLE {sinks.table_name(table)}")


@pytest.mark.parametrize("step", ["stage", "journal", "half a journal", "first move", "moves", "first delete", "deletes"])
@pytest.mark.parametrize("parts", [("domicile",), ()])
def test_an_upsert_that_stops_is_finished_or_forgotten(spark, database, monkeypatch, parts, step):  # noqa: F811
    table = parquet_table(database, *parts)
    sinks.publish_table(spark.createDataFrame(ROWS, SCHEMA), table, full_load=True)
    batch = spark.createDataFrame(BATCH, SCHEMA)
    commit, drop, calls = file_commit.FileCommit, file_commit.delete, []
    if step == "stage":
        monkeypatch.setattr(file_commit, "file_names", stop)
    elif step == "journal":
        monkeypatch.setattr(file_commit, "write_text", stop)
    elif step == "half a journal":
        monkeypatch.setattr(file_commit, "write_text", lambda s, p, text: (write_text(s, p, text[:30]), stop()))
    elif step == "first move":
        monkeypatch.setattr(commit, "_move_in", stop)
    elif step == "moves":
        monkeypatch.setattr(file_commit, "delete", stop)
    else:
        last = 1 if step == "first delete" else 2
        monkeypatch.setattr(file_commit, "delete", lambda *a: stop() if len(calls) >= last else calls.append(drop(*a)))
    with pytest.raises(Stopped):
        sinks.merge_into_table(batch, table, ["id", "domicile"])
    monkeypatch.undo()
    undecided = step in ("stage", "journal", "half a journal")
    # an empty batch changes nothing itself, but meets what the stopped run left
    sinks.merge_into_table(batch.filter("id < 0"), table, ["id", "domicile"])
    assert bag(stored(spark, table).select("id", "v", "domicile")) == Counter(ROWS if undecided else AFTER)
    location = tables.stored_table(spark, table).location
    assert [n for n in child_names(spark, location) if n.startswith("_merge")] == []


def test_the_journal_names_what_comes_and_goes(spark, database, monkeypatch):  # noqa: F811
    table = parquet_table(database, "domicile")
    sinks.publish_table(spark.createDataFrame(ROWS, SCHEMA), table, full_load=True)
    told = []
    monkeypatch.setattr(file_commit, "write_text", lambda s, p, text: (told.append(json.loads(text)), write_text(s, p, text)))
    sinks.merge_into_table(spark.createDataFrame(BATCH, SCHEMA), table, ["id", "domicile"])
    (change,) = told
    assert {n.partition("/")[0] for n in change["come"]} == {n.partition("/")[0] for n in change["go"]} == {"domicile=us"}
