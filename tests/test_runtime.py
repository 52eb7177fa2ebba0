from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from millrace import runtime

TIB = 1 << 40


def test_small_inputs_keep_the_sessions_settings():
    assert runtime.scaled_settings(10 * runtime.MIB, 8, 128 * runtime.MIB, 64 * runtime.MIB) == {
        "spark.sql.shuffle.partitions": 8,
        "spark.sql.files.maxPartitionBytes": 128 * runtime.MIB,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": 64 * runtime.MIB,
    }


def test_a_terabyte_gets_more_partitions_of_the_same_splits():
    values = runtime.scaled_settings(TIB, 200, 128 * runtime.MIB, 64 * runtime.MIB)
    assert values["spark.sql.shuffle.partitions"] == 4096
    assert values["spark.sql.files.maxPartitionBytes"] == 128 * runtime.MIB


def test_a_hundred_terabytes_get_larger_tasks_instead_of_ever_more():
    values = runtime.scaled_settings(100 * TIB, 200, 128 * runtime.MIB, 64 * runtime.MIB)
    assert values["spark.sql.shuffle.partitions"] == runtime.MAX_TASKS
    assert 1 << 30 < values["spark.sql.files.maxPartitionBytes"] < 2 << 30
    assert values["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == 512 * runtime.MIB


def test_settings_are_put_back(spark):
    name, other = "spark.sql.shuffle.partitions", "spark.millrace.test"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), runtime.settings(spark, {name: 3, other: 1}):
        assert (spark.conf.get(name), spark.conf.get(other)) == ("3", "1")
        raise RuntimeError
    assert spark.conf.get(name) == before and spark.conf.get(other, None) is None


def test_threads_of_one_session_take_turns(spark):
    name, seen = "spark.millrace.turn", []

    def work(i):
        with runtime.settings(spark, {name: i}):
            time.sleep(0.02)
            seen.append(spark.conf.get(name) == str(i))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(work, range(8)))
    assert seen == [True] * 8 and spark.conf.get(name, None) is None


def test_sized_for_a_large_input(spark, sf_dir, monkeypatch):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert runtime.estimated_bytes(orders) > 100_000
    monkeypatch.setattr(runtime, "estimated_bytes", lambda df: TIB)
    with runtime.sized_for(spark, orders, orders):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8192"
        assert orders.distinct().count() == orders.count()
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_unknown_size(spark, tmp_path):
    spark.sql(f"CREATE TABLE no_stats (a int) USING parquet LOCATION '{tmp_path}/t'")
    assert runtime.estimated_bytes(spark.table("no_stats")) in range(0, 1 << 62)
    spark.sql("DROP TABLE no_stats")


@pytest.mark.parametrize("text, size", [("128", 128), ("64MB", 64 << 20), ("1g", 1 << 30), ("7b", 7)])
def test_byte_settings(spark, text, size):
    with runtime.settings(spark, {"spark.millrace.size": text}):
        assert runtime.in_bytes(spark, "spark.millrace.size") == size


def test_scratch_is_new_each_time_and_only_scratch_is_dropped(spark):
    one, two = runtime.scratch_dir(spark, "x"), runtime.scratch_dir(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.range(1).write.parquet(one)
    runtime.drop_scratch(spark, one)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(one)
    with pytest.raises(ValueError, match="not a scratch folder"):
        runtime.drop_scratch(spark, "/data/curated")
