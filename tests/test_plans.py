"""Shape of the plans: what is pushed down, shuffled, pruned and compiled."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from millrace import LoadOptions, run_load
from millrace.operators import judge, latest_per_key, reconcile, schema_report, split, upsert_rows
from millrace.registry.inputs import ORDER_RULES, dirty_orders, same
from millrace.registry.queries import lineitem_spec
from millrace.runtime import settings
from millrace.sinks import write_curated_files


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|Round|Single)", text))


LAZY = [
    "filter_sql", "rename", "cast_types", "domicile_add", "domicile_repair",
    "domicile_normalize", "mask_sensitive", "dedupe_latest", "dedupe_null_key", "dq_notnull",
    "dq_regex", "dq_cascade_valid", "dq_cascade_reject", "dq_flag_valid", "dq_flag_reject",
    "dq_reject_reasons", "dq_rule_counts", "dq_rule_counts_flag", "dq_summary", "reject_union",
    "schema_report", "rowcount_reconcile", "upsert_frames",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_no_forced_broadcast(spark, sf_dir, name):
    text = plan(driver.queries()[name](spark, sf_dir))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "InMemoryTableScan"):
        assert bad not in text


def test_dedupe_limits_before_its_only_shuffle(spark, sf_dir):
    text = plan(driver.queries()["dedupe_latest"](spark, sf_dir))
    assert text.count("WindowGroupLimit") == 2 and shuffles(text) == 1
    final, partial = text.index("Final"), text.index("Partial")
    assert final < text.index("Exchange hashpartitioning") < partial


def test_hot_key_sends_one_row_per_task(spark):
    """40,000 rows of one key in 8 tasks: 8 rows are shuffled."""
    df = spark.range(0, 40_000, 1, 8).select((F.col("id") % 1).alias("k"), "id")
    out = latest_per_key(df, ["k"], ["id"])
    out.collect()
    assert "rowCount=8\n" in formatted(out).replace(")", "\n")


def test_projections_and_filters_stay_in_one_scan_stage(spark, sf_dir):
    for name in ("rename", "cast_types", "domicile_repair", "dq_flag_valid"):
        assert shuffles(plan(driver.queries()[name](spark, sf_dir))) == 0


def test_filter_reaches_the_scan(spark, sf_dir):
    text = formatted(driver.queries()["filter_sql"](spark, sf_dir))
    assert "EqualTo(o_orderstatus,F)" in text and "GreaterThan(o_totalprice,100000.0)" in text


def test_not_null_rule_reaches_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    valid, _ = split(orders, [same("o_custkey", "bigint", nullable=False)])
    assert "PushedFilters: [IsNotNull(o_custkey)]" in formatted(valid)


def test_masked_columns_are_not_read(spark, sf_dir):
    text = formatted(driver.queries()["mask_sensitive"](spark, sf_dir))
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in text


def test_judging_compiles_into_the_scan_stage(spark, sf_dir):
    text = plan(judge(dirty_orders(spark, sf_dir), ORDER_RULES))
    projects = re.findall(r"(\S+) Project", text)
    assert projects and all(p.startswith("*(1)") for p in projects)


def test_reports_read_each_table_once_and_only_what_they_count(spark, sf_dir):
    orders = dirty_orders(spark, sf_dir)
    counted = schema_report(orders, [same("o_custkey", "bigint")])
    assert plan(counted).count("FileScan") == 1
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in formatted(counted)
    both = plan(reconcile(orders, orders))
    assert both.count("FileScan") == 2 and "Join" not in both


def test_upsert_reads_the_target_once_and_splits_a_hot_key(spark, sf_dir):
    """A third of the target on one key, joined by shuffle: AQE splits that key."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(8)
    key = F.col("l_orderkey")
    target = lines.withColumn("k", F.when(key % 3 == 0, 1).otherwise(key))
    source = latest_per_key(lines, ["l_orderkey"], ["l_shipdate"]).withColumn("k", key)
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    with settings(spark, values):
        merged = upsert_rows(target, source, ["k"])
        assert merged.count() > 0
        merged.collect()
        assert "SortMergeJoin(skew=true)" in plan(merged)


def test_null_keys_of_the_target_are_spread(spark):
    target = spark.range(20_000).select(F.lit(None).cast("int").alias("k"), "id")
    source = spark.createDataFrame([(1, 1)], "k int, id bigint")
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    with settings(spark, values):
        merged = upsert_rows(target, source, ["k"]).filter("k IS NULL")
        sizes = merged.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) < 2 * 20_000 / 8


def stages_from(spark, first: int) -> list:
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    none = jvm.java.util.ArrayList()
    quantiles = gateway.new_array(jvm.double, 0)
    store = spark._jsc.sc().statusStore()
    stages = store.stageList(none, False, False, quantiles, none)
    found = [stages.apply(i) for i in range(stages.size())]
    return [s for s in found if s.stageId() >= first]


@pytest.mark.parametrize("full_load", [True, False])
def test_a_load_reads_the_source_once(spark, sf_dir, folder, full_load):
    spec = lineitem_spec(sf_dir)
    source_rows = spark.read.parquet(spec.source_path).count()
    run_load(spark, spec, folder, LoadOptions(full_load=True))
    first = max(s.stageId() for s in stages_from(spark, 0)) + 1
    result = run_load(spark, spec, folder, LoadOptions(full_load=full_load))
    read = sum(s.inputRecords() for s in stages_from(spark, first))
    # source before the filter, staging copy, judged rows: each of them once
    assert read == source_rows + result.source + result.valid + result.rejected
    shuffled = [s for s in stages_from(spark, first) if s.shuffleWriteRecords() > 0]
    assert len(shuffled) == 1  # the dedupe


def test_a_tag_with_most_rows_is_written_by_many_tasks(spark, folder, tmp_path):
    """Nine rows in ten share a tag; gathering by tag still spreads them."""
    df = spark.range(0, 200_000, 1, 8).select(
        "id",
        F.xxhash64("id").alias("noise"),
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("t"), F.col("id") % 4))
        .otherwise("hot")
        .alias("domicile"),
    )
    values = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}
    with settings(spark, values):
        write_curated_files(df, folder, full_load=True)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in tmp_path.glob("out/_parts/*/domicile=*")}
    assert files.pop("domicile=hot") >= 4
    assert set(files.values()) == {1}
