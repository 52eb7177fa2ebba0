"""One query per operator. Each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads whole tables. Queries about writing write to new scratch folders
and return what is read back.
"""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from .. import sinks
from ..functions.rules import null_rule, regex_rule
from ..plans.load import LoadOptions, run_load
from ..runtime import scratch_dir
from ..sources.drift import schema_report_files
from ..sources.files import read_source, source_count
from ..spec import ColumnSpec, DatasetSpec
from .inputs import (
    LOAD_TS,
    NEXT_LOAD_TS,
    ORDER_RULES,
    dirty_orders,
    file_table,
    order_batch,
    order_history,
    same,
    table,
    taken_from,
    with_null_keys,
)

# --- scans ---------------------------------------------------------------------

CUSTOMER_COLUMNS = (
    same("c_custkey", "bigint"),
    same("c_name", "string"),
    same("c_nationkey", "int"),
    same("c_acctbal", "double"),
    same("c_mktsegment", "string"),
)


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, f"{sf_dir}/orders.parquet", "parquet")


def _rewritten(spark: SparkSession, sf_dir: str, name: str, file_format: str) -> str:
    path = scratch_dir(spark, f"{name}-{file_format}")
    table(spark, sf_dir, name).write.format(file_format).option("header", True).save(path)
    return path


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _rewritten(spark, sf_dir, "customer", "csv")
    return read_source(spark, path, "csv", CUSTOMER_COLUMNS)


def scan_csv_partly_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with leading zeros stays text though other columns are not declared."""
    path = scratch_dir(spark, "customer-csv")
    padded = F.lpad(F.col("c_nationkey").cast("string"), 4, "0")
    customers = table(spark, sf_dir, "customer").withColumn("c_nationkey", padded)
    customers.write.option("header", True).csv(path)
    declared = (same("c_custkey", "bigint"), same("c_nationkey", "string"))
    return read_source(spark, path, "csv", declared)


def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, _rewritten(spark, sf_dir, "customer", "csv"), "csv")


def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, _rewritten(spark, sf_dir, "customer", "json"), "json")


def scan_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, _rewritten(spark, sf_dir, "customer", "orc"), "orc")


def scan_csv_two_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the customers lack a column, and have the others in another order."""
    path = scratch_dir(spark, "customer-csv")
    customers = table(spark, sf_dir, "customer")
    narrow = customers.filter("c_custkey % 2 = 0").drop("c_nationkey")
    narrow = narrow.select(*reversed(narrow.columns))
    for rows in (customers.filter("c_custkey % 2 = 1"), narrow):
        rows.write.mode("append").option("header", True).csv(path)
    return read_source(spark, path, "csv", CUSTOMER_COLUMNS)


def _mixed_orders(spark: SparkSession, sf_dir: str) -> str:
    """Even orders lack the priority; odd ones have their customer as text."""
    path = scratch_dir(spark, "orders-mixed")
    orders = table(spark, sf_dir, "orders")
    odd = orders.filter("o_orderkey % 2 = 1").withColumn("o_custkey", F.col("o_custkey").cast("string"))
    for rows in (orders.filter("o_orderkey % 2 = 0").drop("o_orderpriority"), odd):
        rows.write.mode("append").parquet(path)
    return path


def scan_parquet_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, _mixed_orders(spark, sf_dir), "parquet")


def drift_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in files that lack a column, or have it under another type."""
    found = schema_report_files(spark, _mixed_orders(spark, sf_dir), "parquet")
    return found.groupBy("column", "issue", "found", "expected").agg(F.sum("rows").alias("rows"))


def count_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_count(table(spark, sf_dir, "orders"))


# --- projections and filters ---------------------------------------------------

BIG_FINISHED = "o_orderstatus = 'F' AND o_totalprice > 100000"


def filter_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.keep_where(table(spark, sf_dir, "orders"), BIG_FINISHED)


def rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two new names, and two columns that swap theirs."""
    columns = [
        ColumnSpec("o_orderkey", "order_id", "bigint", "bigint"),
        ColumnSpec("o_custkey", "customer_id", "bigint", "bigint"),
        ColumnSpec("o_orderstatus", "o_orderpriority", "string", "string"),
        ColumnSpec("o_orderpriority", "o_orderstatus", "string", "string"),
        ColumnSpec("o_absent", "absent", "string", "string"),
    ]
    return op.conform_columns(table(spark, sf_dir, "orders"), columns)


def cast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        ColumnSpec("l_extendedprice", "price", "double", "decimal(10,2)"),
        ColumnSpec("l_quantity", "l_quantity", "double", "int"),
        ColumnSpec("l_linenumber", "l_linenumber", "int", "string"),
        ColumnSpec("l_returnflag", "flag_number", "string", "int"),
        ColumnSpec("l_shipdate", "l_shipdate", "timestamp", "string"),
    ]
    return op.conform_columns(table(spark, sf_dir, "lineitem"), columns)


def domicile_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.with_domicile(table(spark, sf_dir, "orders"), "emea")


def domicile_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.with_domicile(dirty_orders(spark, sf_dir))


def domicile_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.normalize_domicile(dirty_orders(spark, sf_dir))


def mask_sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        same("c_name", "string", sensitivity="pii"),
        same("c_acctbal", "double", sensitivity="PHI"),
        same("c_mktsegment", "string", sensitivity="confidential"),
        same("c_nationkey", "int", sensitivity="none"),
    ]
    return op.mask_sensitive(table(spark, sf_dir, "customer"), columns)


# --- dedupe --------------------------------------------------------------------

LINE_KEY = ("l_orderkey", "l_linenumber")


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return op.latest_per_key(lines, LINE_KEY, ["l_shipdate"])


def dedupe_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order per customer; orders without a customer are one group."""
    orders = dirty_orders(spark, sf_dir)
    return op.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def dedupe_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.latest_per_key(table(spark, sf_dir, "lineitem"), [], ["l_shipdate"])


# --- quality -------------------------------------------------------------------


def dq_notnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_orders(spark, sf_dir).filter(null_rule("o_custkey").passed)


def dq_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_orders(spark, sf_dir).filter(regex_rule("o_orderstatus", "^[FOP]$").passed)


def dq_side(spark: SparkSession, sf_dir: str, mode: str, rejected: bool) -> DataFrame:
    return op.split(dirty_orders(spark, sf_dir), ORDER_RULES, mode)[rejected]


def dq_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = op.judge(dirty_orders(spark, sf_dir), ORDER_RULES)
    return _joined_reasons(op.rejected_rows(judged, reasons=True))


def _joined_reasons(rejected: DataFrame) -> DataFrame:
    return rejected.withColumn("dq_reasons", F.array_join("dq_reasons", ","))


def dq_rule_counts(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    return op.rule_counts(dirty_orders(spark, sf_dir), ORDER_RULES, mode)


def dq_summary(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    return op.split_summary(dirty_orders(spark, sf_dir), ORDER_RULES, mode)


def reject_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of two rules put together; the second sees what the first let through."""
    orders = dirty_orders(spark, sf_dir)
    first, second = null_rule("o_custkey"), regex_rule("o_orderstatus", "^[FOP]$")
    return orders.filter(first.failed).unionByName(
        orders.filter(first.passed).filter(second.failed)
    )


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        same("o_orderkey", "bigint"),
        ColumnSpec("o_custkey", "o_custkey", "bigint", "int"),
        ColumnSpec("o_orderstatus", "o_orderstatus", "string", "int"),
        ColumnSpec("o_totalprice", "o_totalprice", "double", "decimal(12,2)"),
        same("o_clerk", "string"),
    ]
    return op.schema_report(dirty_orders(spark, sf_dir), columns)


def rowcount_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = dirty_orders(spark, sf_dir)
    valid, _ = op.split(orders, ORDER_RULES)
    return op.reconcile(orders, valid)


# --- sinks ---------------------------------------------------------------------


def _staged(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    schema = op.stamp_load(rows, LOAD_TS).schema
    staged = sinks.read_published(spark, path, schema)
    return staged.withColumn("load_dt", F.col("load_dt").cast("string"))


def staging_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load replaces the hour staged before it."""
    path = scratch_dir(spark, "staging")
    orders = table(spark, sf_dir, "orders")
    sinks.write_staging(orders, path, full_load=True, load_ts=LOAD_TS)
    sinks.write_staging(orders, path, full_load=True, load_ts=NEXT_LOAD_TS)
    return _staged(spark, path, orders)


def staging_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "staging")
    orders = table(spark, sf_dir, "orders")
    sinks.write_staging(orders, path, full_load=True, load_ts=LOAD_TS)
    sinks.write_staging(orders, path, full_load=False, load_ts=NEXT_LOAD_TS)
    return _staged(spark, path, orders)


def curated_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "curated")
    orders = op.with_domicile(dirty_orders(spark, sf_dir))
    sinks.write_curated_files(op.with_domicile(table(spark, sf_dir, "orders")), path, True)
    schema = sinks.write_curated_files(orders, path, full_load=True)
    return sinks.read_published(spark, path, schema)


def curated_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows appended to themselves: nothing is matched, all stay twice."""
    path = scratch_dir(spark, "curated")
    orders = op.with_domicile(dirty_orders(spark, sf_dir))
    sinks.write_curated_files(orders, path, full_load=True)
    schema = sinks.write_curated_files(orders, path, full_load=False)
    return sinks.read_published(spark, path, schema)


def _merged(spark: SparkSession, history: DataFrame, batch: DataFrame) -> DataFrame:
    target = file_table(spark, "orders")
    sinks.publish_table(history, target, full_load=True)
    sinks.publish_table(batch, target, full_load=False, keys=["o_orderkey", "domicile"])
    return taken_from(spark, target)


def merge_whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert into a table partitioned by a column outside the key."""
    target = file_table(spark, "orders", ("o_orderpriority",))
    sinks.publish_table(order_history(spark, sf_dir), target, full_load=True)
    batch = order_batch(spark, sf_dir)
    sinks.publish_table(batch, target, full_load=False, keys=["o_orderkey", "domicile"])
    return taken_from(spark, target)


def curated_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, order_history(spark, sf_dir), order_batch(spark, sf_dir))


def merge_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, batch = order_history(spark, sf_dir), order_batch(spark, sf_dir)
    return _merged(spark, with_null_keys(history), with_null_keys(batch))


def upsert_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert as a plain DataFrame operator, keyed without the tag."""
    history, batch = order_history(spark, sf_dir), order_batch(spark, sf_dir)
    return op.upsert_rows(history, batch, ["o_orderkey"])


def table_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created from a schema, created again without effect, then filled by name."""
    customers = table(spark, sf_dir, "customer")
    target = file_table(spark, "customer", ("c_mktsegment",))
    sinks.create_table(spark, target, customers.schema)
    sinks.create_table(spark, target, customers.schema)
    sinks.replace_table(customers, target)
    return taken_from(spark, target)


def table_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column the table lacks is added; customers are upserted, half of them with it."""
    customers = table(spark, sf_dir, "customer").withColumn("domicile", F.lit("global"))
    target = file_table(spark, "customer", ("c_mktsegment",))
    sinks.publish_table(customers, target, full_load=True)
    wider = customers.filter("c_custkey % 2 = 0").withColumn("c_rich", F.col("c_acctbal") > 5000)
    keys = ["c_custkey", "c_mktsegment"]
    sinks.publish_table(wider, target, full_load=False, keys=keys, evolve=True)
    return taken_from(spark, target)


def table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replaced by the same rows with zero balances and columns in another order."""
    customers = table(spark, sf_dir, "customer")
    target = file_table(spark, "customer", ("c_mktsegment",))
    sinks.create_table(spark, target, customers.schema)
    sinks.replace_table(customers, target)
    zeroed = customers.withColumn("c_acctbal", F.lit(0.0))
    sinks.replace_table(zeroed.select(*reversed(customers.columns)), target)
    return taken_from(spark, target)


def _order_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rejected_rows(op.judge(dirty_orders(spark, sf_dir), ORDER_RULES), reasons=True)


def rejects_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "rejects")
    rejected = _order_rejects(spark, sf_dir)
    sinks.write_rejects(dirty_orders(spark, sf_dir), path)
    sinks.write_rejects(rejected, path)
    return _joined_reasons(sinks.read_published(spark, path, rejected.schema))


def rejects_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered twice: the second registration replaces the first."""
    path = scratch_dir(spark, "rejects")
    target = file_table(spark, "orders")
    for _ in range(2):
        rejected = _order_rejects(spark, sf_dir)
        name = sinks.publish_rejects(rejected, path, target.database, "orders_rejects")
    return _joined_reasons(taken_from(spark, target, name))


def _two_hours_of_rejects(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Hours 07 and 08, then 07 again: still one set per hour."""
    rejected = _order_rejects(spark, sf_dir)
    for hr in ("07", "08", "07"):
        sinks.write_rejects_partition(rejected, path, "2024-03-05", hr)
    return rejected


def rejects_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "rejects")
    rejected = _two_hours_of_rejects(spark, sf_dir, path)
    schema = rejected.withColumns({"dt": F.lit(""), "hr": F.lit("")}).schema
    return _joined_reasons(sinks.read_published(spark, path, schema))


def rejects_table_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "rejects")
    schema = _two_hours_of_rejects(spark, sf_dir, path).schema
    target = file_table(spark, "orders")
    for hr in ("07", "08", "07"):
        name = sinks.register_reject_partition(
            spark, target.database, "orders_rejects", path, schema, "2024-03-05", hr
        )
    return _joined_reasons(taken_from(spark, target, name, copied=True))


def audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit row per split mode, each with counts taken from all orders."""
    path = scratch_dir(spark, "audit")
    for mode, at in (("flag", LOAD_TS), ("cascade", NEXT_LOAD_TS)):
        n = op.split_summary(dirty_orders(spark, sf_dir), ORDER_RULES, mode).first()
        total = n.valid + n.reject + n.lost
        sinks.append_audit(
            spark, path, "orders", mode, total, n.valid, n.reject, "SUCCESS", at=at
        )
    return spark.read.parquet(path)


# --- loads ---------------------------------------------------------------------


def lineitem_spec(sf_dir: str) -> DatasetSpec:
    """Lines of ten pieces or more; the latest version of each; returned ones only."""
    return DatasetSpec(
        name="lineitem",
        source_path=f"{sf_dir}/lineitem.parquet",
        format="parquet",
        where="l_quantity >= 10",
        columns=(
            ColumnSpec("l_orderkey", "order_key", "bigint", "bigint", nullable=False),
            ColumnSpec("l_linenumber", "line_number", "int", "int"),
            ColumnSpec("l_extendedprice", "price", "double", "decimal(12,2)"),
            ColumnSpec("l_returnflag", "return_flag", "string", "string", regex="^[AR]$"),
        ),
        id_columns=("order_key", "line_number"),
        update_columns=("l_shipdate",),
    )


def _load(spark: SparkSession, spec: DatasetSpec, base: str, **options):
    return run_load(spark, spec, base, LoadOptions(load_ts=LOAD_TS, **options))


def full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _load(spark, lineitem_spec(sf_dir), scratch_dir(spark, "load"), full_load=True)
    return result.curated(spark)


def full_load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _load(spark, lineitem_spec(sf_dir), scratch_dir(spark, "load"), full_load=True)
    return _joined_reasons(result.rejects(spark))


def full_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _load(spark, lineitem_spec(sf_dir), scratch_dir(spark, "load"), full_load=True)
    return spark.read.parquet(result.paths.audit)


def full_load_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages over https, their text withheld; rules see what is masked afterwards."""
    spec = DatasetSpec(
        name="pages",
        source_path=f"{sf_dir}/pages.parquet",
        format="parquet",
        domicile="web",
        columns=(
            same("page_id", "bigint", nullable=False),
            same("url", "string", regex="^https://"),
            same("html", "string", regex="<[a-zA-Z!]", sensitivity="confidential"),
        ),
        id_columns=("url",),
        update_columns=("page_id",),
    )
    base = scratch_dir(spark, "load")
    return _load(spark, spec, base, full_load=True, mask=True).curated(spark)


def orders_spec(spark: SparkSession, rows: DataFrame, **changes) -> DatasetSpec:
    """Orders, written to a folder first, under the rules of ``ORDER_RULES``."""
    path = scratch_dir(spark, "source-orders")
    rows.write.parquet(path)
    spec = DatasetSpec("orders", path, "parquet", ORDER_RULES)
    return replace(spec, **changes)


def _cascade_load(spark: SparkSession, sf_dir: str):
    spec = orders_spec(spark, dirty_orders(spark, sf_dir), dq_mode="cascade")
    return _load(spark, spec, scratch_dir(spark, "load"), full_load=True)


def full_load_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops at a row's first failing rule; undecided rows are in neither output."""
    return _cascade_load(spark, sf_dir).curated(spark)


def full_load_cascade_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cascade_load(spark, sf_dir).rejects(spark).drop("dq_reasons")


def full_load_cascade_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_cascade_load(spark, sf_dir).paths.audit)


def full_load_own_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source columns named like the load stamp keep their values."""
    orders = table(spark, sf_dir, "orders").withColumns(
        {"load_dt": F.date_format("o_orderdate", "yyyy-MM-dd"), "load_hr": F.col("o_orderkey") % 24}
    )
    spec = orders_spec(spark, orders, columns=())
    return _load(spark, spec, scratch_dir(spark, "load"), full_load=True).curated(spark)


def full_load_rejects_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hour is run twice: the second run of one has fewer rejects, of one none."""
    spec, base = orders_spec(spark, dirty_orders(spark, sf_dir)), scratch_dir(spark, "load")
    passing = "o_custkey IS NOT NULL AND o_orderstatus RLIKE '^[FOP]$' AND o_orderpriority RLIKE '^[1-5]-'"
    for moment, where in (
        (LOAD_TS, ""), (LOAD_TS, "o_custkey IS NULL"), (NEXT_LOAD_TS, ""), (NEXT_LOAD_TS, passing),
    ):
        options = LoadOptions(full_load=True, load_ts=moment, rejects_by_hour=True)
        result = run_load(spark, replace(spec, where=where), base, options)
    return _joined_reasons(result.rejects(spark, all_hours=True))


#: Rows before this moment are the first load, the others the incremental batch.
CUT = "TIMESTAMP_NTZ '2000-01-01'"


def _two_loads(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    base = scratch_dir(spark, "load")
    _load(spark, replace(spec, where=f"l_shipdate < {CUT}"), base, full_load=True)
    later = replace(spec, where=f"l_shipdate >= {CUT}")
    return _load(spark, later, base, full_load=False).curated(spark)


def _plain_lineitem(sf_dir: str) -> DatasetSpec:
    return DatasetSpec(
        name="lineitem",
        source_path=f"{sf_dir}/lineitem.parquet",
        format="parquet",
        id_columns=LINE_KEY,
        update_columns=("l_shipdate",),
    )


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert into a table: the batch is newer, so all that remains is the latest."""
    target = file_table(spark, "lineitem")
    _two_loads(spark, replace(_plain_lineitem(sf_dir), table=target))
    return taken_from(spark, target)


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File output: the batch is deduped within itself and appended."""
    return _two_loads(spark, _plain_lineitem(sf_dir))


def incremental_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch is run twice under one load moment, and is there once, also in staging."""
    spec, base = _plain_lineitem(sf_dir), scratch_dir(spark, "load")
    _load(spark, replace(spec, where=f"l_shipdate < {CUT}"), base, full_load=True)
    later = replace(spec, where=f"l_shipdate >= {CUT}")
    for _ in range(2):
        result = run_load(spark, later, base, LoadOptions(load_ts=NEXT_LOAD_TS))
    staged = result.staged(spark).groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("staged"))
    return result.curated(spark).join(staged, list(LINE_KEY))


QUERIES = {
    "scan_parquet": scan_parquet,
    "scan_csv": scan_csv,
    "scan_csv_inferred": scan_csv_inferred,
    "scan_csv_partly_declared": scan_csv_partly_declared,
    "scan_json": scan_json,
    "scan_orc": scan_orc,
    "scan_csv_two_headers": scan_csv_two_headers,
    "scan_parquet_mixed": scan_parquet_mixed,
    "schema_report_files": drift_of_files,
    "source_count": count_source,
    "filter_sql": filter_sql,
    "rename": rename,
    "cast_types": cast_types,
    "domicile_add": domicile_add,
    "domicile_repair": domicile_repair,
    "domicile_normalize": domicile_normalize,
    "mask_sensitive": mask_sensitive,
    "dedupe_latest": dedupe_latest,
    "dedupe_null_key": dedupe_null_key,
    "dedupe_noop": dedupe_noop,
    "dq_notnull": dq_notnull,
    "dq_regex": dq_regex,
    "dq_cascade_valid": partial(dq_side, mode="cascade", rejected=False),
    "dq_cascade_reject": partial(dq_side, mode="cascade", rejected=True),
    "dq_flag_valid": partial(dq_side, mode="flag", rejected=False),
    "dq_flag_reject": partial(dq_side, mode="flag", rejected=True),
    "dq_reject_reasons": dq_reject_reasons,
    "dq_rule_counts": partial(dq_rule_counts, mode="cascade"),
    "dq_rule_counts_flag": partial(dq_rule_counts, mode="flag"),
    "dq_summary": partial(dq_summary, mode="flag"),
    "dq_summary_cascade": partial(dq_summary, mode="cascade"),
    "reject_union": reject_union,
    "schema_report": schema_report,
    "rowcount_reconcile": rowcount_reconcile,
    "staging_write": staging_write,
    "staging_append": staging_append,
    "curated_overwrite": curated_overwrite,
    "curated_append": curated_append,
    "curated_merge": curated_merge,
    "merge_null_key": merge_null_key,
    "merge_whole_table": merge_whole_table,
    "upsert_frames": upsert_frames,
    "table_create": table_create,
    "table_evolve": table_evolve,
    "table_replace": table_replace,
    "rejects_write": rejects_write,
    "rejects_table": rejects_table,
    "rejects_partitioned": rejects_partitioned,
    "rejects_table_partition": rejects_table_partition,
    "audit_append": audit_append,
    "full_load": full_load,
    "full_load_rejects": full_load_rejects,
    "full_load_audit": full_load_audit,
    "full_load_masked": full_load_masked,
    "full_load_cascade": full_load_cascade,
    "full_load_cascade_rejects": full_load_cascade_rejects,
    "full_load_cascade_audit": full_load_cascade_audit,
    "full_load_own_stamp": full_load_own_stamp,
    "full_load_rejects_by_hour": full_load_rejects_by_hour,
    "incremental_load": incremental_load,
    "incremental_append": incremental_append,
    "incremental_replay": incremental_replay,
}
