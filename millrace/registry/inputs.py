"""Inputs the queries share: the tables, and dirty variants Spark derives from them."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import quoted
from ..functions.tags import TAG_COLUMN
from ..runtime import scratch_dir
from ..spec import ColumnSpec, TableSpec

#: Load moments, fixed so that results can be stated in SQL.
LOAD_TS = datetime(2024, 3, 5, 7, 30)
NEXT_LOAD_TS = datetime(2024, 3, 5, 8, 30)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def same(name: str, dtype: str, **rules) -> ColumnSpec:
    """A declared column that keeps its name and type."""
    return ColumnSpec(name, name, dtype, dtype, **rules)


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, with NULLs, bad values and blank tags put in by key arithmetic."""
    key = F.col("o_orderkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    tag = F.element_at(
        F.array(*[F.lit(t) for t in (None, "", "NULL", "none", "us", "EU")]),
        (key % 6 + 1).cast("int"),
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 97 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(key % 89 == 0, None)
        .when(key % 53 == 0, F.lit("bad"))
        .otherwise(status)
        .alias("o_orderstatus"),
        "o_totalprice",
        "o_orderdate",
        F.when(key % 61 == 0, None)
        .when(key % 41 == 0, F.lit("BAD"))
        .otherwise(priority)
        .alias("o_orderpriority"),
        tag.alias(TAG_COLUMN),
    )


#: The three rules of ``dirty_orders``, in order.
ORDER_RULES = (
    same("o_custkey", "bigint", nullable=False),
    same("o_orderstatus", "string", regex="^[FOP]$"),
    same("o_orderpriority", "string", regex="^[1-5]-"),
)


def _tagged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    tag = F.when(status == "F", "eu").when(status == "O", "us").otherwise("apac")
    return table(spark, sf_dir, "orders").withColumn(TAG_COLUMN, tag)


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an upsert meets: all finished orders, and others placed before 1999."""
    return _tagged_orders(spark, sf_dir).filter(
        "o_orderdate < TIMESTAMP_NTZ '1999-01-01' OR o_orderstatus = 'F'"
    )


def order_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What arrives: open and pending orders since 1998, at twice the price. With the
    history, which it overlaps for a year, it covers all orders."""
    return (
        _tagged_orders(spark, sf_dir)
        .filter("o_orderdate >= TIMESTAMP_NTZ '1998-01-01' AND o_orderstatus <> 'F'")
        .withColumn("o_totalprice", F.col("o_totalprice") * 2)
    )


def with_null_keys(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    return orders.withColumn("o_orderkey", F.when(key % 97 != 0, key))


def file_table(
    spark: SparkSession, name: str, partition_columns: tuple[str, ...] = (TAG_COLUMN,)
) -> TableSpec:
    """A Parquet table over a folder of its own, in a new database."""
    database = f"millrace_{uuid.uuid4().hex}"
    folder = scratch_dir(spark, database)
    spark.sql(f"CREATE DATABASE {quoted(database)} LOCATION '{folder}'")
    data = f"{scratch_dir(spark, name)}/data"
    return TableSpec("spark_catalog", database, name, partition_columns, "parquet", data)


def taken_from(
    spark: SparkSession, target: TableSpec, name: str | None = None, copied: bool = False
) -> DataFrame:
    """The rows of a table of ``file_table``'s database, read as files; the database is
    dropped, which leaves the files. With ``copied`` the rows are read through the table,
    whose partitions may lie anywhere, and copied first."""
    name = name or f"{quoted(target.database)}.{quoted(target.table)}"
    found = spark.table(name)
    if copied:
        location = scratch_dir(spark, target.table)
        found.write.parquet(location)
    else:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
        location = next(r["data_type"] for r in described if r["col_name"] == "Location")
    rows = spark.read.schema(found.schema).parquet(location)
    spark.sql(f"DROP DATABASE {quoted(target.database)} CASCADE")
    return rows
