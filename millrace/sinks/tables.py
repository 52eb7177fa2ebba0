"""Curated rows in a catalog table: create, replace, upsert."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import RESERVED_PREFIX, Names, col, quoted, require
from ..functions.empties import stored, with_restored, with_stored
from ..functions.tags import DEFAULT_TAG, TAG_COLUMN
from ..operators.rows import with_domicile
from ..operators.upsert import source_keys, upsert_rows
from ..runtime import (
    child_names,
    delete,
    estimated_bytes,
    read_text,
    settings,
    sized_for,
    stored_bytes,
    write_text,
)
from ..spec import TableSpec
from .file_commit import FileCommit
from .layout import gathered

# Providers that store plain files and have no row-level MERGE.
FILE_PROVIDERS = ("parquet", "orc", "avro", "json", "csv")


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _is_files(table: TableSpec) -> bool:
    return table.provider.lower() in FILE_PROVIDERS


def namespace_name(table: TableSpec) -> str:
    return f"{quoted(table.catalog)}.{quoted(table.database)}"


def table_name(table: TableSpec) -> str:
    return f"{namespace_name(table)}.{quoted(table.table)}"


def columns_ddl(schema: T.StructType) -> str:
    """Column list of a CREATE TABLE; every column may hold NULLs."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]).toDDL()


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def create_table(spark: SparkSession, table: TableSpec, schema: T.StructType) -> None:
    """Create the namespace and the table unless they exist.

    The partitions of a table of plain files are what its folder holds, not a list of the
    catalog's, so that pointing the table at another folder is all it takes to replace it.
    """
    ensure_namespace(spark, namespace_name(table))
    parts = ", ".join(quoted(c) for c in table.partition_columns)
    with settings(spark, {"spark.sql.hive.manageFilesourcePartitions": "false"} if _is_files(table) else {}):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table_name(table)} ({columns_ddl(schema)}) "
            f"USING {table.provider}"
            + (f" PARTITIONED BY ({parts})" if parts else "")
            + (f" LOCATION {sql_text(table.location)}" if table.location else "")
        )


@dataclass(frozen=True)
class StoredTable:
    """What the catalog says of a table of plain files."""

    location: str
    partition_columns: list[str]
    managed: bool
    #: Whether the catalog lists partitions itself, rather than the folder telling.
    tracked: bool


def stored_table(spark: SparkSession, table: TableSpec) -> StoredTable:
    told = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(table)} AS JSON").collect()[0][0])
    return StoredTable(
        told["location"],
        told.get("partition_columns", []),
        told["type"] == "MANAGED",
        told.get("partition_provider") == "Catalog",
    )


def read_table(spark: SparkSession, table: TableSpec) -> DataFrame:
    """All rows. Partition values of plain files come back as they were published, also
    empty strings, which the files hold a stand-in for (see ``functions.empties``)."""
    rows = spark.table(table_name(table))
    return with_restored(rows, stored_table(spark, table).partition_columns) if _is_files(table) else rows


def replace_table(
    df: DataFrame, table: TableSpec, single_valued: bool = False, evolve: bool = False
) -> None:
    """Swap all rows of the table for ``df``, matched by name.

    Row-level providers do it in one commit. Plain files are written completely to a
    new folder, which the table is then pointed at; until then it is as it was. See
    ``matched`` for columns the table lacks.
    """
    spark = df.sparkSession
    rows = matched(df, table, evolve)
    if not _is_files(table):  # the provider arranges rows for its own layout
        rows.writeTo(table_name(table)).overwrite(F.lit(True))
        return
    held = stored_table(spark, table)
    _replace_files(rows if single_valued else gathered(rows, held.partition_columns), table, held)


def matched(df: DataFrame, table: TableSpec, evolve: bool = False) -> DataFrame:
    """``df`` with the table's columns, in its order.

    Columns the table lacks are an error that names them, or are added to the table
    first if ``evolve`` is set; rows written before then hold NULL there.
    """
    spark = df.sparkSession
    known = Names(spark.table(table_name(table)))
    extra = [f for f in df.schema if known.find(f.name) is None]
    if extra and not evolve:
        names = ", ".join(f.name for f in extra)
        raise ValueError(f"{table_name(table)} has no column {names}; nothing was written")
    if extra:
        spark.sql(f"ALTER TABLE {table_name(table)} ADD COLUMNS ({columns_ddl(T.StructType(extra))})")
    columns = spark.table(table_name(table)).columns
    return df.select(
        *[col(name).alias(c) for name, c in zip(require(df, columns, table_name(table)), columns)]
    )


def unknown_columns(df: DataFrame, table: TableSpec) -> list[str]:
    """Columns of ``df`` that an existing table lacks; none if there is no table."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table_name(table)):
        return []
    known = Names(spark.table(table_name(table)))
    return [c for c in df.columns if known.find(c) is None]


#: Ends of the folders that a table is pointed at in turn: a managed table's lie beside
#: the folder it was created with, which must be gone when the table is dropped; an
#: external table's lie within.
_VERSION = re.compile(r"(-v|/_versions/)[0-9a-f]{32}$")


def _replace_files(rows: DataFrame, table: TableSpec, held: StoredTable) -> None:
    """Write a new version of the table and point the table at it; no file is moved.

    A marker names both versions as long as both may be there. If the run stops, the next
    one finds it and deletes the version that the table is not pointed at.
    """
    spark, name = rows.sparkSession, table_name(table)
    finish_switch(spark, held)
    root = _root(held)
    new = f"{root}{'-v' if held.managed else '/_versions/'}{uuid.uuid4().hex}"
    write_text(spark, _marker(held), json.dumps({"new": new, "old": held.location}))
    parts = held.partition_columns
    try:
        with_stored(rows, parts).write.format(table.provider).partitionBy(*parts).save(new)
    except BaseException:
        delete(spark, new)
        delete(spark, _marker(held))
        raise
    spark.sql(f"ALTER TABLE {name} SET LOCATION {sql_text(new)}")
    finish_switch(spark, stored_table(spark, table))
    if held.tracked:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def _root(held: StoredTable) -> str:
    """The folder that the table was created with."""
    return _VERSION.sub("", held.location.rstrip("/"))


def _marker(held: StoredTable) -> str:
    return f"{_root(held)}{'-switch' if held.managed else '/_switch'}.json"


def finish_switch(spark: SparkSession, held: StoredTable) -> None:
    """Delete the version that the table is not pointed at, of a switch that is done or
    that stopped on its way."""
    folder, _, name = _marker(held).rpartition("/")
    if name not in child_names(spark, folder):
        return
    try:
        versions = json.loads(read_text(spark, _marker(held)))
    except ValueError:
        versions = {}  # stopped before anything was written
    version = lambda location: location.rstrip("/").rpartition("/")[2]
    for location in versions.values():
        if version(location) == version(held.location):
            continue
        if location.rstrip("/") == _root(held) and not held.managed:
            # the folder the table was created with also holds its versions
            for child in child_names(spark, location):
                if not child.startswith("_") or child == "_SUCCESS":
                    delete(spark, f"{location}/{child}")
        else:
            delete(spark, location)
    delete(spark, _marker(held))


def merge_into_table(
    source: DataFrame, table: TableSpec, keys: Sequence[str], evolve: bool = False
) -> None:
    """Upsert ``source`` by ``keys``: replace matched rows whole, insert the others.

    With a provider that has row-level operations this is its MERGE. Of plain files, only
    those that hold a matched row are rewritten; they are found by reading the key columns,
    in the partitions the batch touches when the partition columns are part of the key.
    The others keep their names and times. Until all new files are written the table is as
    it was, and a switch that stops on its way is finished by the next run (see
    ``file_commit``). See ``matched`` for columns the table lacks.

    ``source`` is read up to four times, so pass rows that were written somewhere.
    """
    spark = source.sparkSession
    source = matched(source, table, evolve)
    if not _is_files(table):
        incoming = source.alias("s")
        target = f"{quoted(table.table)}."
        on = reduce(
            lambda a, b: a & b,
            [F.col(target + quoted(k)) == F.col("s." + quoted(k)) for k in keys],
        )
        (
            incoming.mergeInto(table_name(table), on)
            .whenMatched()
            .updateAll()
            .whenNotMatched()
            .insertAll()
            .merge()
        )
        return

    held = stored_table(spark, table)
    commit = FileCommit(spark, held.location)
    finish_switch(spark, held)
    commit.recover()
    spark.catalog.refreshTable(table_name(table))
    target, parts = spark.table(table_name(table)), held.partition_columns
    source = _as_partitioned(source, target, parts)
    size = stored_bytes(spark, held.location)
    pruned, one_partition = target, not parts
    if parts and {p.lower() for p in parts} <= {k.lower() for k in keys}:
        pruned, one_partition = _touched(target, source, parts)
        size = min(estimated_bytes(pruned) or size, size)
    with sized_for(spark, source, stored=size):
        files = _files_with(pruned, source, keys)
    # Spark looks at none of the other files: their names are tested when it lists them.
    listed = ", ".join(sql_text(f) for f in files)
    rows = _in_files(target, listed) if files else target.filter(F.lit(False))
    with sized_for(spark, source, rows):
        merged = upsert_rows(rows, source, keys)
        laid_out = merged if one_partition else gathered(merged, parts)
        write = lambda folder: laid_out.write.format(table.provider).partitionBy(*parts).save(folder)
        commit.publish(write, [_below(held.location, f) for f in files])
    if held.tracked:
        spark.sql(f"MSCK REPAIR TABLE {table_name(table)} ADD PARTITIONS")
    spark.catalog.refreshTable(table_name(table))


def _as_partitioned(source: DataFrame, target: DataFrame, parts: list[str]) -> DataFrame:
    """``source`` with string partition columns as the table's files hold them."""
    texts = [p for p in parts if isinstance(target.schema[p].dataType, T.StringType)]
    return source.withColumns({p: stored(col(p).cast("string")) for p in texts}) if texts else source


def _file_of(df: DataFrame) -> Column:
    """The file a row was read from, also where the table has a column ``_metadata``."""
    return df.metadataColumn("_metadata")["file_path"]


def _files_with(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> list[str]:
    """Files that hold a row with the key of a source row. Reads key columns only; the
    list is no longer than Spark's own list of the table's files."""
    names, wanted = source_keys(target, source, keys)
    file = f"{RESERVED_PREFIX}file"
    held = target.select(*[col(k) for k in names], _file_of(target).alias(file))
    for k in names:
        held = held.filter(col(k).isNotNull())
    found = held.join(wanted, names, "left_semi").select(file).distinct()
    return sorted(r[0] for r in found.collect())


def _in_files(target: DataFrame, listed: str) -> DataFrame:
    file = f"{RESERVED_PREFIX}file"
    rows = target.select("*", _file_of(target).alias(file))
    return rows.filter(F.expr(f"{file} IN ({listed})")).drop(file)


def _below(location: str, file: str) -> str:
    """Path of a file below the table's folder; both may name scheme and host or not."""
    bare = lambda path: re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)
    path, root = bare(unquote(file)), bare(location).rstrip("/") + "/"
    if not path.startswith(root):
        raise ValueError(f"{file} is a file of the table, but not under {location}")
    return path.removeprefix(root)


def _touched(target: DataFrame, source: DataFrame, parts: list[str]) -> tuple[DataFrame, bool]:
    """Target rows in the partitions ``source`` has rows for; and: is it only one?

    The scan is pruned by the range of each partition column, one row however many
    partitions are touched, and then by a semi-join with the touched values, which
    Spark also turns into a runtime partition filter where they are few.
    """
    keys = [f"{RESERVED_PREFIX}part{i}" for i in range(len(parts))]
    stored = [target.schema[p].dataType for p in parts]
    values = source.select(
        *[col(p).cast(dtype).alias(k) for p, dtype, k in zip(parts, stored, keys)]
    ).distinct()
    ends = values.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(col(k)).alias(f"{k}_{f.__name__}") for k in keys for f in (F.min, F.max)],
        *[F.max(col(k).isNull()).alias(f"{k}_null") for k in keys],
    ).first()
    if not ends["n"]:
        return target.filter(F.lit(False)), True
    inside, same, chosen = [], [], []
    for p, k in zip(parts, keys):
        low, high, null = ends[f"{k}_min"], ends[f"{k}_max"], ends[f"{k}_null"]
        within = lambda c: F.lit(False) if low is None else (c >= F.lit(low)) & (c <= F.lit(high))  # noqa: B023, E731
        inside.append(within(col(p)) | col(p).isNull() if null else within(col(p)))
        chosen.append(within(col(k)) | col(k).isNull() if null else within(col(k)))
        same.append(col(p).eqNullSafe(col(k)) if null else col(p) == col(k))
    both = lambda tests: reduce(lambda a, b: a & b, tests)
    pruned = target.filter(both(inside))
    if ends["n"] == 1:
        return pruned, True
    return pruned.join(values.filter(both(chosen)), same, "left_semi"), False


def publish_table(
    df: DataFrame,
    table: TableSpec,
    full_load: bool,
    keys: Sequence[str] = (),
    domicile: str = DEFAULT_TAG,
    single_tag: bool = False,
    evolve: bool = False,
) -> None:
    """Create the table if needed, then replace it (full) or upsert into it.

    ``evolve``, or the table's own setting, adds columns that an existing table lacks.
    """
    evolve = evolve or table.evolve
    df = with_domicile(df, domicile)
    create_table(df.sparkSession, table, df.schema)
    if full_load:
        single = single_tag and table.partition_columns == (TAG_COLUMN,)
        replace_table(df, table, single, evolve)
    else:
        merge_into_table(df, table, keys, evolve)
