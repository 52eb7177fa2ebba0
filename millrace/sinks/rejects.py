"""Rejected rows: files, and external tables to query them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.columns import quoted
from .published import Dataset
from .tables import columns_ddl, ensure_namespace, sql_text

RUN_COLUMNS = ("dt", "hr")


#: Characters that Spark writes as %XX in the folder names of partitions; fixed values.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(c) for c in range(1, 32)}


def write_rejects(df: DataFrame, path: str, then: Callable[[str], None] | None = None) -> None:
    """Replace the previous run's rejects, also by nothing when there are none now.

    ``then`` gets the folder of the new files before the old ones are deleted.
    """
    dataset = Dataset(df.sparkSession, path)
    dataset.replace(df, then=lambda part: then(dataset.location(part)) if then else None)


def write_rejects_partition(
    df: DataFrame, path: str, dt: str, hr: str, then: Callable[[str], None] | None = None
) -> None:
    """Replace the rejects of one hour, ``dt=…/hr=…``, also by nothing; other hours stay.

    The hour's folder always holds a file afterwards, so a table's partition can be there.
    """
    taken = [c for c in df.columns if c.lower() in RUN_COLUMNS]
    if taken:
        raise ValueError(f"rejects already have the column {', '.join(taken)}")
    dataset = Dataset(df.sparkSession, path)
    hour = T.StructType([T.StructField(c, T.StringType()) for c in RUN_COLUMNS])
    dataset.append(
        df,
        RUN_COLUMNS,
        key=hour_key(dt, hr),
        then=lambda part: then(hour_folder(dataset.location(part), dt, hr)) if then else None,
        write=lambda rows, folder: rows.write.parquet(hour_folder(folder, dt, hr)),
        schema=T.StructType([*df.schema, *hour]),
    )


def hour_key(dt: str, hr: str) -> str:
    """Under which the rejects of an hour are published."""
    return f"{dt}/{hr}"


def hour_folder(path: str, dt: str, hr: str) -> str:
    """Where Spark puts, and looks for, the files of one hour."""
    named = zip(RUN_COLUMNS, (dt, hr))
    escape = lambda text: "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text)
    return "/".join([path.rstrip("/"), *[f"{name}={escape(value)}" for name, value in named]])


def register_rejects(
    spark: SparkSession, database: str, table: str, location: str, schema: T.StructType
) -> str:
    """(Re)create an external table over reject files; returns its quoted name.

    ``location`` is where rejects were published, or a folder of plain files.
    """
    parts = Dataset(spark, location).parts()
    files = Dataset(spark, location).location(parts[-1]) if parts else location
    return _over_files(spark, database, table, files, schema)


def _over_files(
    spark: SparkSession, database: str, table: str, files: str, schema: T.StructType
) -> str:
    ensure_namespace(spark, quoted(database))
    name = f"{quoted(database)}.{quoted(table)}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns_ddl(schema)}) USING parquet LOCATION {sql_text(files)}"
    )
    return name


def register_reject_partition(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    schema: T.StructType,
    dt: str,
    hr: str,
) -> str:
    """Make one hour of rejects visible in the reject table; returns its quoted name.

    The table is created on first use. A partition that is already there is pointed at
    the hour's files of now, so re-running an hour is safe.
    """
    dataset = Dataset(spark, location)
    hour = [p for p in dataset.parts() if p.key == hour_key(dt, hr)]
    files = hour_folder(dataset.location(hour[0]) if hour else location, dt, hr)
    return _partition_over_files(spark, database, table, location, files, schema, dt, hr)


def _partition_over_files(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    files: str,
    schema: T.StructType,
    dt: str,
    hr: str,
) -> str:
    ensure_namespace(spark, quoted(database))
    name = f"{quoted(database)}.{quoted(table)}"
    fields = [f for f in schema.fields if f.name not in RUN_COLUMNS]
    columns = T.StructType([*fields, *[T.StructField(c, T.StringType()) for c in RUN_COLUMNS]])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl(columns)}) USING parquet "
        f"PARTITIONED BY ({', '.join(RUN_COLUMNS)}) LOCATION {sql_text(location)}"
    )
    hour = f"PARTITION (dt = {sql_text(dt)}, hr = {sql_text(hr)})"
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {hour} LOCATION {sql_text(files)}")
    spark.sql(f"ALTER TABLE {name} {hour} SET LOCATION {sql_text(files)}")
    spark.catalog.refreshTable(name)
    return name


def publish_rejects(
    df: DataFrame | None,
    location: str,
    database: str,
    table: str,
    dt: str | None = None,
    hr: str | None = None,
) -> str | None:
    """Write rejects and register their table; returns its quoted name.

    With ``dt`` and ``hr`` only that hour is replaced, otherwise the rejects of the last
    run; either also by none. The files replaced are deleted when the table no longer
    points at them.
    """
    if df is None:
        return None
    spark, schema = df.sparkSession, df.schema
    if dt is None or hr is None:
        write_rejects(df, location, lambda files: _over_files(spark, database, table, files, schema))
    else:
        register = lambda files: _partition_over_files(
            spark, database, table, location, files, schema, dt, hr
        )
        write_rejects_partition(df, location, dt, hr, register)
    return f"{quoted(database)}.{quoted(table)}"
