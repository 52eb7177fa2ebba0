"""Files of one folder that differ in their columns."""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Footers looked up at a time, each by a small task.
AT_ONCE = 16
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_REPORT = "file string, column string, issue string, found string, expected string"


def literal_path(file: str) -> str:
    """A file's path as a reader takes it, from the encoded form of ``_metadata``."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(file))


def wider(types: Iterable[str]) -> str:
    """One type for values of several: a number if all are numbers, text otherwise."""
    types = set(types)
    if types <= set(_WHOLE):
        return max(types, key=_WHOLE.index)
    if types <= {*_WHOLE, "float", "double"}:
        return "double"
    numbers = [re.fullmatch(r"decimal\((\d+),(\d+)\)", t) for t in types - set(_WHOLE)]
    if all(numbers):
        scale = max(int(m[2]) for m in numbers)
        whole = max([int(m[1]) - int(m[2]) for m in numbers] + [19] * bool(types & set(_WHOLE)))
        if whole + scale <= 38:
            return f"decimal({whole + scale},{scale})"
    return "string"


def file_schemas(
    spark: SparkSession, path: str, file_format: str
) -> list[tuple[T.StructType, list[str]]]:
    """Distinct schemas of the files under a path, and the files that have each.

    Every footer is read by a task of its own; the driver holds a path per file, as Spark's
    listing of the folder does.
    """
    folder = spark.read.format(file_format).load(path)
    files = [r[0] for r in folder.select(F.col("_metadata.file_path")).distinct().collect()]
    look = lambda file: spark.read.format(file_format).load(literal_path(file)).schema
    with ThreadPoolExecutor(AT_ONCE) as pool:
        found = list(pool.map(look, files))
    alike: dict[str, list[str]] = {}
    for file, schema in sorted(zip(files, found), key=lambda pair: pair[0]):
        alike.setdefault(schema.json(), []).append(file)
    by_json = {schema.json(): schema for schema in found}
    return [(by_json[kind], some) for kind, some in alike.items()]


def schema_report_files(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    """How files differ from the columns they have together: a row per file and column that
    it lacks (``missing``) or has under another type (``type``), with the number of its
    ``rows``. Files that have all columns give no row, nor do empty ones."""
    schemas = file_schemas(spark, path, file_format)
    types: dict[str, set[str]] = {}
    spelled: dict[str, str] = {}
    for schema, _ in schemas:
        for field in schema:
            types.setdefault(field.name.lower(), set()).add(field.dataType.simpleString())
            known = spelled.get(field.name.lower(), field.name)
            spelled[field.name.lower()] = max(known, field.name)  # whatever file comes first
    united = {name: next(iter(t)) if len(t) == 1 else wider(t) for name, t in types.items()}
    lines = []
    for schema, files in schemas:
        own = {f.name.lower(): f.dataType.simpleString() for f in schema}
        for name, expected in united.items():
            if own.get(name) != expected:
                issue = "type" if name in own else "missing"
                lines += [(file, spelled[name], issue, own.get(name), expected) for file in files]
    drift = spark.createDataFrame(lines, _REPORT)
    counts = [_rows_per_file(spark, schema, files, file_format) for schema, files in schemas]
    if not counts:
        return drift.withColumn("rows", F.lit(0).cast("long"))
    return drift.join(reduce(DataFrame.unionAll, counts), "file")


def _rows_per_file(
    spark: SparkSession, schema: T.StructType, files: list[str], file_format: str
) -> DataFrame:
    """Counts; no column is read for them."""
    rows = spark.read.format(file_format).schema(schema).load([literal_path(f) for f in files])
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
