"""File scans chosen by format name."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce
from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import RESERVED_PREFIX, col, quoted
from ..spec import ColumnSpec, DatasetSpec
from .drift import file_schemas, literal_path, wider

#: Text of a CSV line that did not fit its declared types.
MALFORMED = RESERVED_PREFIX + "malformed"
#: Formats whose files say themselves which columns they have.
MERGED_FORMATS = ("parquet", "orc")
_GLOB = re.compile(r"[*?\[{]")


def load_spec(spark: SparkSession, path: str) -> DatasetSpec:
    """Read one JSON specification from any file system Spark can reach."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise ValueError(f"{path}: empty specification")
    return DatasetSpec.from_dict(json.loads(text.value), name=PurePath(path).stem)


def read_source(
    spark: SparkSession,
    path: str,
    file_format: str,
    columns: Sequence[ColumnSpec] = (),
    csv_types: str = "declared",
    keep_malformed: bool = False,
) -> DataFrame:
    """Scan a file or folder in any format Spark has a reader for.

    Files need not agree: a column that some lack is NULL there, and one that has
    different types has the wider one if all are numbers, and is text otherwise. Parquet
    and ORC files are united by their footers, read as tasks.

    CSV has a header line. Declared columns have their declared source types, whatever
    else the header holds; only columns that are not declared have their types inferred,
    which reads all files once more. ``csv_types="infer"`` infers all. Where a folder has
    several files, their headers are looked up by a scan of their first blocks; files are
    read together with those of the same header. Text that does not fit a declared type is
    read as NULL; ``keep_malformed`` adds a column that holds the whole line for such rows.
    """
    kind = file_format.lower()
    if kind in MERGED_FORMATS:
        return _read_merged(spark, path, file_format)
    reader = spark.read.format(file_format)
    if kind != "csv":
        return reader.load(path)
    declared = {c.source.lower(): c.source_type for c in columns} if csv_types == "declared" else {}
    groups = _header_groups(spark, path)
    readers = [_csv_reader(spark, path, files) for files in groups]
    schemas = _agreed([_csv_schema(load, declared, bool(columns)) for load in readers], declared)
    frames = []
    for load, fields in zip(readers, schemas):
        schema = ", ".join(f"{quoted(name)} {dtype}" for name, dtype in fields)
        options = {}
        if keep_malformed and declared:
            schema += f", {MALFORMED} string"
            options["columnNameOfCorruptRecord"] = MALFORMED
        frames.append(load(schema, **options))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# -- CSV ------------------------------------------------------------------------


def _header_groups(spark: SparkSession, path: str) -> list[list[str] | None]:
    """Files by their header, in the order of the first file's name; ``None`` for all files
    when they share one, or there is but one."""
    lines = spark.read.text(path)
    if len(lines._jdf.inputFiles()) < 2:
        return [None]
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    first = (
        lines.select(
            "value", file.alias("file"), start.alias("start"), F.monotonically_increasing_id().alias("row")
        )
        .filter((F.col("start") == 0) & (F.trim("value") != ""))
        .groupBy("file")
        .agg(F.min_by("value", "row").alias("header"))
    )
    # A path per file, which Spark's listing of the folder holds too.
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    found = sorted(r["files"] for r in groups.select("files").collect())
    return found if len(found) > 1 else [None]


def _csv_reader(spark: SparkSession, path: str, files: list[str] | None):
    """Loads some files of the folder, or all, with a schema or with inferred types."""

    def load(schema: str | None = None, only: int | None = None, **options) -> DataFrame:
        reader = spark.read.format("csv").options(header=True, enforceSchema=False, **options)
        if schema is not None:
            reader = reader.schema(schema)
        if files is None:
            return reader.load(path)
        if not _GLOB.search(path):
            reader = reader.option("basePath", path)
        return reader.load([literal_path(f) for f in files[:only]])

    return load


def _csv_schema(load, declared: dict[str, str], known: bool) -> list[tuple[str, str]]:
    """Types in header order: the declared ones, and inferred ones for the rest."""
    header = load(only=1).columns if known and declared else None
    if header is not None and all(name.lower() in declared for name in header):
        return [(name, declared[name.lower()]) for name in header]
    return [(name, declared.get(name.lower(), found)) for name, found in load(inferSchema=True).dtypes]


def _agreed(
    schemas: list[list[tuple[str, str]]], declared: dict[str, str]
) -> list[list[tuple[str, str]]]:
    """The schemas with one type per column: text where not all types are numbers, so that
    no value is changed by reading it as something else first."""
    types: dict[str, set[str]] = {}
    for fields in schemas:
        for name, dtype in fields:
            types.setdefault(name.lower(), set()).add(dtype)
    one = {
        name: declared.get(name) or (found.pop() if len(found) == 1 else wider(found))
        for name, found in types.items()
    }
    return [[(name, one[name.lower()]) for name, _ in fields] for fields in schemas]


# -- files with footers ---------------------------------------------------------


def _read_merged(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    """All files under the columns of all; one schema after another where types differ."""
    reader = spark.read.format(file_format).option("mergeSchema", True)
    try:
        return reader.load(path)
    except Exception as e:  # the reader's own error, whose class differs by format
        if "CANNOT_MERGE" not in str(e):
            raise
    frames = []
    for schema, files in file_schemas(spark, path, file_format):
        group = spark.read.format(file_format).schema(schema)
        if not _GLOB.search(path):
            group = group.option("basePath", path)
        frames.append(group.load([literal_path(f) for f in files]))
    types: dict[str, set[str]] = {}
    for df in frames:
        for name, dtype in df.dtypes:
            types.setdefault(name.lower(), set()).add(dtype)
    one = {name: next(iter(t)) if len(t) == 1 else wider(t) for name, t in types.items()}
    cast = [df.select(*[col(n).cast(one[n.lower()]).alias(n) for n in df.columns]) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def source_count(df: DataFrame) -> DataFrame:
    """One row ``(rows)``. A load does not call this: its counts ride on writes."""
    return df.agg(F.count(F.lit(1)).alias("rows"))
