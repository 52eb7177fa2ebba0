"""Files published by reference.

The rows of a dataset lie in parts, each a folder of its own, written once and never moved
or changed. Which parts make up the dataset is said by the last entry of a log of small
files; whoever reads follows it. To publish is to write a part, completely, and then an
entry that lists it. So a switch moves no bytes, whatever the store; readers see all of
the old rows or all of the new ones; and a run that stops anywhere leaves the rows that
the last entry lists, as well as folders that no entry lists, which the next run deletes.

    <path>/_parts/__part=<id>/…    rows, partitioned as the writer was told
    <path>/_log/<number>.json      the parts, their keys, columns and partition columns

A part may have a key: publishing another part under the key replaces it in the same
entry, so a run that appends under its own key can be repeated. Files that lie in the
folder itself, from before it was published to, count as a part.

One run at a time publishes to a dataset. Two that try get the same number for their
entries, and the later one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import RESERVED_PREFIX, Names, col
from ..functions.empties import with_restored, with_stored
from ..runtime import child_names, delete, file_system, read_text, write_text

PARTS, LOG = "_parts", "_log"
_PART_COLUMN = f"{RESERVED_PREFIX}part"


@dataclass(frozen=True)
class Part:
    """``folder`` is a name under the dataset's parts, or empty for files that lie in the
    dataset's own folder; their columns are not known."""

    folder: str
    key: str | None = None
    schema: T.StructType | None = None
    partition_by: tuple[str, ...] = ()


class Dataset:
    """The rows published under ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # -- reading ----------------------------------------------------------------

    def _last_entry(self) -> tuple[str | None, dict]:
        """Name and content of the last complete entry of the log."""
        for name in reversed(child_names(self.spark, f"{self.path}/{LOG}")):
            try:
                return name, json.loads(read_text(self.spark, f"{self.path}/{LOG}/{name}"))
            except ValueError:
                continue  # its writer stopped before it was complete
        return None, {}

    def parts(self) -> list[Part]:
        """What the dataset is made of now."""
        name, entry = self._last_entry()
        if name is None:
            plain = any(not n.startswith(("_", ".")) for n in child_names(self.spark, self.path))
            return [Part("")] if plain else []
        kinds = [T.StructType.fromJson(k) if k else None for k in entry["schemas"]]
        return [Part(p["folder"], p["key"], kinds[p["schema"]], tuple(p["partition_by"])) for p in entry["parts"]]

    def location(self, part: Part) -> str:
        return f"{self.path}/{PARTS}/{_PART_COLUMN}={part.folder}" if part.folder else self.path

    def schema(self) -> T.StructType:
        """Columns of the newest part, then those that only earlier ones have."""
        fields: list[T.StructField] = []
        for part in reversed(self.parts()):
            known = Names(self.spark.createDataFrame([], T.StructType(fields)))
            kind = part.schema or self.spark.read.parquet(self.path).schema
            fields += [f for f in kind if known.find(f.name) is None]
        return T.StructType(fields)

    def read(self, schema: T.StructType | None = None, parts: Sequence[Part] | None = None) -> DataFrame:
        """All rows, or those of some parts, with the columns of ``schema``.

        Parts that lack a column hold NULL there, and values of a column that had another
        type are cast, to NULL where they do not fit. Partition values come back as they
        were given to the writer.
        """
        parts = self.parts() if parts is None else parts
        schema = schema or self.schema()
        alike: dict[tuple, list[Part]] = {}
        for part in parts:
            kind = part.schema.json() if part.schema else ""
            alike.setdefault((part.folder == "", kind, part.partition_by), []).append(part)
        frames = [self._rows(some, schema) for some in alike.values()]
        if not frames:
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionAll, frames)

    def _rows(self, parts: list[Part], schema: T.StructType) -> DataFrame:
        reader = self.spark.read.schema(parts[0].schema or schema)
        if parts[0].folder:
            reader = reader.option("basePath", f"{self.path}/{PARTS}")
        df = with_restored(reader.parquet(*map(self.location, parts)), parts[0].partition_by)
        names = Names(df)
        return df.select(*[_as_field(df, names.find(f.name), f) for f in schema])

    # -- publishing -------------------------------------------------------------

    def replace(self, df: DataFrame, partition_by: Sequence[str] = (), then: Callable[[Part], None] | None = None) -> Part:
        """Let the rows of ``df`` take the place of all rows."""
        return self._publish(df, partition_by, None, lambda part: False, then)

    def append(
        self,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        key: str | None = None,
        then: Callable[[Part], None] | None = None,
        write: Callable[[DataFrame, str], None] | None = None,
        schema: T.StructType | None = None,
    ) -> Part:
        """Add the rows of ``df``; with a key, in place of those added under it before.

        ``then`` is called when the new rows are published and the old ones not deleted
        yet. ``write`` lays the files out instead of this class; what they are read with
        is then ``schema``.
        """
        keep = lambda part: key is None or part.key != key
        return self._publish(df, partition_by, key, keep, then, write, schema)

    def _publish(
        self,
        df: DataFrame,
        partition_by: Sequence[str],
        key: str | None,
        keep: Callable[[Part], bool],
        then: Callable[[Part], None] | None,
        write: Callable[[DataFrame, str], None] | None = None,
        schema: T.StructType | None = None,
    ) -> Part:
        listed = [part for part in self.parts() if keep(part)]
        part = Part(uuid.uuid4().hex, key, schema or df.schema, tuple(partition_by))
        folder = self.location(part)
        try:
            if write is not None:
                write(df, folder)
            else:
                with_stored(df, partition_by).write.partitionBy(*partition_by).parquet(folder)
            files, root = file_system(self.spark, folder)
            if not files.exists(root):
                raise OSError(f"nothing was written to {folder}")
        except BaseException:
            delete(self.spark, folder)
            raise
        self._list([*listed, part])
        if then is not None:
            then(part)
        self.clear()
        return part

    def _list(self, parts: list[Part]) -> None:
        """Write the next entry of the log: the switch."""
        kinds = list(dict.fromkeys(p.schema.json() if p.schema else "" for p in parts))
        place = {kind: i for i, kind in enumerate(kinds)}
        entry = {
            "schemas": [json.loads(k) if k else None for k in kinds],
            "parts": [
                {"folder": p.folder, "key": p.key, "partition_by": list(p.partition_by),
                 "schema": place[p.schema.json() if p.schema else ""]}
                for p in parts
            ],
        }
        last = max([0, *(int(name.split(".")[0]) for name in child_names(self.spark, f"{self.path}/{LOG}"))])
        write_text(self.spark, f"{self.path}/{LOG}/{last + 1:020d}.json", json.dumps(entry))

    def clear(self) -> None:
        """Delete what the last entry does not list: what it replaced, and what runs that
        stopped on their way left behind."""
        last, _ = self._last_entry()
        if last is None:
            return
        parts = self.parts()
        listed = {f"{_PART_COLUMN}={p.folder}" for p in parts}
        for name in child_names(self.spark, f"{self.path}/{PARTS}"):
            if name not in listed:
                delete(self.spark, f"{self.path}/{PARTS}/{name}")
        if all(p.folder for p in parts):
            for name in child_names(self.spark, self.path):
                if not name.startswith(("_", ".")) or name == "_SUCCESS":
                    delete(self.spark, f"{self.path}/{name}")
        for name in child_names(self.spark, f"{self.path}/{LOG}"):
            if name != last:
                delete(self.spark, f"{self.path}/{LOG}/{name}")
        self.spark.catalog.refreshByPath(self.path)


def _as_field(df: DataFrame, present: str | None, field: T.StructField) -> Column:
    if present is None:
        return F.lit(None).cast(field.dataType).alias(field.name)
    value, wanted = col(present), _loose(field.dataType)
    if _loose(df.schema[present].dataType) != wanted:
        value = value.try_cast(wanted)
    return value.alias(field.name)


def _loose(kind: T.DataType) -> T.DataType:
    """The type with NULLs allowed at every level, as files are read."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_loose(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_loose(kind.keyType), _loose(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in kind.fields])
    return kind


def read_published(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows published under ``path``, or lying there as plain files."""
    return Dataset(spark, path).read(schema)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Paths, below the folder, of all data files under it."""
    files, root = file_system(spark, folder)
    if not files.exists(root):
        return []
    base = files.getFileStatus(root).getPath().toString().rstrip("/") + "/"
    found, listed = [], files.listFiles(root, True)
    while listed.hasNext():
        name = listed.next().getPath().toString().removeprefix(base)
        if not any(part.startswith(("_", ".")) and "=" not in part for part in name.split("/")):
            found.append(name)
    return sorted(found)
