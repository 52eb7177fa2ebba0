"""What the operators of this package share: scratch tables and text expressions."""

from __future__ import annotations

import gc
import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import drop_scratch, in_bytes, scratch_dir

#: The characters that count as white space in word and line operators.
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: Characters that Python workers take on together.
TOGETHER = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its plain name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str) -> Column:
    return F.coalesce(column(name).cast("string"), F.lit(""))


#: Bytes of an Arrow batch, unless the session says otherwise: a batch is held by the
#: executor and by its Python worker at once, and a text can be long.
BATCH_BYTES = 8 << 20
#: The same for operators that only go through texts, which gain nothing from more at once.
TEXT_BATCH_BYTES = 2 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare_workers(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Batches of bounded size, and Python workers that find this package where the driver
    found it; on a cluster that installs it, or ships it with the job, they do anyway."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, root)))
    if in_bytes(spark, _BATCH_SETTING) > batch_bytes:
        spark.conf.set(_BATCH_SETTING, f"{batch_bytes}b")


def give_back_memory() -> None:
    """At the end of a task: a worker that is used again keeps what it still holds."""
    gc.collect()
    pa.default_memory_pool().release_unused()


class Scratch:
    """Tables written to the shared checkpoint folder, so that lost executors cost
    a re-read instead of a re-computation. ``drop`` removes those no longer needed."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, scratch_dir(spark, label)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            drop_scratch(self.spark, self.path(name))


def with_sizes(rows: DataFrame, key: str, scratch: Scratch, name: str, **totals: Column) -> DataFrame:
    """``rows`` with the totals of their group. Totals are combined before they are
    shuffled, and joined from a stored copy, so that no task holds a group: a hot key's rows
    stay where they are, or are split by AQE."""
    sizes = rows.groupBy(key).agg(*[total.alias(column_) for column_, total in totals.items()])
    sizes = scratch.save(sizes, name)
    return rows.join(small_side(sizes, scratch.path(name)), key)


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns ``c0``, ``c1``, …, which no name of an operator clashes with."""
    return df.select(*[column(c).alias(f"c{i}") for i, c in enumerate(df.columns)])


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def grouped(texts: Iterator[str], together: int = TOGETHER) -> Iterator[list[str]]:
    """Lists of texts of about so many characters; a longer text is alone in its list."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= together:
            yield held
            held, size = [], 0
    if held:
        yield held


#: Stored bytes up to which a table is sent to every executor instead of shuffled to.
SMALL_BYTES = 8 << 20


def stored_bytes(spark: SparkSession, path: str) -> int:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(folder).getLength()


def small_side(df: DataFrame, path: str) -> DataFrame:
    """``df``, read from the table at ``path``, for a join: marked for broadcast only if
    that table's size is below ``SMALL_BYTES``; Spark shuffles both sides otherwise."""
    return F.broadcast(df) if stored_bytes(df.sparkSession, path) <= SMALL_BYTES else df
