"""What a load needs from the session: shared scratch space and shuffle sizing."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

SCRATCH_FOLDER = "millrace"

MIB = 1 << 20
#: Source bytes (as stored) that one shuffle partition should stand for.
SHUFFLE_BYTES = 256 * MIB
#: Beyond this many tasks per side, the map x reduce block count costs more than
#: larger partitions do (they sort and spill).
MAX_TASKS = 100_000
#: Spark's stand-in for a size it does not know (``spark.sql.defaultSizeInBytes``).
_UNKNOWN_BYTES = (1 << 63) - 1
#: Partition values one task may write side by side before Spark sorts by them.
OPEN_FILES_PER_TASK = 4
#: Size AQE aims at when it packs or splits shuffle partitions, hence output files.
MAX_ADVISORY_BYTES = 512 * MIB


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder all executors can reach: under ``spark.checkpoint.dir`` or,
    where that is unset, under the warehouse.

    Spark's own default for the warehouse is a folder of the driver's machine, so on a
    cluster one of the two must be set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        unset = warehouse.removeprefix("file:") == f"{os.getcwd()}/spark-warehouse"
        if unset and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = warehouse + "/_scratch"
    return f"{root.rstrip('/')}/{SCRATCH_FOLDER}/{label}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a folder; 0 if there is none."""
    files, folder = file_system(spark, path)
    return files.getContentSummary(folder).getLength() if files.exists(folder) else 0


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right under a folder; none if there is no folder."""
    files, folder = file_system(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, if it is there."""
    files, folder = file_system(spark, path)
    files.delete(folder, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; an error if it is there already."""
    files, file = file_system(spark, path)
    files.mkdirs(file.getParent())
    out = files.create(file, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    files, file = file_system(spark, path)
    stream = files.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``scratch_dir``; refuses any other path."""
    if f"/{SCRATCH_FOLDER}/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    files, folder = file_system(spark, path)
    files.delete(folder, True)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; for a file scan, the bytes on disk.

    0 when Spark does not know: an unfiltered catalog table without statistics.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < _UNKNOWN_BYTES else 0


def in_bytes(spark: SparkSession, name: str) -> int:
    """A session setting that is a size, such as ``64m``."""
    text = spark.conf.get(name).strip().lower()
    digits = text.rstrip("bkmgtp")
    unit = text[len(digits) :].rstrip("b")
    return int(digits) << (10 * ("kmgtp".index(unit) + 1) if unit else 0)


def scaled_settings(input_bytes: int, partitions: int, split: int, advisory: int) -> dict:
    """Shuffle and scan settings for an input; never smaller than the current ones.

    A fixed partition count that suits gigabytes leaves hundreds of gigabytes per
    reducer at 100 TB. AQE merges partitions that turn out too small, so starting
    high is cheap; it cannot split the reducers of a window, so starting low is not.
    """
    tasks = -(-input_bytes // SHUFFLE_BYTES)
    per_task = -(-input_bytes // MAX_TASKS)
    return {
        "spark.sql.shuffle.partitions": max(partitions, min(tasks, MAX_TASKS)),
        "spark.sql.files.maxPartitionBytes": max(split, per_task),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": max(
            advisory, min(per_task, MAX_ADVISORY_BYTES)
        ),
    }


@contextmanager
def settings(spark: SparkSession, values: dict) -> Iterator[None]:
    """Set session settings for a block, then put back what was there.

    Settings belong to the session, so threads that share one take turns. Loads that
    are to run side by side each need their own, from ``spark.newSession()``.
    """
    with _lock_of(spark._jsparkSession.hashCode()):
        before = {name: spark.conf.get(name, None) for name in values}
        for name, value in values.items():
            spark.conf.set(name, str(value))
        try:
            yield
        finally:
            for name, value in before.items():
                if value is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, value)


@cache
def _lock_of(session: int) -> RLock:
    return RLock()


@contextmanager
def sized_for(spark: SparkSession, *inputs: DataFrame, stored: int = 0) -> Iterator[None]:
    """Run a block with settings that fit the size of its inputs, and with AQE on.

    ``stored`` adds the bytes of inputs whose size Catalyst does not know.

    AQE is what splits a hot key of a join and a hot value of a partitioned write.
    """
    values = scaled_settings(
        stored + sum(estimated_bytes(df) for df in inputs),
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        in_bytes(spark, "spark.sql.files.maxPartitionBytes"),
        in_bytes(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes"),
    )
    values["spark.sql.adaptive.enabled"] = "true"
    writers = int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
    values["spark.sql.maxConcurrentOutputFileWriters"] = max(writers, OPEN_FILES_PER_TASK)
    with settings(spark, values):
        yield
