"""Run a load while its executors are being killed; results and counts must not change.

Not collected by pytest, as it starts a small cluster of its own on this machine:

    python tests/executor_loss.py /root/testdata/sf0.1 FOLDER_ALL_EXECUTORS_SHARE
"""

from __future__ import annotations

import os
import signal
import subprocess
import sys
import threading
import time
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace import LoadOptions, run_load  # noqa: E402
from millrace.registry.queries import lineitem_spec  # noqa: E402

MAX_KILLS = 5


def executors(jvm_pid: int) -> list[int]:
    """Executor processes that this session's JVM started."""
    listing = subprocess.run(["ps", "-eo", "pid,ppid,args"], capture_output=True, text=True)
    rows = [line.split(None, 2) for line in listing.stdout.splitlines()[1:]]
    return [
        int(pid)
        for pid, parent, command in rows
        if int(parent) == jvm_pid and "CoarseGrainedExecutorBackend" in command
    ]


def main(sf_dir: str, work: str) -> None:
    spark = (
        SparkSession.builder.master("local-cluster[3,2,2048]")
        .config("spark.executor.memory", "1500m")
        .config("spark.sql.shuffle.partitions", "24")
        .config("spark.sql.files.maxPartitionBytes", "2m")
        .config("spark.checkpoint.dir", f"{work}/shared")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    copies = F.explode(F.sequence(F.lit(0), F.lit(3)))
    source = f"{work}/source"
    (
        lines.withColumn("copy", copies)
        .withColumn("l_orderkey", F.col("l_orderkey") * 4 + F.col("copy"))
        .drop("copy")
        .repartition(24)
        .write.parquet(source)
    )
    spec = replace(lineitem_spec(sf_dir), source_path=source)
    calm = run_load(spark, spec, f"{work}/calm", LoadOptions(full_load=True))

    jvm_pid = int(spark._jvm.java.lang.ProcessHandle.current().pid())
    killed, done = [], threading.Event()

    def kill_now_and_then() -> None:
        while not done.wait(3) and len(killed) < MAX_KILLS:
            for pid in executors(jvm_pid)[:1]:
                os.kill(pid, signal.SIGKILL)
                killed.append(pid)

    killer = threading.Thread(target=kill_now_and_then)
    killer.start()
    start = time.perf_counter()
    rough = run_load(spark, spec, f"{work}/rough", LoadOptions(full_load=True))
    seconds = time.perf_counter() - start
    done.set()
    killer.join()

    counts = [(r.source, r.valid, r.rejected, r.rule_failures, r.nulls) for r in (calm, rough)]
    assert killed and counts[0] == counts[1], (killed, counts)
    for one, other in ((calm, rough), (rough, calm)):
        assert one.curated(spark).exceptAll(other.curated(spark)).isEmpty()
        assert one.rejects(spark).exceptAll(other.rejects(spark)).isEmpty()
    assert rough.staged(spark).count() == rough.source
    print(f"{len(killed)} executors killed in {seconds:.0f} s, same rows and counts: {counts[0]}")
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:3])
