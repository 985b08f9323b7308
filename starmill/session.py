"""Session settings and the shared folder that staged tables are written to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "starmill", **conf: str) -> SparkSession:
    """A one-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return use_utc(builder.getOrCreate())


def cluster_settings(shuffle_bytes: int, per_task: int = 256 << 20) -> dict[str, str]:
    """Session options for a job whose widest shuffle carries about ``shuffle_bytes``.

    Shuffles start with partitions that a task can sort in memory; the adaptive planner merges
    small ones, splits the ones that a frequent key fills, and broadcasts by measured size.
    """
    partitions = max(200, -(-shuffle_bytes // per_task))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(per_task),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(per_task),
        "spark.sql.session.timeZone": "UTC",
    }


#: Rows that a task holds in memory with ease, however wide they are.
ROWS_PER_TASK = 1 << 19


def tasks_for(rows: int) -> int:
    return -(-rows // ROWS_PER_TASK) or 1


@contextmanager
def small_tasks(spark: SparkSession, per_task: int = 8 << 20) -> Iterator[Callable[[int], None]]:
    """Options under which the tasks of a job read ``per_task`` bytes of a file or a shuffle. Rows
    that compress well take many times that in a sort or an aggregate, so the planner's default
    of 64 MB is not small. Yields a function to tell the rows that are shuffled: that many have
    shuffles of enough partitions, which the planner merges where they are smaller."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    options = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(per_task),
        "spark.sql.files.maxPartitionBytes": str(per_task),
        most: str(partitions),
    }
    before = {name: spark.conf.get(name, None) for name in options}
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        yield lambda rows: spark.conf.set(most, str(max(partitions, tasks_for(rows))))
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def use_utc(spark: SparkSession) -> SparkSession:
    """Epoch decoding and calendar parts are defined in UTC, whatever the host's zone is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster such a folder
    exists once per machine, and what one executor writes there the others cannot read.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starmill-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, never reused. Those of one application lie together,
    so that they can be removed once it has ended."""
    application = spark.conf.get("spark.app.id", "unknown")
    return f"{shared_folder(spark)}/starmill/{application}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet and return a frame that reads the written copy.

    Cuts the lineage: later steps neither recompute ``df`` nor depend on the executors that
    computed it, and the optimizer sees the written size.
    """
    spark = df.sparkSession
    path = path or new_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(
    spark: SparkSession, jobs: Mapping[str, Callable[[], object]], at_once: int = 4
) -> dict:
    """Start independent Spark jobs side by side, so that the last tasks of one do not leave
    executors idle; returns their results by name."""
    in_thread = inheritable_thread_target(spark)
    with ThreadPoolExecutor(at_once) as pool:
        started = {name: pool.submit(in_thread(job)) for name, job in jobs.items()}
        return {name: result.result() for name, result in started.items()}
