"""What the operators of this subpackage share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.session import use_utc

WORD = r"[^\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """Session options the operators rely on: UTC, Arrow batches that stay small when texts are
    long, and shuffle files that go when their query has ended."""
    use_utc(spark)
    with_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id written as text, modulo n; of the empty text where the id is null."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % n


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def with_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started from."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
