"""Registration of queries over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.session import new_path, use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder, opened when asked for. Timestamps without a zone are
    taken as UTC."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = use_utc(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        plain = [c for c, kind in df.dtypes if kind == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in plain})

    def path(self, label: str) -> str:
        """A fresh folder to write to."""
        return new_path(self.spark, label)


def query(oracle: str, name: str | None = None):
    """Register ``f(tables) -> DataFrame`` under its own or another name."""

    def register(f: Callable[[Tables], DataFrame]):
        key = name or f.__name__
        QUERIES[key] = lambda spark, folder: f(Tables(spark, folder))
        QUERIES[key].__doc__ = f.__doc__
        ORACLES[key] = oracle
        return f

    return register
