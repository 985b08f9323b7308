"""Counts of fact rows by attributes of their dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.nulls import drop_nulls


def count_by_dim(
    fact: DataFrame, dim: DataFrame, on: tuple[str, str], by: str, out: str = "count"
) -> DataFrame:
    """Fact rows per value of ``dim.by``, over the inner join ``fact.a = dim.b``.

    Fact rows are counted per foreign key before the join, so that what is shuffled is one row
    per key and task, however often a key occurs.
    """
    a, b = on
    per_key = fact.groupBy(F.col(a).alias("__key")).agg(F.count(F.lit(1)).alias("__rows"))
    side = dim.select(F.col(b).alias("__dim_key"), F.col(by))
    return (
        per_key.join(side, F.col("__key") == F.col("__dim_key"), "inner")
        .groupBy(by)
        .agg(F.sum("__rows").alias(out))
    )


def most_frequent_first(counts: DataFrame, by: str, count: str = "count") -> DataFrame:
    return counts.orderBy(F.col(count).desc(), F.col(by).asc())


def top_n_by_dim(
    fact: DataFrame, dim: DataFrame, on: tuple[str, str], by: str, n: int, out: str = "count"
) -> DataFrame:
    """The ``n`` values of ``dim.by`` with the most fact rows; null values do not count."""
    counts = count_by_dim(fact, drop_nulls(dim, [by]), on, by, out)
    return most_frequent_first(counts, by, out).limit(n)


def filtered_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Row counts under several conditions, from one pass."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def lookup_rows(
    df: DataFrame, where: dict[str, object], select: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Rows of a query table by its partition key, in clustering order."""
    for name, value in where.items():
        df = df.filter(F.col(name) == F.lit(value))
    rows = df.orderBy(*order) if order else df
    return rows.select(*select)


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """The first rows; without an order, any ``n`` rows, for which only a few files are read."""
    return (df.orderBy(*order) if order else df).limit(n)
