"""Column profiles of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How often each value of each column occurs: (column_name, value, frequency).

    One scan for all columns; equal values are counted map-side before the shuffle.
    """
    columns = list(columns or df.columns)
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        texts.unpivot([], columns, "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def _totals(counts: DataFrame) -> DataFrame:
    nulls = F.when(F.col("value").isNull(), F.col("frequency"))
    return counts.groupBy("column_name").agg(
        F.sum("frequency").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.coalesce(F.sum(nulls), F.lit(0)).alias("null_count"),
    )


def column_stats(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Rows, distinct values (null counts as one) and nulls of each column.

    Exact counts shuffle each distinct value once. ``approximate`` estimates them (within a few
    percent) in a single aggregate that shuffles only sketches, for columns of billions of values.
    """
    columns = list(columns or df.columns)
    if not approximate:
        return _totals(value_counts(df, columns))
    has_null = [F.max(F.col(c).isNull().cast("long")) for c in columns]
    measured = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[
            (F.approx_count_distinct(c) + F.coalesce(null, F.lit(0))).alias(f"__d{i}")
            for i, (c, null) in enumerate(zip(columns, has_null))
        ],
        *[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(columns)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("__rows").alias("row_count"),
            F.col(f"__d{i}").alias("distinct_values"),
            F.col(f"__n{i}").alias("null_count"),
        )
        for i, c in enumerate(columns)
    ]
    return measured.select(F.inline(F.array(*entries)))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, n: int = 10) -> DataFrame:
    """For each column its rows, distinct values (null counts as one), nulls, and the ``n``
    most frequent values, one per row; equally frequent values in value order, null last."""
    counts = value_counts(df, columns)
    totals = _totals(counts)
    # Only the first n rows per column and task are shuffled for the ranking.
    rank = F.row_number().over(
        Window.partitionBy("column_name").orderBy(
            F.col("frequency").desc(), F.col("value").asc_nulls_last()
        )
    )
    top = counts.withColumn("position", rank).filter(F.col("position") <= n)
    return top.join(totals, "column_name").select(
        "column_name",
        "row_count",
        "distinct_values",
        "null_count",
        (F.col("null_count") * 100.0 / F.col("row_count")).alias("null_percent"),
        "position",
        "value",
        "frequency",
    )


def group_sum(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Sums per group; null key values form groups of their own."""
    return df.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])


def greatest_deviation(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """The greatest standard deviation of each attribute within a group: 0 (or null, if every
    group has one row) for attributes that the key determines."""
    per_group = df.groupBy(*keys).agg(*[F.stddev_samp(a).alias(a) for a in attributes])
    return per_group.agg(*[F.max(a).alias(a) for a in attributes])
