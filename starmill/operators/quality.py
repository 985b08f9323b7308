"""Checks on tables, gathered into one report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.schemas import TableSpec


@dataclass(frozen=True)
class CheckSpec:
    """What must hold for a table, besides having rows."""

    not_null: Sequence[str] = ()
    key: Sequence[str] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)

    @classmethod
    def of(cls, spec: TableSpec) -> CheckSpec:
        return cls(spec.not_null, spec.key, spec.max_length)


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and nulls of each column, counted in one pass: (column_name, row_count, nulls)."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(columns)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("__rows").alias("row_count"),
            F.col(f"__n{i}").alias("null_count"),
        )
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*entries)))


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def check_table(name: str, df: DataFrame, spec: CheckSpec) -> DataFrame:
    """One row per check: (table_name, check_name, column_name, violations, passed).

    Emptiness, nulls and lengths come from a single aggregate; uniqueness needs one of its own.
    """
    checks = [("not_empty", "", (F.count(F.lit(1)) == 0).cast("long"))]
    checks += [("not_null", c, F.count_if(F.col(c).isNull())) for c in spec.not_null]
    checks += [
        ("max_length", c, F.count_if(F.length(c) > n)) for c, n in spec.max_length.items()
    ]
    counts = df.agg(*[value.alias(f"__v{i}") for i, (_, _, value) in enumerate(checks)])
    report = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(check).alias("check_name"),
                        F.lit(column).alias("column_name"),
                        F.col(f"__v{i}").alias("violations"),
                    )
                    for i, (check, column, _) in enumerate(checks)
                ]
            )
        )
    )
    if spec.key:
        unique = (
            repeated_keys(df, spec.key)
            .agg(F.count(F.lit(1)).alias("violations"))
            .select(
                F.lit("unique").alias("check_name"),
                F.lit(",".join(spec.key)).alias("column_name"),
                "violations",
            )
        )
        report = report.unionByName(unique)
    return report.select(
        F.lit(name).alias("table_name"),
        "check_name",
        "column_name",
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def run_checks(tables: Mapping[str, tuple[DataFrame, CheckSpec]]) -> DataFrame:
    """The checks of several tables in one report."""
    reports = [check_table(name, df, spec) for name, (df, spec) in tables.items()]
    return reduce(DataFrame.unionByName, reports)


def enforce(report: DataFrame) -> None:
    """Raise ``ValueError`` that names every failed check of the report."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        listing = "; ".join(
            f"{r.table_name}: {r.check_name} {r.column_name} ({r.violations} violations)"
            for r in failed
        )
        raise ValueError(f"data quality check failed: {listing}")


def coverage(fact: DataFrame, dim: DataFrame, on: tuple[str, str]) -> DataFrame:
    """How many fact rows find their key in the dimension: (matched, total, ratio).

    Fact rows are counted per key before the join.
    """
    a, b = on
    per_key = fact.groupBy(F.col(a).alias("__key")).agg(F.count(F.lit(1)).alias("__rows"))
    keys = dim.select(F.col(b).alias("__dim_key")).distinct()
    joined = per_key.join(keys, F.col("__key") == F.col("__dim_key"), "left")
    matched = F.sum(F.when(F.col("__dim_key").isNotNull(), F.col("__rows")).otherwise(0))
    return joined.agg(
        F.coalesce(matched, F.lit(0)).alias("matched"),
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("total"),
    ).withColumn("ratio", F.try_divide("matched", "total"))
