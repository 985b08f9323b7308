"""Numeric conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill.functions.columns import as_column


def as_long(c: Column | str, zero_is_null: bool = False) -> Column:
    """Number or numeric text to a long (fraction cut off); null where it is neither."""
    value = F.coalesce(as_column(c).try_cast("long"), as_column(c).try_cast("double").try_cast("long"))
    return F.nullif(value, F.lit(0)) if zero_is_null else value


def rounded_decimal(c: Column | str, precision: int = 18, scale: int = 0) -> Column:
    """Half-up rounding into a fixed-point type, as a load into a decimal column does."""
    return as_column(c).cast(f"decimal({precision},{scale})")


def share_percent(condition: Column) -> Column:
    """Aggregate: percentage of the rows for which ``condition`` holds."""
    return F.avg(condition.cast("double")) * F.lit(100)
