"""Rows with and without missing values. NaN counts as missing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _missing(df: DataFrame, column: str) -> Column:
    if df.schema[column].dataType.typeName() in ("double", "float"):
        return F.col(column).isNull() | F.isnan(column)
    return F.col(column).isNull()


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep the rows that have a value in each of the columns.

    The rows ``na.drop`` keeps, but as plain conditions, which reach the scan as pushed filters.
    """
    present = [~_missing(df, c) for c in (columns or df.columns)]
    return df.filter(reduce(and_, present))


def rows_with_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep the rows in which at least one of the columns has no value."""
    return df.filter(reduce(or_, [_missing(df, c) for c in (columns or df.columns)]))
