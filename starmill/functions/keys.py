"""Keys computed from column values, equal on every run and every retry of a task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill.functions.columns import as_column


def hash_key(*cols: Column | str) -> Column:
    """64-bit key of a natural key.

    The null flags keep ("a", null) and (null, "a") apart, which the bare hash does not. Two
    of a million keys collide with a chance below 1 in 10 million; for tables of billions of
    keys use ``md5_key``.
    """
    parts = [p for c in cols for p in (as_column(c), as_column(c).isNull())]
    return F.xxhash64(*parts)


def md5_key(*cols: Column | str, sep: str = "") -> Column:
    """md5 of the concatenated values, null if one of them is null."""
    return F.md5(F.concat(*_joined([as_column(c).cast("string") for c in cols], sep)))


def _joined(parts: list[Column], sep: str) -> list[Column]:
    if not sep:
        return parts
    return [p for part in parts for p in (F.lit(sep), part)][1:]


def row_key(*cols: Column | str) -> Column:
    """128-bit key, as md5 text, of several values that may be null, for tables of any size."""
    marked = [F.coalesce(as_column(c).cast("string"), F.lit("\x00")) for c in cols]
    return F.md5(F.concat_ws("\x1f", *marked))
