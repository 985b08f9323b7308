"""One row per key, counts per key, and values carried down ordered rows.

None of these hands all rows of a key to one task: the least or greatest row of a key is an
aggregate that is computed map-side before the shuffle, and so are counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def _extreme_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    """The row whose values, compared in ``order`` and then in column order, are extreme."""
    skip = {*key, *order}
    fields = [c for c in order if c not in key] + [c for c in df.columns if c not in skip]
    if not fields:
        return df.select(*df.columns).distinct()
    rows = df.groupBy(*key).agg(pick(F.struct(*fields)).alias("__row"))
    return rows.select(
        *[F.col(c) if c in key else F.col(f"__row.{c}").alias(c) for c in df.columns]
    )


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The first row of each key by ``order``, nulls first; ties go by the remaining columns.

    Found as the least of structs of all columns. Compared with numbering sorted rows this
    sorts by the key only, and sends one row per key and task to the shuffle.
    """
    return _extreme_per_key(df, key, order, F.min)


def last_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last row of each key by ``order``; ties go by the remaining columns, also last."""
    return _extreme_per_key(df, key, order, F.max)


def first_ranked(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key for orders of mixed direction.

    Numbers sorted rows; each task passes on the first row of a key only (the plan shows a
    partial ``WindowGroupLimit``).
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK)


def any_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One arbitrary row per key, for when the rows of a key are known to agree."""
    return df.dropDuplicates(list(key))


def with_group_count(df: DataFrame, by: str, out: str = "frequency") -> DataFrame:
    """Attach to each row how many rows share its value of ``by`` (0 for null).

    Written as aggregate and join, not as a window: a window would send all rows of a frequent
    value to one task, while the aggregate shrinks them first and the join may be split.
    """
    counts = df.groupBy(F.col(by).alias("__value")).agg(F.count(by).alias(out))
    return df.join(counts, F.col(by).eqNullSafe(F.col("__value")), "left").drop("__value")


def carry_down(
    df: DataFrame, value: str, out: str, group: Sequence[str], chunk: str, order: Sequence[str]
) -> DataFrame:
    """The last non-null ``value`` at or above each row within its ``group``.

    Rows of a group come in chunks of bounded size (the splits of a file). The value is carried
    down inside each chunk, and only one row per chunk takes part in carrying it from chunk to
    chunk, so a huge file is still read by many tasks.
    """
    inside = (
        Window.partitionBy(*group, chunk)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = (
        Window.partitionBy(*group)
        .orderBy(chunk)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    found = F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("__v")))
    entering = (
        df.groupBy(*group, chunk)
        .agg(F.max(found)["__v"].alias("__tail"))
        .withColumn("__entering", F.last("__tail", ignorenulls=True).over(before))
        .select(*group, chunk, "__entering")
    )
    return (
        df.withColumn("__inside", F.last(value, ignorenulls=True).over(inside))
        .join(entering, [*group, chunk], "left")
        .withColumn(out, F.coalesce("__inside", "__entering"))
        .drop("__inside", "__entering")
    )
