"""Dimension tables: projection, one row per key, surrogate keys, time, most frequent value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions import as_column, calendar_parts, hash_key
from starmill.operators.keyed import any_per_key, first_per_key, first_ranked, last_per_key
from starmill.session import stage

# Rows a task may number under one partition id of monotonically_increasing_id.
_SLOT_BITS = 33


def project(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Select ``{new name: column or expression}``."""
    return df.select(*[as_column(c).alias(name) for name, c in mapping.items()])


def dimension(
    df: DataFrame,
    mapping: Mapping[str, Column | str],
    key: Sequence[str],
    keep: str = "first",
    order: Sequence[str] = (),
) -> DataFrame:
    """A dimension of ``df``: the mapped columns with one row per key.

    ``keep`` is "first" or "latest" by ``order`` (columns of ``df``), "any" for an arbitrary
    row, or "distinct" for every distinct row, which may leave several per key.
    """
    if keep == "distinct":
        return project(df, mapping).distinct()
    if keep == "any":
        return any_per_key(project(df, mapping), key)
    ranked = {f"__order{i}": F.col(c) for i, c in enumerate(order)}
    wide = project(df, {**mapping, **ranked})
    pick = {"first": first_per_key, "latest": last_per_key}[keep]
    return pick(wide, key, list(ranked)).drop(*ranked)


def distinct_union(*frames: DataFrame) -> DataFrame:
    """The rows of all frames, matched by column name, each once."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result.distinct()


def time_dim(
    df: DataFrame,
    times: Sequence[Column | str],
    weekday: str = "sun1",
    distinct: bool = True,
    since: Column | None = None,
    name: str = "start_time",
) -> DataFrame:
    """The time dimension of one or more timestamp columns.

    All roles are taken from one scan, and only the timestamps are shuffled for the distinct:
    the calendar parts follow from them and are computed afterwards.
    """
    roles = [as_column(c).cast("timestamp") for c in times]
    stamp = F.explode(F.array(*roles)) if len(roles) > 1 else roles[0]
    stamps = df.select(stamp.alias(name)).filter(F.col(name).isNotNull())
    if since is not None:
        stamps = stamps.filter(F.col(name) >= since)
    if distinct:
        stamps = stamps.distinct()
    parts = calendar_parts(name, weekday)
    return stamps.select(name, *[c.alias(part) for part, c in parts.items()])


def argmax_by_group(
    df: DataFrame, by: Sequence[str], value: str, ties: str = "all", order: Sequence[str] = ()
) -> DataFrame:
    """The rows that hold the greatest ``value`` of their group.

    ``ties="all"`` keeps each of them; ``ties="one"`` the first by ``order`` and then by the
    remaining columns.
    """
    if ties == "one":
        rest = [*order, *[c for c in df.columns if c not in {*by, *order, value}]]
        return first_ranked(df, by, [F.col(value).desc(), *[F.col(c) for c in rest]])
    best = df.groupBy(*by).agg(F.max(value).alias(value))
    return df.join(best, [*by, value], "inner").select(*df.columns)


def surrogate_key(
    df: DataFrame, key: Sequence[str], out: str, method: str = "hash"
) -> DataFrame:
    """Add a generated long key to rows that are unique by ``key``.

    ``hash``: computed from the key, without a shuffle, the same on every run.
    ``dense``: 0, 1, 2, ... in the order of ``key``. Rows are range-partitioned and sorted,
    numbered inside their partition, staged once, and shifted by the sizes of the partitions
    before theirs. No step sorts all rows in one task.
    ``fast``: unique within one evaluation only; stage the result before using it twice.
    """
    if method == "hash":
        return df.withColumn(out, hash_key(*key))
    if method == "fast":
        return df.withColumn(out, F.monotonically_increasing_id())
    if method != "dense":
        raise ValueError(f"unknown key method {method!r}")
    slot = F.monotonically_increasing_id()
    numbered = stage(
        df.repartitionByRange(*key)
        .sortWithinPartitions(*key)
        .withColumn("__slot", slot)
        .withColumn("__part", F.shiftright("__slot", _SLOT_BITS))
        .withColumn("__row", F.col("__slot").bitwiseAND((1 << _SLOT_BITS) - 1))
        .drop("__slot"),
        "dense-key",
    )
    # One row per shuffle partition, so this window and broadcast are bounded by the settings.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(
            "__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
        )
    )
    return (
        numbered.join(F.broadcast(offsets), "__part")
        .withColumn(out, F.col("__offset") + F.col("__row"))
        .drop("__part", "__row", "__offset")
    )
