"""Histogram sort: shards of nearly equal bytes, cut at splitters found by counting."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import ceil_div, ready
from starmill.session import stage

#: The sort key is (hash of the text, hash of the id). A round of counting splits each open
#: interval of the key into 4096; these are the shifts of its rounds.
SHIFTS = (52, 40, 28, 16, 4, 0)
TOP = 1 << 63


def keyed(df: DataFrame, id_col: str, text_col: str, overhead: int) -> DataFrame:
    text = F.col(text_col)
    spread = F.when(
        F.col(id_col).isNull(), F.xxhash64(F.monotonically_increasing_id())
    ).otherwise(F.xxhash64(F.col(id_col)))
    return df.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + overhead).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("k1"),
        spread.alias("k2"),
    )


def splitters(rows: DataFrame, total: int, shards: int, tolerance: float) -> list[tuple]:
    """Key boundaries (k1, k2): the rows below the j-th hold close to j/shards of all bytes.

    A round counts the bytes below every probe inside the open intervals and keeps, per
    splitter, the interval that its aim falls into. At most (shards - 1) x 4096 counts come
    to the driver in a round, whatever the number of rows. A splitter is settled once a probe
    is within the tolerance, so that equal texts are cut apart only where bytes demand it.
    """
    allowed = tolerance * total / shards
    aims = [total * j / shards for j in range(1, shards)]
    done: dict[int, tuple] = {}
    # open intervals: (k1 or None, prefix or None) -> bytes below, and the splitters inside
    open_: dict[tuple, tuple[int, list[int]]] = {(None, None): (0, list(range(len(aims))))}
    for column in ("k1", "k2"):
        for i, shift in enumerate(SHIFTS):
            if not open_:
                break
            prefix = F.shiftright(F.col(column), shift)
            at = F.col("k1") if column == "k2" else F.lit(None).cast("long")
            inside = rows
            if column == "k2":
                inside = inside.where(F.col("k1").isin([k for k, _ in open_]))
            if i:
                before = F.shiftright(F.col(column), SHIFTS[i - 1])
                inside = inside.where(before.isin([p for _, p in open_]))
                before = before.alias("before")
            else:
                before = F.lit(None).cast("long").alias("before")
            counts = inside.groupBy(at.alias("at"), before, prefix.alias("probe")).agg(
                F.sum("size").alias("size")
            )
            found: dict[tuple, list] = {}
            for at_, before_, probe, size in counts.collect():
                found.setdefault((at_, before_), []).append((probe, size))
            following: dict[tuple, tuple[int, list[int]]] = {}
            for interval, (below, wanted) in open_.items():
                k1 = interval[0]
                probes = sorted(found[interval])
                ends = list(accumulate((s for _, s in probes), initial=below))
                for j in wanted:
                    n = min(max(bisect_right(ends, aims[j]) - 1, 0), len(probes) - 1)
                    nearest = n + (aims[j] - ends[n] > ends[n + 1] - aims[j])
                    last = column == "k2" and shift == 0
                    if abs(ends[nearest] - aims[j]) <= allowed or last:
                        low = (probes[n][0] + (nearest > n)) << shift
                        done[j] = (low, -TOP) if column == "k1" else (k1, low)
                    elif column == "k1" and shift == 0:
                        key = (probes[n][0], None)
                        following.setdefault(key, (ends[n], []))[1].append(j)
                    else:
                        key = (k1, probes[n][0])
                        following.setdefault(key, (ends[n], []))[1].append(j)
            open_ = following
    return [done[j] for j in range(len(aims))]


def shard_of(bounds: list[tuple]) -> Column:
    """The number of splitters at or below the row's key."""
    shard = F.lit(0)
    for k1, k2 in bounds:
        if k1 >= TOP:
            continue
        above = F.col("k1") > k1 if k2 >= TOP else (
            F.col("k1") >= k1
            if k2 == -TOP
            else (F.col("k1") > k1) | ((F.col("k1") == k1) & (F.col("k2") >= k2))
        )
        shard = shard + above.cast("int")
    return shard


def shard_by_bytes(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 40,
    overhead: int = 16,
    tolerance: float = 0.002,
    rows_per_part: int = 200_000,
) -> DataFrame:
    """Deal rows into shards of nearly equal bytes: ``doc_id, size, text_crc32, law, shard,
    slot, grown_shard``.

    Rows are ordered by the hash of the text, then of the id, so equal texts lie in one shard
    unless a splitter has to cut through them. Null text: no bytes, checksum 0, only the
    overhead. Rows with null ids count like others and are spread by position. Repeated rows
    with one id and text stay together. An empty table gives no rows. Columns other than the
    two named are not read. One exchange moves the rows; it groups by shard and by a part of
    the shard of some ``rows_per_part`` rows, so a shard is no single task.
    """
    ready(df.sparkSession)
    rows = stage(keyed(df, id_col, text_col, overhead), "shard-keys")
    total, n = rows.agg(F.sum("size"), F.count("*")).first()
    bounds = splitters(rows, total, shards, tolerance) if n else []
    parts = ceil_div(n, shards * rows_per_part) or 1
    dealt = rows.withColumn("shard", shard_of(bounds)).withColumn(
        "part", F.pmod(F.xxhash64("k2", "k1"), F.lit(parts))
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", "part")
        .agg(F.count("*").alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    place = Window.partitionBy("shard", "part").orderBy("k1", "k2")
    return dealt.join(offsets, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("offset") + F.row_number().over(place) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
