"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import WORD, ceil_div, ready
from starmill.session import stage


def sainte_lague(weights: Sequence[float], seats: int, caps: Sequence[int]) -> list[int]:
    """Seats by the highest quotients weight / (2 x seats + 1), none above its cap; equal
    quotients go to the earlier party."""
    seats = min(seats, int(sum(caps)))
    total = float(sum(w for w, c in zip(weights, caps, strict=True) if c)) or 1.0
    # Below the fair share less one, every quotient is among the highest.
    won = [
        min(c, max(0, int(w / total * seats) - 1)) for w, c in zip(weights, caps, strict=True)
    ]
    heap = [
        (-w / (2 * n + 1), i)
        for i, (w, n, c) in enumerate(zip(weights, won, caps, strict=True))
        if n < c
    ]
    heapq.heapify(heap)
    for _ in range(seats - sum(won)):
        _, i = heapq.heappop(heap)
        won[i] += 1
        if won[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * won[i] + 1), i))
    return won


def fill(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Targets that share ``share`` x all sizes by weight, none above ``most`` x its size; what
    a full source leaves goes to the others by weight."""
    targets = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), set(range(len(sizes)))
    while open_:
        per = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if weights[i] * per > most * sizes[i]}
        if not full:
            for i in open_:
                targets[i] = weights[i] * per
            break
        for i in full:
            targets[i] = most * sizes[i]
            left -= targets[i]
        open_ -= full
    return targets


def plan_sources(spark, totals: list[tuple], cycle, share: float, most: float, block: int):
    """One row per source: its number, target and blocks. Sources by code point, null last."""
    totals = sorted(totals, key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [int(size) for _, size in totals]
    targets = fill(sizes, [cycle[i % len(cycle)] for i in range(len(sizes))], share, most)
    caps = [ceil_div(int(most * size), block) for size in sizes]
    blocks = sainte_lague(targets, round(sum(targets) / block), caps)
    return spark.createDataFrame(
        [
            (name, i, size, target, n)
            for i, ((name, _), size, target, n) in enumerate(
                zip(totals, sizes, targets, blocks, strict=True)
            )
        ],
        "name string, number int, source_size long, target double, blocks long",
    )


def quotas_of_shards(part: pd.DataFrame) -> pd.DataFrame:
    """The blocks of one source dealt to its shards; shards hold equally many documents."""
    part = part.sort_values("shard")
    block, most = int(part["block"].iloc[0]), float(part["most"].iloc[0])
    words = [int(w) for w in part["words"]]
    caps = [ceil_div(int(most * w), block) for w in words]
    won = sainte_lague(words, int(part["blocks"].iloc[0]), caps)
    take = [min(n * block, int(most * w)) for n, w in zip(won, words, strict=True)]
    return pd.DataFrame(
        {"number": part["number"], "shard": part["shard"], "words": words, "take": np.int64(take)}
    )


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cycle: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    block: int = 16,
    seed: int = 7,
    docs_per_shard: int = 20_000,
) -> DataFrame:
    """How many words of each document the mix takes: ``doc_id, size, source_size, target,
    taken, source_number, shard``.

    Sources, by code point and null last, weigh as ``cycle`` says; they share ``share`` times
    all words, none more than ``most`` times its own. The sum is cut into blocks of ``block``
    words. The highest quotients win blocks for sources, and again for the shards of a source,
    so every shard gets a whole number of blocks. In a shard the documents lie in seeded order;
    the words of its blocks are taken from the front, round after round. A document is taken
    whole in all full rounds and, if the last round ends inside it, up to there.

    Only one row per source passes the driver. A source is dealt over shards of about
    ``docs_per_shard`` documents by a seeded hash of the id, so none is one task. Null text has
    no words, a null id counts like any other, repeated rows are documents of their own, an
    empty table gives no rows; columns other than the three named are not read. The result
    depends on rows, not on their order, except that rows equal in all three columns may swap.
    """
    spark = ready(df.sparkSession)
    text = F.col(text_col)
    rows = stage(
        df.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.col(id_col), F.lit(seed)).alias("place"),
            F.xxhash64(text).alias("told"),
        ),
        "mix-sizes",
    )
    totals = rows.groupBy("source").agg(F.sum("size"), F.count("*")).collect()
    shards = ceil_div(sum(r[2] for r in totals), docs_per_shard) or 1
    sources = stage(
        plan_sources(spark, [(r[0], r[1]) for r in totals], cycle, share, most, block),
        "mix-sources",
    )
    dealt = rows.join(sources, F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id",
        "size",
        "place",
        "told",
        "number",
        "source_size",
        "target",
        "blocks",
        F.pmod(F.xxhash64("place"), F.lit(shards)).alias("shard"),
    )
    words = dealt.groupBy("number", "shard").agg(
        F.sum("size").alias("words"),
        F.first("blocks").alias("blocks"),
        F.lit(block).alias("block"),
        F.lit(most).alias("most"),
    )
    quotas = words.groupBy("number").applyInPandas(
        quotas_of_shards, "number int, shard long, words long, take long"
    )
    before = (
        Window.partitionBy("number", "shard")
        .orderBy("place", "doc_id", "told")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum("size").over(before), F.lit(0))
    rounds = F.when(F.col("words") > 0, F.expr("take div words")).otherwise(F.lit(0))
    rest = F.col("take") - rounds * F.col("words")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return (
        dealt.withColumn("start", start)
        .join(quotas, ["number", "shard"])
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (rounds * F.col("size") + part).cast("long").alias("taken"),
            F.col("number").alias("source_number"),
            "shard",
        )
    )


def take_words(df: DataFrame, text_col: str, size_col: str, taken_col: str) -> DataFrame:
    """Replace each text by the words taken from it: whole rounds, then its first words; what
    has none taken is left out. Words keep the white space before them."""
    word = r"[\x20\x09-\x0D]*" + WORD
    size, taken = F.col(size_col), F.col(taken_col)
    rest = F.expr(f"regexp_extract_all({text_col}, r'{word}', 0)")
    some = F.array_join(F.slice(rest, F.lit(1), (taken % size).cast("int")), "")
    whole = F.expr(f"repeat(concat({text_col}, '\n'), int({taken_col} div {size_col}))")
    return df.where(taken > 0).withColumn(
        text_col,
        F.when(taken % size == 0, F.rtrim(whole, F.lit("\n")))
        .otherwise(F.concat(whole, F.when(taken > 0, some)))
    )
