"""SimHash near-duplicates: an inverted index of byte positions with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ceil_div, ready
from starmill.llm.links import components
from starmill.session import stage

SEED = 42
BYTES = 8
CHUNK = 1 << 16


def simhash(text: str | None, shingle: int = 3) -> int:
    """The fingerprint as a signed number: bit i is 1 if it is in over half of the shingles'
    hashes. Words are runs without ASCII white space, A-Z in lower case."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if len(words) >= shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        hashes = b"".join([digest(line[s:e], SEED) for s, e in spans])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, BYTES), axis=1)
        ones += bits.sum(0, dtype=np.int32)
    value = np.packbits(2 * ones > len(starts)).tobytes()
    return int.from_bytes(value, "big", signed=True)


def fingerprint_texts(shingle: int):
    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(t, shingle) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found, pa.int64())], ["doc_id", "fp"]
            )

    return fingerprints


def postings(fp: Column, distance: int, shared: int) -> Column:
    """The index entries of a fingerprint, one per choice of ``shared`` byte positions.

    Two fingerprints that differ in at most ``distance`` bits agree in at least 8 - ``distance``
    of their 8 bytes, and so in ``shared`` bytes of any ``shared + distance`` positions. An
    entry names the positions and their bytes, so every such pair meets in one entry at least.
    """
    entries = []
    for n, chosen in enumerate(combinations(range(shared + distance), shared)):
        taken = [F.shiftrightunsigned(fp, 8 * i).bitwiseAND(F.lit(255)) for i in chosen]
        bytes_ = reduce(lambda a, b: F.shiftleft(a, 8).bitwiseOR(b), taken)
        entries.append(F.lit(n).cast("long") * (1 << 8 * shared) + bytes_)
    return F.array(*entries)


def near(a: np.ndarray, b, distance: int) -> np.ndarray:
    """Tally the bytes that agree by position, keep pairs with the least possible number for the
    distance, and verify those by their differing bits."""
    differ = a ^ b
    tally = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(1)
    hit = tally >= BYTES - distance
    hit[hit] = np.bitwise_count(differ[hit]) <= distance
    return hit


def spanning_links(fps: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what pairs within the distance connect: each fingerprint found from
    another is linked to the first of its component and not compared as a target again."""
    links = []
    left = fps
    while len(left) > 1:
        first, rest = left[0], left[1:]
        waiting = [first]
        while waiting and len(rest):
            hit = near(rest, waiting.pop(), distance)
            if hit.any():
                new = rest[hit]
                links.append((np.full(len(new), first), new))
                waiting.extend(new)
                rest = rest[~hit]
        left = rest
    return links


def link_entries(distance: int):
    """Links inside the entries of a bucket: rows ``entry, low, high, fp``."""

    def link(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["entry", "low", "high", "fp"])
        unit = part[["entry", "low", "high"]].to_numpy()
        fps = part["fp"].to_numpy().view(np.uint64)
        first = np.flatnonzero(np.r_[True, (unit[1:] != unit[:-1]).any(1)])
        size = np.diff(np.r_[first, len(fps)])
        two = first[size == 2]
        hit = near(fps[two], fps[two + 1], distance)
        links = [(fps[two][hit], fps[two + 1][hit])]
        for at, n in zip(first[size > 2], size[size > 2], strict=True):
            links += spanning_links(fps[at : at + n], distance)
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*links, strict=True))
        return pd.DataFrame({"a": a, "b": b}).drop_duplicates()

    return link


def links_of(fps: DataFrame, distance: int, shared: int, block: int, per_bucket: int) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints within the distance of each other.

    Entries with one fingerprint are dropped. An entry with more than ``block`` is cut into
    blocks, and every pair of its blocks is a unit of work, so no task gets a whole hot entry.

    Entries are sized like the fingerprints they are exploded from, of which they are many times
    as many, so their join must not be left to a choice by size, which may be a broadcast.
    """
    entries = fps.select(F.explode(postings(F.col("fp"), distance, shared)).alias("entry"), "fp")
    counts = entries.groupBy("entry").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("long")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    shared_ = (
        entries.join(counts.hint("merge"), "entry")
        .withColumn("blocks", blocks)
        .select(
            "entry",
            "fp",
            own.alias("own"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"),
        )
        .select(
            "entry",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "fp",
        )
    )
    units = stage(shared_, "simhash-entries")
    buckets = ceil_div(units.count(), per_bucket) or 1
    bucket = F.pmod(F.xxhash64("entry", "low", "high"), F.lit(buckets))
    return units.groupBy(bucket.alias("bucket")).applyInPandas(
        link_entries(distance), "a long, b long"
    )


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 3,
    shared: int = 4,
    block: int = 20_000,
    per_bucket: int = 200_000,
) -> DataFrame:
    """Components of documents whose fingerprints are within ``distance`` bits, over any number
    of links: ``doc_id, fingerprint, component_id``.

    Texts without words, null and empty ones among them, have fingerprint zero and are linked
    like others. A text with fewer words than ``shingle`` is one shingle. ``component_id`` is
    the least id of the component; null ids are never the least, unless there is no other.
    Repeated rows share a component. An empty table gives no rows; columns other than the two
    named are not read.

    Equal fingerprints are one node, whatever their number. ``shared`` byte positions make an
    entry of the index; more of them make entries more selective and more numerous.
    """
    ready(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    docs = stage(
        df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
            fingerprint_texts(shingle), f"doc_id {kind}, fp long"
        ),
        "simhash-fingerprints",
    )
    nodes = stage(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    links = links_of(nodes.select("fp"), distance, shared, block, per_bucket)
    roots = components(links)
    placed = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = stage(placed.join(least, "root").select("fp", "component_id"), "simhash-components")
    return docs.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
