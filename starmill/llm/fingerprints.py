"""Document fingerprints: invertible Bloom lookup sketches of paragraphs."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ceil_div, ready

#: A paragraph ends with a line or a sentence.
PARAGRAPH = re.compile(r"[^\n.!?]*[\n.!?]+|[^\n.!?]+")
LONG = 600  # longer paragraphs are cut further, after words that a hash picks
SMALLEST = 8  # cells in each of the three rows of a published sketch
GROW = 4
U64 = np.uint64
FACTORS = np.array(
    [[0x9E3779B97F4A7C15], [0xC2B2AE3D27D4EB4F], [0x165667B19E3779F9], [0x27D4EB2F165667C5]], U64
)
ROWS = np.arange(3, dtype=U64)[:, None]


def paragraphs(text: str) -> list[str]:
    out = []
    for p in PARAGRAPH.findall(text):
        if len(p) <= LONG:
            out.append(p)
            continue
        own: list[str] = []
        for word in re.findall(r"\s*\S{1,64}|\s+", p):
            own.append(word)
            if zlib.crc32(word.encode("utf-8", "replace")) % 16 == 0:
                out.append("".join(own))
                own = []
        if own:
            out.append("".join(own))
    return out


def digests(text: str) -> np.ndarray:
    """A 64-bit digest of each paragraph; the n-th occurrence of an equal one has its own."""
    seen: dict[str, int] = {}
    out = []
    for p in paragraphs(text):
        n = seen.get(p, 0)
        seen[p] = n + 1
        out.append(xxhash.xxh64_intdigest(p.encode("utf-8", "replace"), n))
    return np.array(out, np.uint64)


def hashed(keys: np.ndarray) -> np.ndarray:
    """Four hashes of each key: three choose its cells, the last is its check."""
    h = (keys ^ (keys >> U64(31))) * FACTORS
    h ^= h >> U64(29)
    h *= FACTORS[0]
    h ^= h >> U64(32)
    h[3] &= U64(0xFFFFFFFF)
    return h


class Sketch:
    """Three rows of cells; a cell holds the number, the sum (xor) of digests and of their
    checks. The difference of two sketches of one size is the sketch of the sets' difference.
    Sizes are powers of two."""

    def __init__(self, size: int):
        self.size = size
        self.number = np.zeros(3 * size, np.int64)
        self.keys = np.zeros(3 * size, U64)
        self.checks = np.zeros(3 * size, U64)

    def put(self, keys: np.ndarray, h: np.ndarray, times=None) -> None:
        """Add digests with their hashes, each as often as ``times`` says, or once."""
        at = h[:3] & U64(self.size - 1)
        at = (at + ROWS * U64(self.size)).astype(np.int64).ravel()
        if times is not None:
            times = np.concatenate((times, times, times))
        self.number += np.bincount(at, times, 3 * self.size).astype(np.int64)
        np.bitwise_xor.at(self.keys, at, np.concatenate((keys, keys, keys)))
        np.bitwise_xor.at(self.checks, at, np.concatenate((h[3], h[3], h[3])))

    def minus(self, other: Sketch) -> Sketch:
        out = Sketch(self.size)
        out.number = self.number - other.number
        out.keys = self.keys ^ other.keys
        out.checks = self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray] | None:
        """The digests with positive and with negative number, or none if some stay hidden."""
        if self.size > 1 and self.keys.all():
            return None  # too full by far
        keys, signs = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        while True:
            pure = np.flatnonzero(np.abs(self.number) == 1)
            found = self.keys[pure]
            h = hashed(found)
            true = np.flatnonzero(h[3] == self.checks[pure])
            if not len(true):
                break
            # one key may be alone in up to three cells
            order = true[np.argsort(found[true])]
            found = found[order]
            new = np.ones(len(order), bool)
            np.not_equal(found[1:], found[:-1], out=new[1:])
            order, found = order[new], found[new]
            sign = self.number[pure[order]]
            self.put(found, h[:, order], -sign)
            keys.append(found)
            signs.append(sign)
        if self.number.any() or self.keys.any():
            return None
        keys, signs = np.concatenate(keys), np.concatenate(signs)
        return keys[signs > 0], keys[signs < 0]

    def text(self, n: int) -> str:
        cells = self.number.astype("<i4").tobytes() + self.keys.astype("<u8").tobytes()
        cells += self.checks.astype("<u4").tobytes()
        return f"{n}:" + base64.b64encode(cells).decode()


class Paragraphs:
    """The digests of a text and their sketches, made when they are asked for."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.h = keys, hashed(keys)
        self.sketches: dict[int, Sketch] = {}

    def __len__(self) -> int:
        return len(self.keys)

    def sketch(self, size: int) -> Sketch:
        if size not in self.sketches:
            self.sketches[size] = Sketch(size)
            self.sketches[size].put(self.keys, self.h)
        return self.sketches[size]

    def fingerprint(self) -> str:
        return self.sketch(SMALLEST).text(len(self))


def differing(a: Paragraphs, b: Paragraphs) -> tuple[np.ndarray, np.ndarray]:
    """The digests that only ``a`` and only ``b`` has, from sketches that grow until they can
    be peeled."""
    size = SMALLEST
    while 2 * size < abs(len(a) - len(b)):
        size *= GROW
    while True:
        found = a.sketch(size).minus(b.sketch(size)).peel()
        if found is not None:
            return found
        size *= GROW


def likeness(a: Paragraphs, b: Paragraphs) -> float:
    """Shared paragraphs over all paragraphs of two texts; 1 if neither has any."""
    only_a, only_b = differing(a, b)
    either = len(a) + len(only_b)
    return (len(a) - len(only_a)) / either if either else 1.0


def compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of bucket and id; the last row of a bucket is a copy of the next one's
    first, marked ``copy``."""
    held = None  # the row that waits for its next: bucket, id, text, digests
    rows: list[tuple] = []

    def batch():
        names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        names += ("near_edited", "near_next")
        kinds += (pa.float64(), pa.float64())
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, list(names))

    for got in batches:
        names = ("bucket", "copy", "doc_id", "text")
        for bucket, copy, doc_id, text in zip(*(got[c].to_pylist() for c in names), strict=True):
            text = text or ""
            own = Paragraphs(digests(text))
            if held and held[0] == bucket:
                _, before, old, keys = held
                n = len(old)
                edited = old[: n - n // 4] + text[: n // 4]
                new = Paragraphs(digests(edited))
                rows.append(
                    (
                        before,
                        n,
                        hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(),
                        keys.fingerprint(),
                        new.fingerprint(),
                        likeness(keys, new),
                        likeness(keys, own),
                    )
                )
            held = None if copy else (bucket, doc_id, text, own)
        if rows:
            yield batch()
            rows = []


def fingerprint(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bytes_per_bucket: int = 16 << 20,
) -> DataFrame:
    """Fingerprints of texts and of their edited versions: ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``.

    A text is a set of paragraph digests (lines, sentences in them; overlong ones are cut after
    words that a hash picks; repeated ones are counted apart). Its fingerprint is their number
    and a sketch of 24 cells. Two versions are compared by subtracting sketches and peeling out
    the digests that differ; if that fails, both are built four times as large. The likeness is
    the share of common paragraphs. The edited version replaces the last floor(n/4) code points
    by the first of the next document, by ascending id, which after the last is the first.

    Ids are whole numbers; null ids come first, rows with one id follow by the hash of their
    text. Null texts are empty; two texts without paragraphs are alike. An empty table gives no
    rows, a single row is its own next, and columns other than the two named are not read.

    Rows move once, into id ranges of about ``bytes_per_bucket`` of text, whose ends come from
    approximate quantiles; the first row of each range is also sent to the range before it.
    What the driver sees is one id per range.
    """
    spark = ready(df.sparkSession)
    least = -(1 << 63)
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("place"),
        F.col(text_col).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = ceil_div(size, bytes_per_bucket) or 1
    cuts = [i / n for i in range(1, n)]
    ends = np.unique(
        np.array(rows.approxQuantile("place", cuts, 0.1 / n) if cuts else [], np.float64)
    ).astype(np.int64)

    def bucket_of(place: np.ndarray) -> np.ndarray:
        return np.searchsorted(ends, place, "right")

    @F.pandas_udf("int")
    def bucket(place: pd.Series) -> pd.Series:
        return pd.Series(bucket_of(place.to_numpy()).astype(np.int32))

    heads = rows.select("place", bucket("place").alias("bucket")).groupBy("bucket")
    heads = sorted((r[0], r[1]) for r in heads.agg(F.min("place")).collect())
    before = {place: heads[i - 1][0] for i, (_, place) in enumerate(heads)}

    # A head also goes to the bucket before its own, round the end.
    @F.pandas_udf("array<int>")
    def places(place: pd.Series) -> pd.Series:
        own = bucket_of(place.to_numpy()).tolist()
        return pd.Series(
            [[b, before[p]] if p in before else [b] for p, b in zip(place, own, strict=True)]
        )

    dealt = rows.select(
        "doc_id", "place", "text", F.posexplode(places("place")).alias("copy", "bucket")
    )
    return (
        dealt.repartition(max(n, 1), "bucket")
        .sortWithinPartitions("bucket", "copy", "place", F.xxhash64("text"))
        .select("bucket", "copy", "doc_id", "text")
        .mapInArrow(
            compare_neighbours,
            "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double",
        )
    )
