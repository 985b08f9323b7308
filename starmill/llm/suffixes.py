"""Removal of repeated passages by suffix arrays: Burrows-Wheeler transforms whose prefix
intervals are extended backward, level by level, up to the minimum length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ceil_div, ready
from starmill.session import stage

LENGTH = 50
GRAM = 12
#: A byte that UTF-8 never uses; it stands between texts.
BETWEEN = 0xFF
U64 = np.uint64
FACTORS = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
LAST = (1 << 63) - 1


# --- equal windows by suffix array ---------------------------------------------------------


def order_of(key: np.ndarray, bits: int) -> np.ndarray:
    """Indices of keys of so many bits in their order; where both fit into 64 bits, each index is
    sorted with its key, which is several times faster than to sort indices by their keys."""
    place = max(1, (len(key) - 1).bit_length())
    if bits + place > 64:
        return np.argsort(key)
    ordered = np.sort((key << U64(place)) | np.arange(len(key), dtype=U64))
    return (ordered & U64((1 << place) - 1)).astype(np.int64)


def first_bytes(text: np.ndarray) -> tuple[np.ndarray, int, int]:
    """A number for each rotation that orders them by their first bytes, how many bits a byte
    takes in it and how many bytes it holds. With the number of a place it fits into 64 bits."""
    n = len(text)
    used = np.flatnonzero(np.bincount(text, minlength=256))
    code = np.zeros(256, U64)
    code[used] = np.arange(len(used), dtype=U64)
    bits = max(1, (len(used) - 1).bit_length())
    step = max(1, (64 - max(1, (n - 1).bit_length())) // bits)
    round_ = code[np.concatenate([text] + [text] * ceil_div(step, n))[: n + step]]
    key = round_[:n].copy()
    for i in range(1, step):
        key <<= U64(bits)
        key |= round_[i : i + n]
    return key, bits, step


def sorted_rotations(key: np.ndarray, bits: int, step: int, depth: int) -> np.ndarray:
    """Starts of all rotations, in order of their first ``depth`` bytes at least; ``key`` gives
    their order by the first ``step`` bytes."""
    n = len(key)
    place = max(1, (n - 1).bit_length())
    while True:
        order = order_of(key, bits)
        ordered = key[order]
        new = np.r_[False, ordered[1:] != ordered[:-1]]
        if step >= depth or new.sum() == n - 1:
            return order
        rank = np.empty(n, U64)
        rank[order] = np.cumsum(new).astype(U64)
        key = (rank << U64(place)) | np.roll(rank, -step)
        bits = 2 * place
        step *= 2


def short_prefixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rotations, and where in it a rotation shares fewer than ``length`` bytes
    with the one before it.

    Breadth first: level l holds intervals of rotations that start with one string of l bytes.
    Going back by the Burrows-Wheeler transform from an interval leads to the intervals of the
    strings one byte longer; the end of one that is new tells a common prefix of l bytes. Only
    such intervals are extended, and the levels end at the minimum length. The first level is
    that of the few bytes that the sort begins with; its intervals are those of equal numbers.
    """
    n = len(text)
    key, bits, step = first_bytes(text)
    order = sorted_rotations(key, bits * step, step, length)
    before = text[order - 1]
    back = np.empty(n, np.int64)
    back[np.argsort(before, kind="stable")] = np.arange(n)
    first_byte = text[order]
    level = min(step, length)
    ordered = key[order] >> U64(bits * (step - level))
    short = np.ones(n + 1, bool)
    short[1:n] = ordered[1:] != ordered[:-1]
    ordered >>= U64(bits)
    fresh = short.copy()
    fresh[1:n] &= ordered[1:] == ordered[:-1]
    fresh[n] = False
    del key, ordered
    low = np.flatnonzero(short[:n])
    high = np.r_[low[1:], n] - 1
    low, high = low[fresh[high + 1]], high[fresh[high + 1]]
    owner = np.full(n, -1, np.int32)  # of each rotation reached at a level, the interval it is from
    for _ in range(length - level):
        if not len(low):
            break
        sizes = high - low + 1
        which = np.repeat(np.arange(len(low), dtype=np.int32), sizes)
        to = back[places_of(low, sizes)]
        owner[to] = which
        to.sort()
        which, byte = owner[to], first_byte[to]
        new = (to[1:] != to[:-1] + 1) | (which[1:] != which[:-1]) | (byte[1:] != byte[:-1])
        first = np.flatnonzero(np.r_[True, new])
        low, high = to[first], to[np.r_[first[1:] - 1, len(to) - 1]]
        fresh = ~short[high + 1]
        low, high = low[fresh], high[fresh]
        short[high + 1] = True
    return order, short[:n]


def least_ranks(segments: list[bytes], ranks: np.ndarray, length: int) -> np.ndarray:
    """For every string of ``length`` bytes in the segments, one after the other, the least rank
    of a segment that holds it."""
    sizes = np.fromiter(map(len, segments), np.int64, len(segments))
    text = np.frombuffer(bytes([BETWEEN]).join(segments) + bytes([BETWEEN]), np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    windows = sizes - length + 1
    place = places_of(starts, windows)
    order, short = short_prefixes(text, length)
    group = np.empty(len(text), np.int64)
    group[order] = np.cumsum(short) - 1
    group = group[place]
    least = np.full(int(short.sum()), LAST, np.int64)
    np.minimum.at(least, group, np.repeat(ranks, windows))
    return least[group]


# --- dealing windows to buckets ------------------------------------------------------------


def load(buffer: np.ndarray, n: int, kind: str, offset: int = 0) -> np.ndarray:
    """The number that starts at each of n bytes."""
    return np.ndarray((n,), kind, buffer, offset=offset, strides=(1,)).astype(U64)


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(32))) * FACTORS[2]
    return h ^ (h >> U64(29))


class Batch:
    """Texts of a batch laid end to end, their windows cut into runs.

    A window's key is the least hash of its 12-byte strings, so equal windows have equal keys.
    A run is a stretch of windows of one text with one key.
    """

    def __init__(self, texts: list[str | None], length: int):
        self.length = length
        raw = [(t or "").encode("utf-8", "replace") for t in texts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        self.start = np.cumsum(sizes + 1) - sizes - 1
        self.bytes = np.frombuffer(bytes([BETWEEN]).join(raw) + bytes(16), np.uint8)
        n = len(self.bytes) - 16
        self.low = self.high = np.zeros(0, np.int64)
        self.key, self.doc = np.zeros(0, U64), np.zeros(0, np.int64)
        if n < length:
            return
        grams = n - GRAM + 1
        h = load(self.bytes, grams, "<u8") * FACTORS[0]
        h ^= load(self.bytes, grams, "<u4", 8) * FACTORS[1]
        key, span = scramble(h), 1
        while 2 * span <= length - GRAM + 1:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        rest = length - GRAM + 1 - span
        if rest:
            key = np.minimum(key[:-rest], key[rest:])
        whole = np.zeros(len(key) + 1, bool)
        for a, size in zip(self.start.tolist(), sizes.tolist(), strict=True):
            if size >= length:
                whole[a : a + size - length + 1] = True
        same = np.r_[False, key[1:] == key[:-1]] & np.r_[False, whole[: len(key) - 1]]
        self.low = np.flatnonzero(whole[:-1] & ~same)
        ends = np.flatnonzero(whole[:-1] & ~np.r_[same[1:] & whole[1:-1], False])
        self.high = ends + 1
        self.key = key[self.low]
        self.doc = np.searchsorted(self.start, self.low, "right") - 1

    def pieces(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        at = np.repeat((low - np.cumsum(size) + size).astype(np.int32), size)
        at += np.arange(len(at), dtype=np.int32)
        return self.bytes[at]


def planes(numbers: np.ndarray, width: int) -> bytes:
    """The low bytes of numbers, byte by byte, which compresses well."""
    return np.ascontiguousarray(
        numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    ).tobytes()


def from_planes(raw: memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width).reshape(width, n).T
    return out.reshape(-1).view("<i8")


#: Fields of a run besides its bytes, and how many bytes each takes.
FIELDS = (("doc", 4), ("position", 5), ("windows", 4))


def cells_of(key: np.ndarray, cells: int) -> np.ndarray:
    return ((scramble(key) >> U64(20)) % U64(cells)).astype(np.int64)


def cell_bytes(length: int, cells: int):
    """Bytes of the runs per cell; a cell holds all runs of the keys that hash to it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            batch = Batch(got["text"].to_pylist(), length)
            found, place = np.unique(cells_of(batch.key, cells), return_inverse=True)
            size = np.bincount(place, batch.high - batch.low + length - 1, len(found))
            yield pa.RecordBatch.from_pydict(
                {"cell": pa.array(found, pa.int64()), "n": pa.array(size.astype(np.int64))}
            )

    return count


def deal_runs(shared, length: int, buckets: int, cells: int):
    """One row per bucket and batch: all runs of the batch whose key falls into the bucket."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        squeeze = zstandard.ZstdCompressor(level=1)
        for got in batches:
            batch = Batch(got["text"].to_pylist(), length)
            plain = ~np.isin(cells_of(batch.key, cells), hot)
            if not plain.any():
                continue
            low, high = batch.low[plain], batch.high[plain]
            doc = batch.doc[plain]
            bucket = (scramble(batch.key[plain]) >> U64(8)) % U64(buckets)
            order = np.argsort(bucket, kind="stable")
            low, high, doc, bucket = (x[order] for x in (low, high, doc, bucket))
            size = high - low + length - 1
            text = batch.pieces(low, size)
            cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            ends = np.r_[0, np.cumsum(size)]
            row, rank = (got[c].to_numpy(zero_copy_only=False) for c in ("row", "rank"))
            numbers, payloads = [], []
            for a, b in zip(cut, np.r_[cut[1:], len(low)], strict=True):
                docs, place = np.unique(doc[a:b], return_inverse=True)
                fields = {
                    "doc": np.diff(place, prepend=0),
                    "position": low[a:b] - batch.start[doc[a:b]],
                    "windows": high[a:b] - low[a:b],
                }
                raw = [
                    np.array([b - a, len(docs)], "<i8").tobytes(),
                    planes(np.diff(row[docs], prepend=0), 8),
                    planes(rank[docs] - row[docs], 8),
                    *(planes(fields[name], width) for name, width in FIELDS),
                    text[ends[a] : ends[b]].tobytes(),
                ]
                numbers.append(int(bucket[a]))
                payloads.append(squeeze.compress(b"".join(raw)))
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array(numbers, pa.int64()), "runs": pa.array(payloads, pa.binary())}
            )

    return deal


def unpack(payload: bytes) -> tuple[dict[str, np.ndarray], memoryview]:
    raw = memoryview(zstandard.ZstdDecompressor().decompress(payload))
    n, docs = np.frombuffer(raw, "<i8", 2)
    at = 16
    row = np.cumsum(from_planes(raw[at:], docs, 8))
    at += 8 * docs
    rank = row + from_planes(raw[at:], docs, 8)
    at += 8 * docs
    fields = {}
    for name, width in FIELDS:
        fields[name] = from_planes(raw[at:], n, width)
        at += width * n
    doc = np.cumsum(fields["doc"])
    return fields | {"row": row[doc], "rank": rank[doc]}, raw[at:]


def window_hashes(text: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes at each place: of 8 bytes at all places first, then of
    twice as many from two halves, which may overlap in the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    h = np.ndarray((len(text),), "<u8", padded, strides=(1,)) * FACTORS[0]
    if length < 8:
        h = np.ndarray((len(text),), "<u8", padded, strides=(1,)) & U64((1 << 8 * length) - 1)
    span = 8
    while span < length:
        h ^= h >> U64(29)
        step = min(span, length - span)
        h = h[:-step] * FACTORS[1] + h[step:]
        h *= FACTORS[0]
        span += step
    return scramble(h[place])


def places_of(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ..., counts[0] of them, then those of the next start."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


#: Bits of a place in the tables of hashes that several texts have.
SLOT = 24


def slots(h: np.ndarray, shift: int) -> np.ndarray:
    return ((h >> U64(shift)) & U64((1 << SLOT) - 1)).view(np.int64)


def hopeful(h: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The windows whose hash is there with several ranks, and few others; no others than these
    can repeat across texts. Ranks are numbered from 0, unsigned."""
    bits = U64(max(1, int(rank.max(initial=0)).bit_length()))
    h = h >> bits
    both = h << bits
    both |= rank
    both.sort()
    upper = both >> bits
    several = upper[1:][(upper[1:] == upper[:-1]) & (both[1:] != both[:-1])]
    del both, upper
    out = np.ones(len(h), bool)
    some: np.ndarray | slice = slice(None)
    for shift in (0, 16):
        table = np.zeros(1 << SLOT, bool)
        table[slots(several, shift)] = True
        out[some] = table[slots(h[some], shift)]
        some = np.flatnonzero(out)
    return out


def repeated_starts(length: int):
    """In a bucket, the windows that also start in a text of lower rank: ``row, spans``, where
    spans lists first window and number of windows of each stretch."""

    def find(part: pd.DataFrame) -> pd.DataFrame:
        runs, texts = zip(*map(unpack, part["runs"]), strict=True)
        texts = [np.frombuffer(t, np.uint8) for t in texts]
        hashes = []
        for r, text in zip(runs, texts, strict=True):
            sizes = r["windows"] + length - 1
            place = places_of(np.cumsum(sizes) - sizes, r["windows"])
            hashes.append(window_hashes(text, place, length))
        row, rank, position, windows = (
            np.concatenate([r[c] for r in runs]) for c in ("row", "rank", "position", "windows")
        )
        number = np.unique(rank, return_inverse=True)[1].astype(U64)
        chosen = hopeful(np.concatenate(hashes), np.repeat(number, windows))
        del hashes
        if not chosen.any():
            return no_spans()
        # Of each run what lies between its first and its last hopeful window.
        run = np.repeat(np.arange(len(windows)), windows)[chosen]
        inside = places_of(np.zeros(len(windows), np.int64), windows)[chosen]
        new = np.r_[True, run[1:] != run[:-1]]
        run, low = run[new], inside[new]
        high = inside[np.r_[np.flatnonzero(new)[1:] - 1, len(inside) - 1]] + 1
        sizes = windows + length - 1
        start = np.cumsum(sizes) - sizes
        bounds = np.r_[0, np.cumsum([len(t) for t in texts])]
        source = np.searchsorted(bounds, start[run], "right") - 1
        a = start[run] + low - bounds[source]
        b = a + high - low + length - 1
        number: dict[bytes, int] = {}
        segment = np.array(
            [
                number.setdefault(texts[i][x:y].tobytes(), len(number))
                for i, x, y in zip(source.tolist(), a.tolist(), b.tolist(), strict=True)
            ]
        )
        row, rank, position, windows = row[run], rank[run], position[run] + low, high - low
        own = np.full(len(number), LAST, np.int64)
        np.minimum.at(own, segment, rank)
        least = least_ranks(list(number), own, length)
        size = np.fromiter(map(len, number), np.int64, len(number)) - length + 1
        offset = np.cumsum(size) - size
        run = np.repeat(np.arange(len(segment)), windows)
        repeat = least[places_of(offset[segment], windows)] < rank[run]
        return spans_of(row[run][repeat], places_of(position, windows)[repeat])

    return find


def no_spans() -> pd.DataFrame:
    return pd.DataFrame(
        {"row": pd.Series([], dtype="int64"), "spans": pd.Series([], dtype=object)}
    )


def spans_of(row: np.ndarray, start: np.ndarray) -> pd.DataFrame:
    """Window starts joined to stretches, one list per row."""
    if not len(row):
        return no_spans()
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (start[1:] > start[:-1] + 1)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:] - 1, len(row) - 1]
    pairs = np.stack([start[first], start[last] - start[first] + 1], 1)
    owner = row[first]
    cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    lists = [p.reshape(-1) for p in np.split(pairs, cut[1:])]
    return pd.DataFrame({"row": owner[cut], "spans": pd.Series(lists, dtype=object)})


# --- frequent cells: window by window ------------------------------------------------------


def same_windows(text: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The first of each set of equal windows at the places, the number of its set for every
    window, and the hashes of the first ones. Different windows with one hash are sets of one."""
    h, first, number = np.unique(
        window_hashes(text, place, length), return_index=True, return_inverse=True
    )
    different = np.zeros(len(place), bool)
    for at in range(length):
        different |= text[place + at] != text[place[first[number]] + at]
    odd = np.flatnonzero(different)
    of_odd = h[number[odd]]
    number[odd] = len(first) + np.arange(len(odd))
    return np.r_[first, odd], number, np.r_[h, of_odd]


def deal_windows(shared, length: int, buckets: int, cells: int):
    """Of each batch one row per bucket, with the batch's distinct windows in frequent cells whose
    hash falls into it and their least ranks, and one row of bucket -1 that says where they are."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        squeeze = zstandard.ZstdCompressor(level=1)
        mine = TaskContext.get().partitionId() << 32
        for got in batches:
            batch = Batch(got["text"].to_pylist(), length)
            chosen = np.isin(cells_of(batch.key, cells), hot)
            if not chosen.any():
                continue
            low, doc = batch.low[chosen], batch.doc[chosen]
            windows = batch.high[chosen] - low
            row, rank = (got[c].to_numpy(zero_copy_only=False)[doc] for c in ("row", "rank"))
            place = places_of(low, windows)
            first, number, h = same_windows(batch.bytes, place, length)
            least = np.full(len(first), LAST, np.int64)
            np.minimum.at(least, number, np.repeat(rank, windows))
            where = [
                np.array([len(low), len(place)], "<i8").tobytes(),
                planes(np.diff(row, prepend=0), 8),
                planes(rank - row, 8),
                planes(low - batch.start[doc], 5),
                planes(windows, 4),
                planes(number, 4),
            ]
            numbers, payloads = [-1], [squeeze.compress(b"".join(where))]
            bucket = ((h >> U64(8)) % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0])
            for one in np.split(order, cut[1:]):
                one.sort()
                raw = [
                    np.array([len(one)], "<i8").tobytes(),
                    planes(one, 4),
                    planes(np.diff(least[one], prepend=0), 8),
                    batch.pieces(place[first[one]], np.full(len(one), length)).tobytes(),
                ]
                numbers.append(int(bucket[one[0]]))
                payloads.append(squeeze.compress(b"".join(raw)))
            yield pa.RecordBatch.from_pydict(
                {
                    "batch": pa.array([mine] * len(numbers), pa.int64()),
                    "bucket": pa.array(numbers, pa.int64()),
                    "payload": pa.array(payloads, pa.binary()),
                }
            )
            mine += 1

    return deal


#: Windows that a frequent cells' bucket sorts at once.
LOT = 1 << 15


def later_windows(length: int, most: int = LOT):
    """In a bucket, which windows of a batch also start in a text of lower rank than all the
    batch's texts with them: ``batch, later``, where later lists the windows' numbers."""

    def find(part: pa.Table) -> pa.Table:
        numbers, ranks, texts = [], [], []
        for payload in part["payload"].to_pylist():
            raw = memoryview(zstandard.ZstdDecompressor().decompress(payload))
            n = int(np.frombuffer(raw, "<i8", 1)[0])
            numbers.append(from_planes(raw[8:], n, 4))
            ranks.append(np.cumsum(from_planes(raw[8 + 4 * n :], n, 8)))
            texts.append(np.frombuffer(raw, np.uint8, offset=8 + 12 * n))
        batch = np.repeat(part["batch"].to_numpy(), [len(x) for x in numbers])
        number, rank, text = (np.concatenate(x) for x in (numbers, ranks, texts))
        del numbers, ranks, texts
        h = window_hashes(text, np.arange(len(number)) * length, length)
        some = np.flatnonzero(hopeful(h, np.unique(rank, return_inverse=True)[1].astype(U64)))
        some = some[np.argsort(h[some])]
        h = h[some]
        later = np.zeros(len(number), bool)
        a = 0
        while a < len(some):  # equal windows have one hash and so are in one lot
            b = int(np.searchsorted(h, h[min(a + most, len(some)) - 1], "right"))
            lot = some[a:b]
            found: dict[bytes, int] = {}
            segment = np.array(
                [
                    found.setdefault(text[i : i + length].tobytes(), len(found))
                    for i in (lot * length).tolist()
                ]
            )
            own = np.full(len(found), LAST, np.int64)
            np.minimum.at(own, segment, rank[lot])
            later[lot] = least_ranks(list(found), own, length)[segment] < rank[lot]
            a = b
        batch, number = batch[later], number[later].astype("<i4")
        order = np.argsort(batch, kind="stable")
        found_in, first = np.unique(batch[order], return_index=True)
        lists = np.split(number[order], first[1:]) if len(first) else []
        return pa.table(
            {
                "batch": pa.array(found_in, pa.int64()),
                "later": pa.array([x.tobytes() for x in lists], pa.binary()),
            }
        )

    return find


def starts_of_batch(part: pa.Table) -> pa.Table:
    """The windows of a batch that also start in a text of lower rank, as ``row, spans``."""
    later = part["later"].drop_null().to_pylist()
    raw = memoryview(
        zstandard.ZstdDecompressor().decompress(part["payload"].drop_null().to_pylist()[0])
    )
    runs, n = np.frombuffer(raw, "<i8", 2).tolist()
    at, fields = 16, []
    for width in (8, 8, 5, 4):
        fields.append(from_planes(raw[at:], runs, width))
        at += width * runs
    row, rank, position, windows = fields
    row = np.cumsum(row)
    rank = np.repeat(row + rank, windows)
    number = from_planes(raw[at:], n, 4)
    least = np.full(number.max() + 1, LAST, np.int64)
    np.minimum.at(least, number, rank)
    elsewhere = np.zeros(len(least), bool)
    elsewhere[np.frombuffer(b"".join(later), "<i4")] = True
    repeat = elsewhere[number] | (least[number] < rank)
    found = spans_of(np.repeat(row, windows)[repeat], places_of(position, windows)[repeat])
    return pa.table(
        {
            "row": pa.array(found["row"].to_numpy(), pa.int64()),
            "spans": pa.array(found["spans"].tolist(), pa.list_(pa.int64())),
        }
    )


# --- the operator --------------------------------------------------------------------------


def cut_texts(length: int, carry: bool):
    """Cut the stretches out of the texts; with ``carry``, give the kept text and ``carried``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            sizes, removed, runs, digests, kept_texts = [], [], [], [], []
            lists = pc.fill_null(pc.list_value_length(got["spans"]), 0).to_numpy()
            pairs = got["spans"].flatten()
            ends = np.r_[0, np.cumsum(pc.list_value_length(pairs).to_numpy())]
            ends = ends[np.r_[0, np.cumsum(lists)]].tolist()
            pairs = pairs.flatten().to_numpy()
            for i, text in enumerate(got["text"].to_pylist()):
                raw = (text or "").encode("utf-8", "replace")
                first, windows = pairs[ends[i] : ends[i + 1]].reshape(-1, 2).T
                gone, cuts, kept = 0, 0, raw
                if len(first):
                    steps = np.bincount(first, minlength=len(raw) + 1)
                    steps -= np.bincount(first + windows + length - 1, minlength=len(raw) + 1)
                    cut_out = np.cumsum(steps)[:-1] > 0
                    kept = np.frombuffer(raw, np.uint8)[~cut_out].tobytes()
                    gone = len(raw) - len(kept)
                    cuts = int(cut_out[0]) + int((cut_out[1:] > cut_out[:-1]).sum())
                sizes.append(len(raw))
                removed.append(gone)
                runs.append(cuts)
                digests.append(hashlib.sha256(kept).hexdigest())
                if carry:
                    kept_texts.append(kept.decode("utf-8", "ignore") if text is not None else None)
            columns = {
                "doc_id": got["doc_id"],
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(runs, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
            }
            if carry:
                columns["kept"] = pa.array(kept_texts, pa.string())
                columns["carried"] = got["carried"]
            yield pa.RecordBatch.from_pydict(columns)

    return cut


def numbered(df: DataFrame, id_col: str, text_col: str, carry: Sequence[str]) -> DataFrame:
    """``doc_id, row, rank, text, carried``: rank orders texts, null ids last; row tells rows
    apart; carried holds other columns."""
    carried = F.struct(F.lit(0).alias("_"), *carry).alias("carried")
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), carried)
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    ids = rows.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("n > 1 OR doc_id IS NULL").isEmpty():
        return rows.select("doc_id", rank.alias("row"), rank.alias("rank"), "text", "carried")
    row = F.monotonically_increasing_id().alias("row")
    return stage(
        rows.select("doc_id", row, rank.alias("rank"), "text", "carried"), "passage-rows"
    )


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    bytes_per_bucket: int = 4 << 20,
    share: int = 2000,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts in a document
    with a smaller id: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``. If ``carry`` lists
    columns, also the ``kept`` text, without characters of which only a part is left, and those
    columns in a struct ``carried``.

    Strings are judged on the input and never cross documents. Null texts are empty (``kept``
    stays null); ids are whole numbers, null ids rank last and, like rows with one id, are not
    smaller than each other; repeated rows give repeated results; an empty table gives no rows;
    columns other than the two named are not read.

    Windows go to buckets by the least hash of their 12-byte strings, stretches of windows with
    one key travelling as one run of bytes, so equal windows meet. A bucket drops windows whose
    hash one document only has, and sorts the rotations of the others' distinct bytes; intervals
    of common prefixes then tell which windows are equal. Buckets hold about
    ``bytes_per_bucket`` of text. Keys are also counted in 64 cells per bucket. Cells with more
    than a quarter of ``bytes_per_bucket``, or in small tables half of 1/``share`` of all runs'
    bytes, do not go to buckets as runs: their windows, equal ones of a batch once with their least
    rank, go packed to buckets by a hash of the window, so that however many texts share a passage,
    each batch sends it once. What a bucket's intervals tell goes back, packed too, to the batches,
    which know where their windows are.
    """
    spark = ready(df.sparkSession)
    docs = numbered(df, id_col, text_col, carry or ())
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = ceil_div(size, bytes_per_bucket) or 1
    texts = docs.select("row", "rank", "text").where(F.octet_length("text") >= length)
    cells = max(64 * buckets, 8 * share)
    counts = stage(
        texts.select("text")
        .mapInArrow(cell_bytes(length, cells), "cell long, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n")),
        "passage-cells",
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = min(total / (2 * share), bytes_per_bucket / 4)
    hot = counts.where(F.col("n") >= least).select("cell", "n").collect()
    shared = spark.sparkContext.broadcast(np.array([r[0] for r in hot], np.int64))
    spans = stage(
        texts.mapInArrow(deal_runs(shared, length, buckets, cells), "bucket long, runs binary")
        .repartition(buckets, "bucket")
        .groupBy("bucket")
        .applyInPandas(repeated_starts(length), "row long, spans array<long>"),
        "passage-spans",
    )
    if hot:
        parts = ceil_div(sum(r[1] for r in hot), ceil_div(bytes_per_bucket, 4))
        segments = stage(
            texts.mapInArrow(
                deal_windows(shared, length, parts, cells),
                "batch long, bucket long, payload binary",
            ),
            "passage-segments",
        )
        later = (
            segments.where("bucket >= 0")
            .repartition(parts, "bucket")
            .groupBy("bucket")
            .applyInArrow(later_windows(length), "batch long, later binary")
        )
        places = segments.where("bucket < 0").select(
            "batch", F.lit(None).cast("binary").alias("later"), "payload"
        )
        more = (
            later.withColumn("payload", F.lit(None).cast("binary"))
            .unionByName(places)
            .repartition(parts, "batch")
            .groupBy("batch")
            .applyInArrow(starts_of_batch, "row long, spans array<long>")
        )
        spans = spans.unionByName(stage(more, "passage-spans"))
    of_row = spans.groupBy("row").agg(F.collect_list("spans").alias("spans"))
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    # Spans that repeat take far less room in files, by which they are sized, than in a broadcast.
    joined = docs.join(of_row.hint("merge"), "row", "left")
    joined = joined.select("doc_id", "text", "spans", "carried")
    if carry is None:
        joined = joined.drop("carried")
    else:
        schema += f", kept string, carried {docs.schema['carried'].dataType.simpleString()}"
    return joined.mapInArrow(cut_texts(length, carry is not None), schema)
