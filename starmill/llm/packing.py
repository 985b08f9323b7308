"""Packing tokens into sequences: first-fit decreasing inside randomised groups of documents."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ceil_div, ready

#: Fixed value: how byte-level tokenizers cut text before they merge bytes.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Characters outside these blocks may be letters to one library's tables and not to another's.
RARE = re.compile("[^\u0000-\u02af\u0370-\u03ff\u0400-\u04ff\u2000-\u206f\u20a0-\u20ac"
                  "\u2100-\u26ff\u3000-\u30ff\u4e00-\u9fa5]")
_encoders: dict[tuple[int, bool], Encoder] = {}


def merge_ranks(definition: dict) -> dict[bytes, int] | None:
    """The ids of a tokenizer's byte strings, if it is a plain byte-level one whose merges
    stand in the order of the ids they make; then ids are ranks."""
    model, cut = definition["model"], definition.get("pre_tokenizer") or {}
    plain = model["type"] == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex")
    odd = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix")]
    odd += [model.get(k) for k in ("end_of_word_suffix", "byte_fallback", "ignore_merges")]
    odd += [definition.get("normalizer"), cut.get("add_prefix_space")]
    if not plain or any(odd):
        return None
    vocab = model["vocab"]
    made = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    if len(vocab) != 256 + len(made) or made != list(range(256, 256 + len(made))):
        return None
    # A printable byte stands for itself, the others for the characters from 256 on.
    itself = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in itself}
    byte |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(itself)))}
    return {bytes(map(byte.__getitem__, token)): n for token, n in vocab.items()}


class Encoder:
    """The ids that a tokenizer's definition gives, from the faster of two libraries where both
    are known to agree. With ``added``, the string of an added token in a text is that token, as
    by the tokenizer's default; else it is text like any other."""

    def __init__(self, definition: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = not added
        self.fast = None
        parts = json.loads(definition)
        #: Strings that the tokenizer takes out of a text before it cuts the rest.
        self.added = [t["content"] for t in parts.get("added_tokens") or ()] if added else []
        ranks = merge_ranks(parts)
        if ranks:
            from tiktoken import Encoding

            self.fast = Encoding(
                "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    @classmethod
    def of(cls, definition: str, added: bool = False) -> Encoder:
        """One encoder per Python worker and definition."""
        key = zlib.crc32(definition.encode()), added
        if key not in _encoders:
            _encoders[key] = cls(definition, added)
        return _encoders[key]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit numbers."""
        plain = text.isascii() or not RARE.search(text)
        if self.fast and plain and not any(t in text for t in self.added):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()


def cut_pieces(definition, capacity: int, with_ids: bool, added: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(definition.value, added)
        for batch in batches:
            row, start, length, crc, tokens, ids = [], [], [], [], [], []
            for i, text in enumerate(batch["text"].to_pylist()):
                got = encoder.encode(text or "") + b"\0\0\0\0"
                n = len(got) // 4
                for at in range(0, n, capacity):
                    piece = got[4 * at : 4 * (at + capacity)]
                    row.append(i)
                    start.append(at)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    tokens.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<u4").astype(np.int32))
            columns = {
                "doc_id": batch["doc_id"].take(pa.array(row, pa.int64())),
                **{
                    name: pa.array(values, pa.int64())
                    for name, values in (
                        ("start", start),
                        ("length", length),
                        ("ids_crc32", crc),
                        ("doc_tokens", tokens),
                    )
                },
            }
            if with_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return cut


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each length, given from the longest down. A tournament tree
    over the bins' free room leads to the first bin with enough of it."""
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, size in enumerate(lengths.tolist()):
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < size:
                at += 1
        bins[i], offsets[i] = at - leaves, capacity - room[at]
        room[at] -= size
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
    return bins, offsets


def pack_group(capacity: int):
    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(
            ["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True]
        )
        bins, offsets = first_fit_decreasing(part["length"].to_numpy(), capacity)
        return part.assign(sequence_id=part["group"] * (1 << 32) + bins, offset=offsets).drop(
            columns="group"
        )

    return pack


def pack(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    docs_per_group: int = 8192,
    seed: int = 5,
    with_ids: bool = False,
    added: bool = False,
) -> DataFrame:
    """Pieces of documents placed into sequences of at most ``capacity`` ids: ``doc_id, start,
    length, ids_crc32, doc_tokens, sequence_id, offset`` and, on request, ``ids``.

    A document is its text's ids and a final 0; with ``added``, the string of an added token
    inside a text is that token, as by the tokenizer's default, else it is plain text; a null text has only that. It is cut into pieces
    of full capacity and a rest. Documents are dealt into groups of about ``docs_per_group`` by
    a seeded hash of the id (null ids by position), and each group is packed on its own by
    first-fit decreasing, so a group's padding is that of its last sequences. Repeated rows are
    documents of their own. An empty table gives no rows; columns other than the two named are
    not read. The tokenizer's definition is read once, by the driver, and broadcast.
    """
    spark = ready(df.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    schema += ", ids array<int>" if with_ids else ""
    groups = ceil_div(df.count(), docs_per_group) or 1
    pieces = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        cut_pieces(definition, capacity, with_ids, added), schema
    )
    place = F.xxhash64(F.coalesce("doc_id", F.monotonically_increasing_id()), F.lit(seed))
    return (
        pieces.withColumn("group", F.pmod(place, F.lit(groups)))
        .groupBy("group")
        .applyInPandas(pack_group(capacity), schema + ", sequence_id long, offset long")
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """The ids of each sequence, from pieces packed ``with_ids``: ``sequence_id, ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )
