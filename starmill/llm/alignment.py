"""Which tokens of two tokenizers share bytes: an associative monoid of text fragments.

A fragment of a text is an open prefix, closed groups and an open suffix. A text may be cut before
a blank that follows a character other than white space: no token of either tokenizer reaches over
such a place. Up to its first cut a fragment is open, as what stands there depends on the text
before; from its last cut on likewise. What lies between is encoded, and closed into groups of
tokens that end at the same bytes. Composing two fragments joins the open suffix of one with the
open prefix of the other and closes what has become whole, so fragments of one text may be
composed in any grouping.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ready
from starmill.llm.packing import RARE, Encoder
from starmill.session import stage

#: Where a text may be cut: at a blank after a character that is no white space.
CUT = re.compile(r"(?<=\S) ")
#: Present if some blank of the text is no cut.
KEPT_BLANK = re.compile(r"(?:\A|\s) ")
#: Words that are kept encoded in a worker, and the longest of them.
WORDS_KEPT = 250_000
LONGEST_KEPT = 200
#: Characters of texts that are worked on at once.
CHARS_AT_ONCE = 1 << 20
#: Links that are held at once while id pairs are counted.
LINKS_AT_ONCE = 1_000_000
BLANK = "▁"  # fixed value: how pieces write a blank
FRAME = "row long, doc_id {kind}, part int"
FRAGMENT = "prefix string, cut boolean, sound boolean, a binary, b binary, na binary, nb binary, suffix string"
FIELDS = ["prefix", "cut", "sound", "a", "b", "na", "nb", "suffix"]


# -- tokenizers ------------------------------------------------------------------------------


def byte_level_tokens(definition: str) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer; empty for ids without any."""
    vocab = json.loads(definition)["model"]["vocab"]
    # A printable byte stands for itself, the others for the characters from 256 on.
    itself = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in itself}
    byte |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(itself)))}
    out = [b""] * (max(vocab.values()) + 1)
    for token, n in vocab.items():
        if all(c in byte for c in token):
            out[n] = bytes(byte[c] for c in token)
    return out


def piece_tokens(pieces) -> list[bytes]:
    """The bytes of each piece: its UTF-8 with blanks for their sign, or the byte it names."""
    out = []
    for i in range(pieces.get_piece_size()):
        name = pieces.id_to_piece(i)
        out.append(bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.encode())
    return [token.replace(BLANK.encode(), b" ") for token in out]


def ragged(offsets: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places in a flat array of the rows ``chosen``, row after row."""
    sizes = offsets[chosen + 1] - offsets[chosen]
    before = np.cumsum(sizes) - sizes
    return np.repeat(offsets[chosen] - before, sizes) + np.arange(sizes.sum())


@dataclass
class Closed:
    """Groups of tokens: ids of both tokenizers and how many of them each group has. Not
    ``sound`` if the bytes of some tokens are not those of the text."""

    a: np.ndarray
    b: np.ndarray
    na: np.ndarray
    nb: np.ndarray
    sound: bool = True

    @classmethod
    def empty(cls) -> Closed:
        return cls(*[np.zeros(0, np.uint32)] * 4)

    @classmethod
    def joined(cls, parts: list[Closed]) -> Closed:
        if len(parts) == 1:
            return parts[0]
        names = ("a", "b", "na", "nb")
        arrays = [np.concatenate([getattr(p, n) for p in parts]) for n in names]
        return cls(*arrays, all(p.sound for p in parts))


class Aligner:
    """Both tokenizers of a worker, and the groups of the words it has met. Between two cuts
    tokens do not depend on what stands around, so a word is encoded once."""

    _made: dict[int, Aligner] = {}

    def __init__(self, definition: str, model: bytes):
        import sentencepiece

        self.first = Encoder.of(definition)
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.first_bytes = byte_level_tokens(definition)
        self.second_bytes = piece_tokens(self.second)
        self.n_second = len(self.second_bytes)
        self.first_size = np.array([len(t) for t in self.first_bytes], np.int64)
        self.second_size = np.array([len(t) for t in self.second_bytes], np.int64)
        # The library gives no piece for an empty text, but one for the blank before it.
        self.lone_blank = [self.second.piece_to_id(BLANK)]
        # A blank inside a piece, after something else, would reach over a cut.
        self.cuttable = not any(b" " in token.lstrip(b" ") for token in self.second_bytes)
        self.forget()

    @classmethod
    def of(cls, definition: str, model: bytes) -> Aligner:
        key = zlib.crc32(model, zlib.crc32(definition.encode()))
        if key not in cls._made:
            cls._made[key] = cls(definition, model)
        return cls._made[key]

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sound = np.zeros(0, bool)
        self.flat = Closed.empty()
        self.off = [np.zeros(1, np.int64) for _ in range(3)]

    def words(self, text: str) -> list[str]:
        """The text between cuts, without the blanks at them."""
        if not self.cuttable:
            return [text]
        return CUT.split(text) if KEPT_BLANK.search(text) else text.split(" ")

    def encode_each(self, words: list[str]) -> tuple[list[np.ndarray], list[list[int]], np.ndarray]:
        """Ids of both for " " + word, for each word by itself, and which words are sound; the
        others get no ids."""
        a_ids = [np.frombuffer(self.first.encode(" " + w), "<u4") for w in words]
        b_ids = self.second.encode(words, num_threads=1)
        b_ids = [ids if w else self.lone_blank for w, ids in zip(words, b_ids, strict=True)]
        fits = np.ones(len(words), bool)
        for i, w in enumerate(words):
            want = b" " + w.encode()
            fits[i] = (
                b"".join([self.first_bytes[n] for n in a_ids[i].tolist()]) == want
                and b"".join([self.second_bytes[n] for n in b_ids[i]]) == want
            )
            if not fits[i]:
                a_ids[i], b_ids[i] = a_ids[i][:0], []
        return a_ids, b_ids, fits

    def align(self, words: list[str], together: bool) -> tuple[Closed, np.ndarray, list]:
        """Groups of " " + word for each word; which words are sound; and where the ids of A,
        those of B and the groups of each word begin. Words that are ``plain`` may be encoded
        ``together``, as one text that has a cut between any two."""
        if together:
            text = " ".join(words)
            a = np.frombuffer(self.first.encode(" " + text), "<u4").astype(np.int64)
            b_ids = self.second.encode(text)
            want = b" " + text.encode()
            if (
                b"".join([self.first_bytes[n] for n in a.tolist()]) != want
                or b"".join([self.second_bytes[n] for n in b_ids]) != want
            ):
                return self.align(words, False)
            b, fits = np.array(b_ids, np.int64), np.ones(len(words), bool)
            last = np.cumsum([len(w) + 1 if w.isascii() else len(w.encode()) + 1 for w in words])
            a_end, b_end = np.cumsum(self.first_size[a]), np.cumsum(self.second_size[b])
            a_off = np.concatenate([[0], np.searchsorted(a_end, last) + 1])
            b_off = np.concatenate([[0], np.searchsorted(b_end, last) + 1])
        else:
            a_ids, b_ids, fits = self.encode_each(words)
            a = np.concatenate(a_ids).astype(np.int64)
            b = np.array([n for ids in b_ids for n in ids], np.int64)
            a_off = np.concatenate([[0], np.cumsum([len(x) for x in a_ids])])
            b_off = np.concatenate([[0], np.cumsum([len(x) for x in b_ids])])
            a_end, b_end = np.cumsum(self.first_size[a]), np.cumsum(self.second_size[b])
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        a_at = np.searchsorted(a_end, ends) + 1
        b_at = np.searchsorted(b_end, ends) + 1
        groups = Closed(
            a.astype(np.uint32),
            b.astype(np.uint32),
            np.diff(a_at, prepend=0).astype(np.uint32),
            np.diff(b_at, prepend=0).astype(np.uint32),
        )
        g_off = np.concatenate([[0], np.searchsorted(a_at, a_off[1:], side="right")])
        return groups, fits, [a_off, b_off, g_off]

    def plain(self, word: str) -> bool:
        """Whether a blank after the word is a cut and both libraries take it as it is."""
        return (
            self.cuttable
            and bool(word)
            and not word[-1].isspace()
            and (word.isascii() or (BLANK not in word and not RARE.search(word)))
        )

    def learn(self, words: list[str]) -> None:
        sorts = [[w for w in words if self.plain(w)], [w for w in words if not self.plain(w)]]
        for chosen, together in zip(sorts, (True, False), strict=True):
            if not chosen:
                continue
            got, fits, offs = self.align(chosen, together)
            self.known.update(zip(chosen, range(len(self.known), len(self.known) + len(chosen))))
            self.flat = Closed.joined([self.flat, got])
            self.sound = np.concatenate([self.sound, fits])
            self.off = [
                np.concatenate([old, old[-1] + new[1:]])
                for old, new in zip(self.off, offs, strict=True)
            ]

    def close(self, texts: list[str]) -> list[Closed]:
        """The groups of " " + text for each text."""
        out, held, chars = [], [], 0
        for text in texts:
            held.append(text)
            chars += len(text)
            if chars > CHARS_AT_ONCE:
                out += self.close_few(held)
                held, chars = [], 0
        return out + self.close_few(held)

    def close_few(self, texts: list[str]) -> list[Closed]:
        if not texts:
            return []
        if len(self.known) > WORDS_KEPT:
            self.forget()
        split = [self.words(text) for text in texts]
        new = set().union(*split)
        new -= self.known.keys()
        long = {w for w in new if len(w) > LONGEST_KEPT}
        new -= long
        if new:
            self.learn(sorted(new))
        runs, pieces = [], []  # runs of kept words; texts as numbers of runs and long words
        for words in split:
            if not long or long.isdisjoint(words):
                pieces.append([len(runs)])
                runs.append(words)
                continue
            pieces.append([])
            run: list[str] = []
            for w in [*words, None]:
                if w is None or w in long:
                    if run:
                        pieces[-1].append(len(runs))
                        runs.append(run)
                    if w is not None:
                        pieces[-1].append(w)
                    run = []
                else:
                    run.append(w)
        looked = self.look(runs)
        return [
            Closed.joined([looked[p] if isinstance(p, int) else self.lone(p) for p in parts])
            for parts in pieces
        ]

    def lone(self, word: str) -> Closed:
        """The groups of a word that is not kept."""
        got, fits, _ = self.align([word], False)
        got.sound = bool(fits.all())
        return got

    def look(self, runs: list[list[str]]) -> list[Closed]:
        """The groups of runs of kept words, all gathered at once."""
        if not runs:
            return []
        find = self.known.__getitem__
        chosen = np.array([n for run in runs for n in map(find, run)])
        ends = np.cumsum([len(run) for run in runs])
        flat = self.flat
        arrays = []
        for off, names in zip(self.off, (("a",), ("b",), ("na", "nb")), strict=True):
            places = ragged(off, chosen)
            cuts = np.cumsum(off[chosen + 1] - off[chosen])[ends - 1][:-1]
            arrays += [np.split(getattr(flat, n)[places], cuts) for n in names]
        unsound = np.add.reduceat(~self.sound[chosen], np.concatenate([[0], ends[:-1]]), dtype=int)
        return [Closed(*x, not bad) for *x, bad in zip(*arrays, unsound.tolist(), strict=True)]


# -- fragments -------------------------------------------------------------------------------


@dataclass
class Fragment:
    """Part of a text. Without a ``cut``, all of it is open and stands in ``prefix``; else
    the blank at its first cut and the one at its last are in neither open part."""

    prefix: str
    cut: bool
    closed: Closed
    suffix: str

    @classmethod
    def of(cls, aligner: Aligner, texts: list[str]) -> list[Fragment]:
        out, middles = [], []
        for text in texts:
            first = CUT.search(text) if aligner.cuttable else None
            if first is None:
                out.append(cls(text, False, Closed.empty(), ""))
                middles.append(None)
                continue
            at = text.rfind(" ")  # the last cut
            while at > first.start() and text[at - 1].isspace():
                at = text.rfind(" ", 0, at)
            out.append(cls(text[: first.start()], True, Closed.empty(), text[at + 1 :]))
            middles.append(text[first.end() : at] if at > first.start() else None)
        whole = [(i, m) for i, m in enumerate(middles) if m is not None]
        for (i, _), got in zip(whole, aligner.close([m for _, m in whole]), strict=True):
            out[i].closed = got
        return out

    @classmethod
    def composed(cls, aligner: Aligner, parts: list[Fragment]) -> Fragment:
        """Parts that follow one another as one fragment. Open text in between that has become
        whole is closed; it may hold a cut where two parts meet."""
        opened: list[list[str]] = [[]]
        closed: list[Closed | None] = []  # groups before each stretch of open text but the first
        for part in parts:
            opened[-1].append(part.prefix)
            if part.cut:
                closed.append(part.closed)
                opened.append([part.suffix])
        stretches = ["".join(texts) for texts in opened]
        if not closed:
            return cls(stretches[0], False, Closed.empty(), "")
        whole = aligner.close(stretches[1:-1]) if len(stretches) > 2 else []
        between = [closed[0]]
        for got, after in zip(whole, closed[1:], strict=True):
            between += [got, after]
        return cls(stretches[0], True, Closed.joined(between), stretches[-1])

    def whole(self, aligner: Aligner) -> Closed:
        """The groups of a fragment that is a whole text."""
        if not self.cut:
            return aligner.close([self.prefix])[0]
        ends = aligner.close([self.prefix, self.suffix])
        return Closed.joined([ends[0], self.closed, ends[1]])

    def packed(self) -> tuple:
        ids = [narrow(x) for x in arrays(self.closed)]
        return (self.prefix, self.cut, self.closed.sound, *ids, self.suffix)

    @classmethod
    def unpacked(cls, row) -> Fragment:
        ids = [read_tokens(row[n]).astype(np.uint32) for n in ("a", "b", "na", "nb")]
        return cls(row["prefix"], row["cut"], Closed(*ids, row["sound"]), row["suffix"])


def arrays(closed: Closed) -> list[np.ndarray]:
    return [closed.a, closed.b, closed.na, closed.nb]


def cut_fragments(definition, model):
    """Rows of (row, doc_id, part, text) to fragments."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(definition.value, model.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            made = Fragment.of(aligner, batch["text"].to_pylist())
            columns = dict(zip(FIELDS, zip(*[f.packed() for f in made], strict=True), strict=True))
            yield pa.RecordBatch.from_pydict(
                {n: batch[n] for n in ("row", "doc_id", "part")}
                | {n: list(values) for n, values in columns.items()},
            )

    return cut


def compose_fragments(definition, model):
    def compose(parts: pd.DataFrame) -> pd.DataFrame:
        aligner = Aligner.of(definition.value, model.value)
        parts = parts.sort_values("part")
        fragments = [Fragment.unpacked(r) for r in parts.to_dict("records")]
        one = Fragment.composed(aligner, fragments)
        first = parts.iloc[:1][["row", "doc_id", "part"]].reset_index(drop=True)
        values = pd.DataFrame([one.packed()], columns=FIELDS)
        return pd.concat([first, values], axis=1).assign(part=first["part"] // FAN)

    return compose


#: Fragments that are composed at once.
FAN = 8

TOKENS = "lot long, doc_id {kind}, a binary, b binary, na binary, nb binary"


class Lots:
    """Deals the documents of a task into lots of about ``tokens`` ids."""

    def __init__(self, tokens: int):
        self.tokens, self.filled = tokens, 0
        task = TaskContext.get()
        self.lot = (task.partitionId() if task else 0) << 32

    def add(self, n: int) -> int:
        if self.filled and self.filled + n > self.tokens:
            self.lot, self.filled = self.lot + 1, 0
        self.filled += n
        return self.lot


def narrow(array: np.ndarray) -> bytes:
    """Numbers in as few bytes as they need, compressed; the first byte tells how many."""
    most = int(array.max()) if array.size else 0
    size = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return zlib.compress(bytes([size]) + array.astype(f"<u{size}").tobytes(), 1)


def read_tokens(data: bytes) -> np.ndarray:
    raw = zlib.decompress(data)
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def token_rows(doc_ids: pa.Array, closed: list[Closed], lots: Lots) -> pa.RecordBatch:
    """Documents whose tokens are not their bytes get no tokens."""
    closed = [c if c.sound else Closed.empty() for c in closed]
    columns = {"lot": pa.array([lots.add(len(c.a) + len(c.b)) for c in closed], pa.int64())}
    columns["doc_id"] = doc_ids
    for i, name in enumerate(("a", "b", "na", "nb")):
        columns[name] = pa.array([narrow(arrays(c)[i]) for c in closed], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def close_texts(definition, model, lot_tokens: int):
    """Whole texts to their tokens."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, lots = Aligner.of(definition.value, model.value), Lots(lot_tokens)
        for batch in batches:
            texts = batch["text"].to_pylist()
            full = [i for i, t in enumerate(texts) if t]
            closed = [Closed.empty()] * len(texts)
            for i, got in zip(full, aligner.close([texts[i] for i in full]), strict=True):
                closed[i] = got
            yield token_rows(batch["doc_id"], closed, lots)

    return close


def close_fragments(definition, model, lot_tokens: int):
    """Fragments that are whole texts to their tokens."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, lots = Aligner.of(definition.value, model.value), Lots(lot_tokens)
        lots.lot += 1 << 31  # apart from the lots of texts that were never cut
        for batch in batches:
            closed = [Fragment.unpacked(r).whole(aligner) for r in batch.to_pylist()]
            yield token_rows(batch["doc_id"], closed, lots)

    return close


# -- links -----------------------------------------------------------------------------------


def links_of(a, b, na, nb, n_second: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct id pairs of a document, as a * n_second + b, and how many links each has;
    in blocks of disjoint pairs, since a long group may have very many."""
    group = np.repeat(np.arange(len(na)), na)
    total = int((na * nb).sum())
    if total <= min(LINKS_AT_ONCE, 8 * (len(a) + len(b)) + 1000):
        if total:
            b_off = np.concatenate([[0], np.cumsum(nb)])
            codes = np.repeat(a, nb[group]) * n_second + b[ragged(b_off, group)]
            yield np.unique(codes, return_counts=True)
        return
    weight = np.ones(len(a), np.int64)
    b_weight = np.ones(len(b), np.int64)
    if total > 8 * (len(a) + len(b)) + 1000:
        # Long groups: equal ids of a group as one, with a weight.
        packed, weight = np.unique(group << 32 | a, return_counts=True)
        group, a = packed >> 32, packed & 0xFFFFFFFF
        packed, b_weight = np.unique(np.repeat(np.arange(len(nb)), nb) << 32 | b, return_counts=True)
        b, nb = packed & 0xFFFFFFFF, np.bincount(packed >> 32, minlength=len(nb))
    b_off = np.concatenate([[0], np.cumsum(nb)])
    order = np.argsort(a, kind="stable")
    made = np.cumsum(nb[group[order]])
    at = 0
    while at < len(order):
        limit = (made[at - 1] if at else 0) + LINKS_AT_ONCE
        to = max(at + 1, int(np.searchsorted(made, limit, side="right")))
        # All occurrences of an id stay in one block.
        to = int(np.searchsorted(a[order], a[order[to - 1]], side="right"))
        block = order[at:to]
        places = ragged(b_off, group[block])
        codes = np.repeat(a[block], nb[group[block]]) * n_second + b[places]
        weights = np.repeat(weight[block], nb[group[block]]) * b_weight[places]
        distinct, inverse = np.unique(codes, return_inverse=True)
        yield distinct, np.bincount(inverse, weights).astype(np.int64)
        at = to


def count_pairs(n_second: int):
    """Documents of each lot that hold an id pair linked: (lot, code, docs)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, lot = 0, None

        def flush() -> pa.RecordBatch:
            codes, docs = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            lots = np.full(len(codes), lot, np.int64)
            return pa.RecordBatch.from_pydict({"lot": lots, "code": codes, "docs": docs})

        for batch in batches:
            rows = zip(*[batch[n].to_pylist() for n in ("lot", "a", "b", "na", "nb")], strict=True)
            for to, *packed in rows:
                if held and to != lot:
                    yield flush()
                    size = 0
                lot = to
                for codes, _ in links_of(*map(read_tokens, packed), n_second):
                    held.append(codes)
                    size += len(codes)
                    if size > LINKS_AT_ONCE:
                        yield flush()
                        size = 0
        if held:
            yield flush()

    return count


@cache
def group_texts(n: int) -> np.ndarray:
    """Ids as text, with what ends them: a comma, from ``n`` on the sign between tokenizers, and
    from 2 n on the one between groups."""
    return np.array([f"{i}{end}" for end in ",|;" for i in range(n)], object)


def digest(a, b, na, nb, texts: np.ndarray) -> str:
    """The hash of all groups written out; the empty text if there are none."""
    if not len(na):
        return ""
    n = len(texts) // 3
    which = np.empty(len(a) + len(b), np.int64)
    a_total, b_total = np.cumsum(na), np.cumsum(nb)
    a_at = np.arange(len(a)) + np.repeat(b_total - nb, na)
    b_at = np.arange(len(b)) + np.repeat(a_total, nb)
    which[a_at], which[b_at] = a, b
    which[a_at[a_total - 1]] += n
    which[b_at[b_total - 1]] += 2 * n
    written = "".join(texts[which].tolist())
    return hashlib.sha256(written[:-1].encode()).hexdigest()


def summarise(n_first: int, n_second: int):
    def summary(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        texts = group_texts(max(n_first, n_second))
        code, at = np.unique(pairs["code"].to_numpy(), return_index=True)
        count = pairs["count"].to_numpy()[at]
        best = pairs["best"].to_numpy(zero_copy_only=False)[at].astype(np.int64)
        out = {n: [] for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")}
        hashes = []
        for row in zip(*[docs[n].to_pylist() for n in ("a", "b", "na", "nb")], strict=True):
            a, b, na, nb = map(read_tokens, row)
            n_best = count_sum = 0
            for codes, links in links_of(a, b, na, nb, n_second):
                found = np.searchsorted(code, codes)
                n_best += int(best[found] @ links)
                count_sum += int(count[found] @ links)
            values = (len(a), len(b), len(na), int((na * nb).sum()), n_best, count_sum)
            for n, value in zip(out, values, strict=True):
                out[n].append(value)
            hashes.append(digest(a, b, na, nb, texts))
        columns = {"doc_id": docs["doc_id"]}
        columns |= {n: pa.array(values, pa.int64()) for n, values in out.items()}
        columns["groups_sha256"] = pa.array(hashes, pa.string())
        return pa.Table.from_pydict(columns)

    return summary


# -- operator --------------------------------------------------------------------------------


def aligned_tokens(
    df: DataFrame,
    byte_level_path: str,
    pieces_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_chars: int = 1 << 16,
    lot_tokens: int = 4_000_000,
) -> DataFrame:
    """The tokens of each text by two tokenizers and how they group: ``lot, doc_id, a, b, na, nb``
    with packed ids (``read_tokens``) and numbers of ids per group; written and read back.

    Texts of over ``part_chars`` characters are cut into parts of that size, which are dealt over
    the cluster as fragments and composed ``FAN`` at a time.
    """
    spark = ready(df.sparkSession)
    with open(byte_level_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    with open(pieces_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())
    kind = df.schema[id_col].dataType.simpleString()
    tools = definition, model
    tokens = TOKENS.format(kind=kind)
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.char_length("text") > part_chars, F.lit(False))
    short = docs.where(~is_long).mapInArrow(close_texts(*tools, lot_tokens), tokens)

    # Parts are written first: their numbers must not change once parts are dealt.
    starts = F.sequence(F.lit(0), F.expr(f"int((char_length(text) - 1) div {part_chars})"))
    parts = stage(
        docs.where(is_long)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("part", F.explode(starts))
        .select(
            "row",
            "doc_id",
            "part",
            F.expr(f"substring(text, part * {part_chars} + 1, {part_chars})").alias("text"),
        ),
        "alignment-parts",
    )
    frame = f"{FRAME.format(kind=kind)}, {FRAGMENT}"
    fragments = parts.repartition("row", "part").mapInArrow(cut_fragments(*tools), frame)
    most = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while most > 1:
        by = ["row", F.expr(f"part div {FAN}")]
        fragments = fragments.groupBy(*by).applyInPandas(compose_fragments(*tools), frame)
        most = -(-most // FAN)
    long = fragments.mapInArrow(close_fragments(*tools, lot_tokens), tokens)
    return stage(short.unionByName(long), "alignment-tokens")


def align(
    df: DataFrame,
    byte_level_path: str,
    pieces_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_chars: int = 1 << 16,
    lot_tokens: int = 4_000_000,
) -> DataFrame:
    """Per document the tokens of " " + text by two tokenizers and how they are linked: ``doc_id,
    n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Tokens of both that end at the same byte end a group; every token of A is linked to every
    token of B in its group. The count of an id pair is the number of documents that hold it
    linked; ``n_best`` counts links whose pair is the most frequent of its A id, ties included.

    Counts travel by lots of documents, each lot with its distinct pairs, so neither a frequent
    pair nor the table of pairs meets in one task. Null and empty texts, and those whose tokens
    are not their bytes (any with the sign for blanks), have no tokens and an empty hash. Null
    and repeated ids are documents of their own, repeated rows count once each. An empty table
    gives no rows; columns other than the two named are not read.
    """
    docs = aligned_tokens(
        df, byte_level_path, pieces_path, id_col, text_col, part_chars, lot_tokens
    )
    with open(byte_level_path, encoding="utf-8") as f:
        n_first = len(byte_level_tokens(f.read()))
    import sentencepiece

    n_second = sentencepiece.SentencePieceProcessor(model_file=pieces_path).get_piece_size()
    held = stage(
        docs.mapInArrow(count_pairs(n_second), "lot long, code long, docs long"),
        "alignment-pairs",
    )
    counts = held.groupBy("code").agg(F.sum("docs").alias("count"))
    counts = counts.withColumn("first", F.expr(f"code div {n_second}"))
    # One row per id of the first tokenizer, so at most its vocabulary.
    highest = counts.groupBy("first").agg(F.max("count").alias("most"))
    ranked = counts.join(F.broadcast(highest), "first").select(
        "code", "count", (F.col("count") == F.col("most")).alias("best")
    )
    pairs = held.select("lot", "code").join(ranked, "code")
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
    schema += "n_best long, count_sum long, groups_sha256 string"
    return (
        docs.groupBy("lot")
        .cogroup(pairs.groupBy("lot"))
        .applyInArrow(summarise(n_first, n_second), schema)
    )


def groups_of(tokens: DataFrame, df_schema: str = "doc_id long") -> DataFrame:
    """The groups of ``aligned_tokens`` as rows: ``doc_id, place, a_ids, b_ids``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, b, na, nb = (read_tokens(row[n]) for n in ("a", "b", "na", "nb"))
                a_ids = np.split(a, np.cumsum(na)[:-1]) if len(na) else []
                b_ids = np.split(b, np.cumsum(nb)[:-1]) if len(nb) else []
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([row["doc_id"]] * len(na), batch["doc_id"].type),
                        "place": pa.array(range(len(na)), pa.int64()),
                        "a_ids": pa.array([x.astype(np.int32) for x in a_ids], pa.list_(pa.int32())),
                        "b_ids": pa.array([x.astype(np.int32) for x in b_ids], pa.list_(pa.int32())),
                    }
                )

    return tokens.mapInArrow(rows, f"{df_schema}, place long, a_ids array<int>, b_ids array<int>")
