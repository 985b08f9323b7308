"""Language identification by interpolated Kneser-Ney models of characters."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import crc_mod, ready
from starmill.session import stage

ORDER = 4
BITS = 6  # a character's class; 0 is whatever is no letter
CLASSES = 1 << BITS
MASKS = [(1 << (BITS * n)) - 1 for n in range(ORDER + 1)]
UNKNOWN = "und"
#: Sharpness of the score is chosen among these, by log loss over all labelled rows.
#: Nats that a single character may lie above the mean; a text of n characters 1 / sqrt(n) of it.
SHORT = 6.0
SHARPNESS = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0)


@cache
def classes() -> np.ndarray:
    """The class of every code point: letters a-z are 1 to 26 in either case, other letters
    hash to the rest."""
    out = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = ord(c.lower()[0])
            out[cp] = low - 96 if 97 <= low <= 122 else 27 + low * 2654435761 % 2**32 % 37
    return out


def grams(text: str) -> np.ndarray:
    """Hashes of all runs of ORDER characters; runs of other characters count as one blank."""
    c = classes()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    if not c.any():
        return np.zeros(0, np.uint32)
    keep = np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]
    c = np.concatenate([np.zeros(ORDER - 1, np.uint32), c[keep], np.zeros(1, np.uint32)])
    code = c[: len(c) - ORDER + 1].copy()
    for i in range(1, ORDER):
        code = (code << BITS) | c[i : len(c) - ORDER + 1 + i]
    return code


def distinct(code: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and their counts, or sums of weights."""
    if weight is None:
        code = np.sort(code)
    else:
        order = np.argsort(code, kind="stable")
        code, weight = code[order], weight[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, int)
    if weight is None:
        return code[first], np.diff(np.r_[first, len(code)])
    return code[first], np.add.reduceat(weight, first) if len(first) else weight[:0]


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language and hash, summed over the partition before they are sent."""
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang: str, code: np.ndarray, n: np.ndarray) -> None:
        if lang in total:
            code, n = np.r_[total[lang][0], code], np.r_[total[lang][1], n]
        total[lang] = distinct(code, n)

    for batch in batches:
        new: dict[str, list[np.ndarray]] = {}
        for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
            code, n = distinct(grams(text))
            new.setdefault(lang, []).append((code, n))
        for lang, parts in new.items():
            add(lang, np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]))
    for lang, (code, n) in total.items():
        for at in range(0, len(code), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(code[part]), pa.string()),
                    "code": pa.array(code[part].astype(np.int64)),
                    "n": pa.array(n[part].astype(np.int64)),
                }
            )


class Level:
    """One order of a model: discounted shares of seen runs and weights of their contexts."""

    def __init__(self, code: np.ndarray, n: np.ndarray):
        ones, twos = int((n == 1).sum()), int((n == 2).sum())
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        context = code >> BITS
        self.contexts, total = distinct(context, n.astype(np.float64))
        _, kinds = distinct(context, np.ones(len(code)))
        self.lower = discount * kinds / total
        self.codes = code
        self.share = (n - discount) / total[np.searchsorted(self.contexts, context)]

    @staticmethod
    def look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float):
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], missing)


def levels(code: np.ndarray, n: np.ndarray) -> list[Level]:
    """From the highest order down; below it a run counts the distinct characters before it."""
    out = [Level(code, n)]
    for order in range(ORDER - 1, 0, -1):
        code, n = distinct(code & MASKS[order], np.ones(len(code)))
        out.append(Level(code, n))
    return out


def probability(model: list[Level], code: np.ndarray) -> np.ndarray:
    p = np.full(len(code), 1.0 / CLASSES)
    for order, level in zip(range(1, ORDER + 1), reversed(model), strict=True):
        part = code & MASKS[order]
        lower = Level.look(level.contexts, level.lower, part >> BITS, 1.0)
        p = Level.look(level.codes, level.share, part, 0.0) + lower * p
    return p


class Models:
    """The languages' models, with the logarithms of all seen runs in one sorted array."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        self.models = [levels(*counts[lang]) for lang in self.langs]
        seen = [counts[lang][0] for lang in self.langs]
        self.codes = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.uint32)
        self.logs = self.compute(self.codes)

    def compute(self, code: np.ndarray) -> np.ndarray:
        logs = np.zeros((len(code), len(self.models)), np.float32)
        for i, model in enumerate(self.models):
            logs[:, i] = np.log(probability(model, code))
        return logs

    def entropies(self, text: str | None) -> tuple[list[float] | None, int]:
        """Cross-entropy per character under every language, none without letters; and the
        number of characters."""
        code, n = distinct(grams(text or ""))
        if not len(code) or not self.langs:
            return None, 0
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        seen = self.codes[at] == code
        total = n[seen] @ self.logs[at[seen]].astype(np.float64)
        if not seen.all():
            total = total + n[~seen] @ self.compute(code[~seen]).astype(np.float64)
        return (-total / n.sum()).tolist(), int(n.sum())


def train(df: DataFrame, text_col: str, lang_col: str, learn: Column) -> Models:
    """Models from all rows that ``learn`` admits and whose text and language are known.

    A language has at most 2^24 hashes, whatever the number of rows; what comes to the driver
    and is broadcast is one count for each language and hash that occurs.
    """
    rows = df.where(learn & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = (
        rows.mapInArrow(count_grams, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    lang = np.array(counts["lang"].to_pylist(), object)
    code = counts["code"].to_numpy().astype(np.uint32)
    n = counts["n"].to_numpy()
    found = {}
    for name in sorted(set(lang)):
        mine = lang == name
        found[name] = distinct(code[mine], n[mine])
    return Models(found)


def score_texts(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            found = [models.entropies(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["learned"], batch["lang"], batch["held_out"]]
                + [pa.array([h for h, _ in found], pa.list_(pa.float64()))]
                + [pa.array([n for _, n in found], pa.int64())],
                ["doc_id", "learned", "lang", "held_out", "h", "n"],
            )

    return score


def softmax_total(sharpness: float) -> Column:
    """The sum of a softmax over the languages, relative to the best one's term."""
    least = F.array_min("h")
    terms = F.transform("h", lambda x: F.exp((least - x) * sharpness))
    return F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)


def calibrate(scored: DataFrame, langs: list[str]) -> tuple[float, dict[str, float]]:
    """The sharpness with the least log loss, and per language the cross-entropy beyond which
    a long text is rejected, from all labelled rows."""
    least = F.array_min("h")
    place = F.array_position(F.array(*map(F.lit, langs)), F.col("lang"))
    true = F.element_at("h", place.cast("int"))
    losses = [
        F.avg((true - least) * t + F.log(softmax_total(t))).alias(f"loss{t:g}") for t in SHARPNESS
    ]
    rows = scored.where("learned and h is not null")
    loss = rows.agg(*losses).first()
    best = min(range(len(SHARPNESS)), key=lambda i: (loss[i] if loss[i] is not None else 0.0, i))
    spread = (
        rows.where(true == least)
        .groupBy("lang")
        .agg(F.avg(least).alias("mean"), F.stddev_pop(least).alias("sd"))
        .collect()
    )
    return SHARPNESS[best], {r.lang: r["mean"] + max(8 * r.sd, 0.5) for r in spread}


def identify(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    modulus: int = 4,
    held: int = 2,
) -> DataFrame:
    """Predict languages: ``doc_id, held_out, lang_pred, score, cross_entropy, rejected``.

    Models of 4-character runs are learned from all rows whose crc32(id) modulo ``modulus`` is
    not ``held`` and whose text and language are known. The language with the lowest
    cross-entropy per character wins, ties to the smaller name; ``score`` is its share in a
    calibrated softmax. A text whose cross-entropy is more than eight deviations (0.5 nats at
    least, and 6 / sqrt(characters) on top) above the mean of its predicted language in training
    is marked ``rejected``, but keeps its prediction. Null texts and texts without a letter, empty ones among them, get ``und`` with
    score 0 and are rejected; so is everything if nothing was learned. Null ids are rows like
    others. Repeated rows get equal results, an empty table gives no rows, and columns other
    than the three named are not read. Languages, ids and sources never enter a prediction.
    """
    spark = ready(df.sparkSession)
    learn = crc_mod(id_col, modulus) != held
    models = train(df, text_col, lang_col, learn)
    shared = spark.sparkContext.broadcast(models)
    known = F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()
    scored = stage(
        df.select(
            F.col(id_col).alias("doc_id"),
            F.col(text_col).alias("text"),
            F.col(lang_col).alias("lang"),
            (learn & known).alias("learned"),
            (~learn).alias("held_out"),
        ).mapInArrow(
            score_texts(shared),
            f"doc_id {df.schema[id_col].dataType.simpleString()}, learned boolean, lang string, "
            "held_out boolean, h array<double>, n long",
        ),
        "lang-scores",
    )
    least = F.array_min("h")
    if not models.langs:
        sharpness, limits = 1.0, {}
    else:
        sharpness, limits = calibrate(scored, models.langs)
    langs = F.array(*map(F.lit, models.langs or [UNKNOWN]))
    pred = F.element_at(langs, F.array_position("h", least).cast("int"))
    limit = F.lit(None).cast("double")
    for lang, value in limits.items():
        limit = F.when(pred == lang, F.lit(value)).otherwise(limit)
    # Of n characters the mean strays in proportion to 1 / sqrt(n): short texts get more room.
    limit = limit + F.lit(SHORT) / F.sqrt("n")
    return scored.select(
        "doc_id",
        "held_out",
        F.when(F.col("h").isNull(), UNKNOWN).otherwise(pred).alias("lang_pred"),
        F.when(F.col("h").isNull(), 0.0).otherwise(1.0 / softmax_total(sharpness)).alias("score"),
        least.alias("cross_entropy"),
        (F.col("h").isNull() | F.coalesce(least > limit, F.lit(False))).alias("rejected"),
    )
