"""Small corpora with the awkward rows that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, words: int = 9) -> str:
    syllables = ["an", "the", "re", "tion", "ou", "is", "ble", "st", "wh", "ea", "ing", "nd"]
    made = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words)]
    return " ".join(made).capitalize() + "."


def prose(seed: int, sentences: int = 12) -> str:
    rng = random.Random(seed)
    return " ".join(sentence(rng) for _ in range(sentences))


def corpus(n: int = 40) -> list[tuple]:
    """Copies, near copies, a shared passage, empty, blank, null and long texts, repeated rows,
    and nulls in every other column."""
    passage = prose(1000, 6)
    out = []
    for i in range(n):
        text = prose(i)
        if i % 7 == 3:
            text = out[i - 3][1]
        elif i % 7 == 5:
            text = out[i - 5][1].replace("the", "tho", 1)
        elif i % 5 == 2:
            text = f"{text}\n{passage} {prose(i + 500, 2)}"
        out.append((i, text, "en" if i % 3 else "de", f"src{i % 4}", len(text)))
    out += [
        (n, None, None, None, None),
        (n + 1, "", "en", "src0", 0),
        (n + 2, " \t\n ", "en", None, 4),
        (n + 3, "One", None, "src1", 3),
        (n + 4, "ÄÖÜ éà 漢字 ☃ <|endoftext|>  two  blanks  x", "de", "src2", 5),
        (n + 5, prose(77, 900), "en", "src3", 1),
        (n + 6, "a" * 30_000, "en", "src0", 30_000),
        (n + 6, "a" * 30_000, "en", "src0", 30_000),
    ]
    return out


def frame(spark, rows: list[tuple]):
    """The rows as documents, with further columns named like those operators use inside."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    inside = "row rank bucket key fp size shard slot place number taken label score entry words"
    return df.withColumns({c: F.lit("clash") for c in inside.split()})


def nameless(rows: list[tuple]) -> list[tuple]:
    """Every third id gone, and one id twice with different texts."""
    out = [(None if i % 3 == 0 else r[0], *r[1:]) for i, r in enumerate(rows)]
    return [*out, (1, "another text with the id of a row that is there", "en", "src1", 1)]
