import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from cases import corpus, frame, nameless, prose

from starmill.llm import lexical
from starmill.llm.lexical import Bucket, rank, term_counts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain(docs, items, k):
    """(item_id, rank, doc_id, score) by adding up the definition."""
    found = [(d, [t for t in TERM.findall((text or "").translate(LOWER))]) for d, text in docs]
    held = [terms for _, terms in found if terms]
    total, df = sum(map(len, held)), {}
    for terms in held:
        for t in set(terms):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        asked = set(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for doc, terms in found:
            score = 0
            for t in asked & set(terms):
                w = math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + (50 * len(terms) * len(held)) // total
                tf = terms.count(t)
                score += w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        for i, (score, _, _, doc) in enumerate(sorted(scores)[:k], 1):
            out.append((item, i, doc, -score))
    return out


ITEMS = [
    (0, prose(3, 2)),
    (1, prose(1000, 6)),
    (2, "ÄÖÜ 漢字 TWO blanks"),
    (3, None),
    (4, " .,!"),
    (5, "nothingofthiskind"),
    (6, "one"),
    (6, prose(4, 1)),
    (None, prose(9, 1)),
]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("change", [lambda r: r, nameless])
@pytest.mark.parametrize("sizes", [(500_000, 16_384, 4_000_000), (40, 5, 60)])
def test_against_brute_force(spark, change, sizes):
    rows = change(corpus())
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS rank", "2 AS item")
    got = rank(
        frame(spark, rows), items, k=7, block_terms=sizes[0], bucket_rows=sizes[1],
        bucket_entries=sizes[2],
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = plain([r[:2] for r in rows], ITEMS, 7)
    assert ordered(map(tuple, got.collect())) == ordered(want)


def test_terms_of_long_texts(monkeypatch):
    text = ("Ab" * 50 + " É-b\0c1 " + "x ") * 30
    whole = term_counts(text.encode())
    monkeypatch.setattr(lexical, "CHUNK", 7)
    assert term_counts(text.encode()) == whole
    assert whole == {b"ab" * 50: 30, "É".encode(): 30, b"b": 30, b"c1": 30, b"x": 30}


@pytest.mark.parametrize("seed", range(60))
def test_bounds_keep_every_row_that_counts(seed):
    rng = np.random.default_rng(seed)
    n, width = 40, 2 + seed % 11
    matrix = rng.integers(1, 1000, (n, width)) * (rng.random((n, width)) < rng.uniform(0.1, 0.9))
    matrix[:, 0] += 1
    length = np.sqrt((matrix.astype(float) ** 2).sum(1))
    order = np.argsort(-length)
    matrix, length = matrix[order], length[order]
    held = [np.flatnonzero(r) for r in matrix]
    bucket = Bucket([pa.RecordBatch.from_pydict({
        "doc_id": pa.array(range(n)),
        "terms": pa.array([h.astype("<u4").tobytes() for h in held], pa.binary()),
        "impact": pa.array([r[h].astype("<u4").tobytes() for r, h in zip(matrix, held)], pa.binary()),
        "length": length,
    })])
    weight = rng.integers(1, 9000, width)
    terms = np.array(random.Random(seed).sample(range(width), min(width, 1 + seed % 5)))
    terms = terms[np.argsort(-weight[terms])]
    dense = np.zeros(width, np.int64)
    dense[terms] = weight[terms]
    want = matrix @ dense
    size = math.sqrt((weight[terms].astype(float) ** 2).sum())
    for least in [0.0, *np.sort(want)[[0, n // 2, n - 3, n - 1]].astype(float)]:
        rows = bucket.candidates(terms, weight, size, least)
        assert set(np.flatnonzero((want >= least) & (want > 0))) <= set(rows.tolist())
        assert (bucket.scores(rows, dense) == want[rows]).all()


def test_coordinate_bounds_leave_few_rows():
    """A heavy term leaves only the rows that hold enough of it."""
    rows = [[9, 1], [1, 9], [8, 2], [2, 8]]
    bucket = Bucket([pa.RecordBatch.from_pydict({
        "doc_id": pa.array(range(4)),
        "terms": pa.array([np.array([0, 1], "<u4").tobytes()] * 4, pa.binary()),
        "impact": pa.array([np.array(r, "<u4").tobytes() for r in rows], pa.binary()),
        "length": pa.array([math.hypot(*r) for r in rows]),
    })])
    weight = np.array([100, 1])
    got = bucket.candidates(np.array([0, 1]), weight, math.hypot(100, 1), 700.0)
    assert got.tolist() == [0, 2]


def test_without_rows(spark):
    docs, items = frame(spark, corpus(3)), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rank(frame(spark, []), items).collect() == []
    assert rank(docs, items.limit(0)).collect() == []
    assert rank(docs.where("text IS NULL"), items).collect() == []
