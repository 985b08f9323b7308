import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmill.llm.neighbours import Cells, KdTree, chi_square_quantile, nearest

ASKS = "vec_id % 10 = 0"
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k):
    vectors = {i: np.array(v, np.float32).astype(np.float64) for i, v in rows}
    out = {}
    for q in (i for i in vectors if i % 10 == 0):
        found = sorted((math.sqrt(((vectors[i] - vectors[q]) ** 2).sum()), i) for i in vectors if i != q)
        out[q] = found[:k]
    return out


def table(spark, rows):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in ("vector", "point", "cell", "part", "top")})


def made(n, dims=16, seed=1):
    points = np.random.default_rng(seed).standard_normal((n, dims)).astype(np.float32)
    return [(i, p.tolist()) for i, p in enumerate(points)]


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    return {q: [x[1:] for x in sorted(found)] for q, found in out.items()}


@pytest.mark.parametrize("rows_per_cell", [50, 5000])
def test_recall_and_scores(spark, rows_per_cell):
    rows = made(800)
    got = answers(nearest(table(spark, rows), ASKS, rows_per_cell=rows_per_cell))
    want = plain(rows, 10)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    vectors = {i: np.array(v, np.float32).astype(np.float64) for i, v in rows}
    for q, found in got.items():
        assert len(found) == 10 and found == sorted(found)
        for score, i in found:
            assert score == pytest.approx(np.linalg.norm(vectors[i] - vectors[q]), rel=1e-12)


def test_certain_search_is_exact(spark):
    rows = made(300, dims=4)
    got = answers(nearest(table(spark, rows), ASKS, chance=1 - 1e-12, rows_per_cell=20))
    for q, found in plain(rows, 10).items():
        assert [i for _, i in got[q]] == [i for _, i in found]


def test_a_third_is_one_vector(spark):
    """Copies are cut into parts, and ties go to the smaller id."""
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else v) for i, v in made(600, dims=3)]
    got = answers(nearest(table(spark, rows), ASKS, rows_per_cell=20))
    copies = [i for i in range(600) if i % 3 == 0]
    for q in (30, 300, 570):
        assert got[q] == [(0.0, i) for i in copies if i != q][:10]


def test_awkward_vectors(spark):
    rows = [
        *made(6, dims=3), (10, [1.0, 0.0, 0.0]), (10, [1.0, 0.0, 0.0]), (20, None), (30, []),
        (40, [0.0, 0.0, 0.0]), (50, [1.0, None, 0.0]), (60, [float("nan"), 1.0, 0.0]),
        (70, [float("inf"), 1.0, 0.0]), (80, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]),
    ]
    got = answers(nearest(table(spark, rows), ASKS))
    assert set(got) == {0, 10}
    assert [i for _, i in got[10]] == [i for _, i in plain([*rows[:6], rows[6]], 10)[10]]
    assert len(got[0]) == 6
    assert answers(nearest(table(spark, []), ASKS)) == {}
    assert answers(nearest(table(spark, [(0, [1.0, 2.0])]), ASKS)) == {}


def test_quantiles():
    """Against tabulated values of the chi-square distribution."""
    for p, m, x in ((0.95, 1, 3.8415), (0.95, 10, 18.307), (0.5, 4, 3.3567), (0.99, 10, 23.209)):
        assert chi_square_quantile(p, m) == pytest.approx(x, abs=1e-3)


def test_trees_hold_every_point():
    points = np.random.default_rng(2).integers(0, 3, (500, 2)).astype(float)
    tree = KdTree(points, leaf=10)
    assert sorted(np.concatenate(tree.leaves)) == list(range(500))
    cells = Cells(points, 16)
    for p, c in zip(points, cells.of(points), strict=True):
        assert c in cells.within(p, 0.0)
