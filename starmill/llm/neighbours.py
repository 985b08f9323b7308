"""Approximate nearest neighbours: stable projections to few dimensions, searched by kd-trees
until a chi-square test tells that nearer vectors are unlikely."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ceil_div, ready
from starmill.session import stage

LEAF = 64


def chi_square_quantile(p: float, m: int) -> float:
    """The value that a chi-square variable with m degrees of freedom exceeds with 1 - p."""

    def below(x: float) -> float:  # series of the regularised lower incomplete gamma function
        a, x = m / 2, x / 2
        term = total = 1 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= x / n
            total += term
        return total * math.exp(a * math.log(x) - x - math.lgamma(a)) if x else 0.0

    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def projection(dims: int, m: int, seed: int) -> np.ndarray:
    """Gaussian directions: the squared projected distance over the squared distance is
    chi-square with m degrees of freedom."""
    return np.random.default_rng(seed).standard_normal((dims, m))


class KdTree:
    """Median splits down to leaves; each leaf keeps the box of its points."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        leaves, waiting = [], [np.arange(len(points))]
        while waiting:
            own = waiting.pop()
            spread = np.ptp(points[own], 0) if len(own) else np.zeros(1)
            if len(own) <= leaf or not spread.max():
                leaves.append(own)
                continue
            axis = int(spread.argmax())
            order = own[np.argsort(points[own, axis], kind="stable")]
            half = len(order) // 2
            waiting += [order[half:], order[:half]]
        self.leaves = leaves
        self.low = np.stack([points[o].min(0) for o in leaves])
        self.high = np.stack([points[o].max(0) for o in leaves])

    def distances(self, q: np.ndarray) -> np.ndarray:
        """The squared distance of a point to the box of each leaf."""
        off = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        return (off * off).sum(-1)


def search(tree, points, vectors, ids, q_point, q_vector, q_id, k, quantile, bound):
    """The k nearest by distance, then id. Leaves come in order of projected distance; the
    search stops once nearer vectors would have shown, with the wanted chance, in the leaves
    seen: when the projected distance exceeds that of the k-th times the quantile."""
    far = tree.distances(q_point)
    best_d, best_i = np.zeros(0), np.zeros(0, np.int64)
    for leaf in np.argsort(far, kind="stable"):
        if far[leaf] > bound * quantile:
            break
        own = tree.leaves[leaf]
        off = points[own] - q_point
        own = own[(off * off).sum(1) <= bound * quantile]
        own = own[ids[own] != q_id]
        off = vectors[own] - q_vector
        d = (off * off).sum(1)
        best_d, best_i = np.r_[best_d, d], np.r_[best_i, ids[own]]
        order = np.lexsort((best_i, best_d))[:k]
        best_d, best_i = best_d[order], best_i[order]
        if len(best_d) == k:
            bound = min(bound, best_d[-1])
    return best_d, best_i


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, all components finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


class Cells:
    """A kd-tree over a sample of projected vectors; its leaves are the cells of the index."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.nodes: list[tuple] = []  # (axis, cut, left, right), or (-1, number)
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        m = sample.shape[1]
        self.grow(sample, np.full(m, -np.inf), np.full(m, np.inf), cells)

    def grow(self, points: np.ndarray, low: np.ndarray, high: np.ndarray, cells: int) -> int:
        number = len(self.nodes)
        self.nodes.append(())
        spread = np.ptp(points, 0) if len(points) > 1 else np.zeros(1)
        if cells <= 1 or not spread.max():
            self.nodes[number] = (-1, len(self.boxes))
            self.boxes.append((low, high))
            return number
        axis = int(spread.argmax())
        cut = float(np.median(points[:, axis]))
        left = points[:, axis] < cut
        if not left.any():
            cut = float(points[points[:, axis] > cut, axis].min())
            left = points[:, axis] < cut
        below, above = high.copy(), low.copy()
        below[axis] = above[axis] = cut
        a = self.grow(points[left], low, below, cells // 2)
        b = self.grow(points[~left], above, high, cells - cells // 2)
        self.nodes[number] = (axis, cut, a, b)
        return number

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            number, own = waiting.pop()
            node = self.nodes[number]
            if node[0] < 0:
                out[own] = node[1]
                continue
            left = points[own, node[0]] < node[1]
            waiting += [(node[2], own[left]), (node[3], own[~left])]
        return out

    def within(self, point: np.ndarray, reach: float) -> np.ndarray:
        low, high = (np.stack(x) for x in zip(*self.boxes, strict=True))
        off = np.maximum(np.maximum(low - point, point - high), 0)
        return np.flatnonzero((off * off).sum(1) <= reach)


def matrix(column) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def place_vectors(shared):
    """Cell and projection of every vector."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, cells = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            points = matrix(batch["vector"]) @ directions
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"],
                    batch["vector"],
                    pa.array(list(points), pa.list_(pa.float64())),
                    pa.array(cells.of(points)),
                ],
                ["vec_id", "vector", "point", "cell"],
            )

    return place


def search_cell(k: int, quantile: float):
    """The k nearest that one part of a cell has for each query sent there."""

    def find(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "squared": []}
        if len(queries) and len(rows):
            points, vectors = np.stack(rows["point"]), np.stack(rows["vector"]).astype(np.float64)
            ids = rows["vec_id"].to_numpy()
            tree = KdTree(points)
            for q in queries.itertuples():
                d, i = search(
                    tree, points, vectors, ids,
                    np.asarray(q.point), np.asarray(q.vector, np.float64), q.vec_id,
                    k, quantile, q.bound,
                )
                out["query_id"] += [q.vec_id] * len(d)
                out["vec_id"] += i.tolist()
                out["squared"] += d.tolist()
        return pd.DataFrame(out).astype(
            {"query_id": "int64", "vec_id": "int64", "squared": "float64"}
        )

    return find


def best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query among those that its cells found."""
    top = F.slice(F.sort_array(F.collect_set(F.struct("squared", "vec_id"))), 1, k)
    return found.groupBy("query_id").agg(top.alias("top"))


def nearest(
    df: DataFrame,
    queries: str,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    m: int = 10,
    chance: float = 0.95,
    sample: int = 65_536,
    rows_per_cell: int = 2_000,
    seed: int = 3,
) -> DataFrame:
    """Nearest neighbours of the rows that the condition ``queries`` admits: ``query_id, rank, vec_id, score``.

    ``score`` is the Euclidean distance in double precision; ties go to the smaller id, and a
    query's own id is no neighbour. Vectors that are null, empty, zero, or that hold null or
    non-finite components take no part, nor do null ids; vectors of another length than most
    (of equally many, the longer) take no part either. With fewer than k candidates all are
    given. Repeated rows with one id count once. An empty table gives no rows; columns other
    than the two named, and those that ``queries`` reads, are not read.

    Vectors are projected to ``m`` Gaussian directions. A kd-tree over at most ``sample``
    projected rows (those with the least hash of their id) cuts the space into cells, and every
    row is placed in one; cells with many rows, such as copies of one vector, are cut into
    parts by a hash of the id. A query first asks its own cell. What it finds bounds the
    distance, and the chi-square quantile of ``chance`` the projected distance, of anything
    nearer; it then asks all cells within that. Each part of a cell has its own kd-tree and
    returns at most k rows per query.
    """
    spark = ready(df.sparkSession)
    rows = df.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    rows = rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.expr(queries).alias("asks"),
    )
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n"))
    common = lengths.first()
    dims, total = (common["n"], common["count"]) if common else (1, 0)
    rows = rows.where(F.size("vector") == dims)
    few = rows.select("vector").orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(sample)
    directions = projection(dims, m, seed)
    known = few.toArrow()["vector"].combine_chunks()
    points = matrix(known) @ directions if len(known) else np.zeros((1, m))
    cells = Cells(points, ceil_div(total, rows_per_cell) or 1)
    shared = spark.sparkContext.broadcast((directions, cells))
    kinds = "vec_id long, vector array<double>, point array<double>, cell long"
    place = place_vectors(shared)
    index = stage(rows.select("vec_id", "vector").mapInArrow(place, kinds), "vector-index")
    asked = rows.where("asks").select("vec_id", "vector").dropDuplicates(["vec_id"])
    asked = stage(asked.mapInArrow(place, kinds), "vector-queries")
    parts = index.groupBy("cell").agg(
        F.ceil(F.count("*") / (2 * rows_per_cell)).cast("long").alias("parts")
    )
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    index = index.join(parts, "cell").withColumn("part", part).drop("parts")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    quantile = chi_square_quantile(chance, m)
    found_kinds = "query_id long, vec_id long, squared double"

    def ask(to: DataFrame) -> DataFrame:
        sent = to.join(parts, "cell").select("cell", each, "vec_id", "vector", "point", "bound")
        return (
            sent.groupBy("cell", "part")
            .cogroup(index.groupBy("cell", "part"))
            .applyInPandas(search_cell(k, quantile), found_kinds)
        )

    infinite = F.lit(float("inf"))
    own = stage(best(ask(asked.withColumn("bound", infinite)), k), "vector-own-cell")
    limit = F.when(F.size("top") == k, F.element_at("top", k)["squared"]).otherwise(infinite)
    bounded = asked.join(
        own.select(F.col("query_id").alias("vec_id"), limit.alias("limit")), "vec_id", "left"
    ).withColumn("bound", F.coalesce("limit", infinite))

    def cells_in_reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value[1]
        for batch in batches:
            reach = batch["bound"].to_numpy(zero_copy_only=False) * quantile
            lists = [
                near[near != home]
                for near, home in (
                    (cells.within(np.asarray(p), r), h)
                    for p, r, h in zip(
                        batch["point"].to_pylist(), reach, batch["cell"].to_pylist(), strict=True
                    )
                )
            ]
            which = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
            taken = batch.take(which)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([*lists, np.zeros(0, np.int64)])),
                    taken["vec_id"],
                    taken["vector"],
                    taken["point"],
                    taken["bound"],
                ],
                ["cell", "vec_id", "vector", "point", "bound"],
            )

    others = bounded.select("cell", "vec_id", "vector", "point", "bound").mapInArrow(
        cells_in_reach,
        "cell long, vec_id long, vector array<double>, point array<double>, bound double",
    )
    at_home = own.select("query_id", F.inline("top")).select("query_id", "vec_id", "squared")
    top = best(ask(others).unionByName(at_home), k)
    return top.select("query_id", F.posexplode("top").alias("at", "found")).select(
        "query_id",
        (F.col("at") + 1).alias("rank"),
        F.col("found.vec_id").alias("vec_id"),
        F.sqrt("found.squared").alias("score"),
    )
