"""Ranked lexical search as a search for large inner products, by buckets of vector length.

A document is the vector of its terms' impacts, an item that of its terms' weights, and a score
is their inner product. Documents are dealt by falling length of their vectors into buckets. A
bucket is left out for an item if the product of both lengths (Cauchy and Schwarz) stays below the
score it must reach; inside a bucket, bounds on single coordinates leave few documents, which are
scored anew in integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import ceil_div, ready
from starmill.session import stage

#: Letters, digits and all beyond ASCII stay, A-Z in lower case; the rest separates terms.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)
CHUNK = 1 << 20  # bytes of a text that are split at once
BUCKET_ROWS = 16_384
BUCKET_ENTRIES = 4_000_000
SLACK = 1e-9  # bounds are sums of doubles


def term_counts(text: bytes | None) -> Counter[bytes]:
    """How often each term occurs."""
    text = (text or b"").translate(TERM_BYTES)
    if len(text) <= CHUNK:
        return Counter(text.split())
    counts: Counter[bytes] = Counter()
    at = 0
    while at < len(text):
        to = text.find(b" ", at + CHUNK)
        to = len(text) if to < 0 else to
        counts.update(text[at:to].split())
        at = to
    return counts


def item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"].cast(pa.binary()).to_pylist()
        terms = [sorted(term_counts(t)) for t in texts]
        yield pa.RecordBatch.from_pydict(
            {
                "item": batch["item"],
                "item_id": batch["item_id"],
                "terms": pa.array(terms, pa.list_(pa.binary())),
            }
        )


def count_terms(vocabulary):
    """Per document the number of its terms, and those of the vocabulary with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in batches:
            n, terms, tf = [], [], []
            for text in batch["text"].cast(pa.binary()).to_pylist():
                counts = term_counts(text)
                known = [(number[t], c) for t, c in counts.items() if t in number]
                known.sort()
                n.append(counts.total())
                terms.append(np.array([t for t, _ in known], "<u4").tobytes())
                tf.append(np.array([c for _, c in known], "<u4").tobytes())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "n": pa.array(n, pa.int64()),
                    "terms": pa.array(terms, pa.binary()),
                    "tf": pa.array(tf, pa.binary()),
                }
            )

    return count


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers packed into the rows of a column, and how many of them each row has."""
    parts = column.to_pylist()
    sizes = np.array([len(p) // 4 for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), "<u4").astype(np.int64), sizes


def documents_per_term(terms: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(flat(batch["terms"])[0], minlength=terms)
        (held,) = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"term": held.astype(np.int64), "docs": total[held]})

    return count


def impacts(documents: int, total: int):
    """Impact vectors and their lengths."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tf, sizes = flat(batch["tf"])
            n = batch["n"].to_numpy().tolist()
            m = np.array([100 - 50 + (50 * x * documents) // total for x in n], np.int64)
            value = 1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, sizes))
            row = np.repeat(np.arange(len(n)), sizes)
            length = np.sqrt(np.bincount(row, value.astype(float) ** 2, minlength=len(n)))
            cuts = np.cumsum(sizes)[:-1]
            packed = [v.astype("<u4").tobytes() for v in np.split(value, cuts)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "terms": batch["terms"],
                    "impact": pa.array(packed, pa.binary()),
                    "length": pa.array(length, pa.float64()),
                }
            )

    return weigh


class Queries:
    """Weight vectors of items over a vocabulary, in one flat array each."""

    def __init__(self, terms: list[np.ndarray], weight: np.ndarray, least: np.ndarray):
        kept = [t[weight[t] > 0] for t in terms]
        # Heavy terms first: their bounds cut most.
        self.terms = [t[np.argsort(-weight[t], kind="stable")] for t in kept]
        self.weight = weight
        self.length = np.array([math.sqrt(float((weight[t] ** 2).sum())) for t in self.terms])
        self.least = least  # scores that a result of an item has to reach


class Bucket:
    """Documents of similar length, by rows and by terms."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches)
        self.ids = table["doc_id"].combine_chunks()
        self.length = table["length"].to_numpy()
        self.term, self.sizes = flat(table["terms"])
        self.impact, _ = flat(table["impact"])
        self.start = np.concatenate([[0], np.cumsum(self.sizes)])
        row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        order = np.argsort(self.term, kind="stable")
        self.row_of, self.impact_of = row[order], self.impact[order]
        self.held, first = np.unique(self.term[order], return_index=True)
        self.first = np.append(first, len(order))

    def posting(self, term: int) -> slice:
        at = int(np.searchsorted(self.held, term))
        if at == len(self.held) or self.held[at] != term:
            return slice(0, 0)
        return slice(int(self.first[at]), int(self.first[at + 1]))

    def candidates(self, terms: np.ndarray, weight: np.ndarray, length: float, least: float):
        """Rows whose score may reach ``least``, by bounds on the coordinates."""
        n = len(self.sizes)
        cosine = min(1.0, least / (length * self.length[0]))
        share = weight[terms] / length
        spread = np.sqrt((1 - np.minimum(share, 1) ** 2) * (1 - cosine**2))
        lowest = share * cosine - spread - SLACK
        highest = np.where(share >= cosine, 1.0, share * cosine + spread) + SLACK
        focus = np.flatnonzero(lowest > 0)
        if len(focus):
            # Every row that may count holds all of these terms, each within its bounds.
            kept = np.zeros(n, np.int64)
            for f in focus:
                at = self.posting(int(terms[f]))
                rows = self.row_of[at]
                unit = self.impact_of[at] / self.length[rows]
                kept[rows[(unit >= lowest[f]) & (unit <= highest[f])]] += 1
            return np.flatnonzero(kept == len(focus))
        # Else sums over the heavy terms, and for the rest at most the lengths that are left.
        seen, mass = np.zeros(n), np.zeros(n)
        left = length**2
        rest = self.length.copy()
        for t in terms:
            bound = seen + math.sqrt(max(left, 0.0)) * rest
            if not (bound * (1 + SLACK) >= least).any():
                return np.zeros(0, np.int64)
            at = self.posting(int(t))
            rows, values = self.row_of[at], self.impact_of[at].astype(float)
            seen[rows] += weight[t] * values
            mass[rows] += values**2
            left -= float(weight[t]) ** 2
            rest[rows] = np.sqrt(np.maximum(self.length[rows] ** 2 - mass[rows], 0))
        return np.flatnonzero((seen > 0) & (seen * (1 + SLACK) >= least))

    def scores(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact scores of rows, in integers."""
        sizes = self.sizes[rows]
        before = np.cumsum(sizes) - sizes
        at = np.repeat(self.start[rows] - before, sizes) + np.arange(sizes.sum())
        return np.add.reduceat(dense[self.term[at]] * self.impact[at], before)


def search(queries, k: int, bucket_rows: int, bucket_entries: int):
    """The best ``k`` documents of a task for each item; rows come by falling length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Queries = queries.value
        n = len(asked.terms)
        least = asked.least.astype(float)
        best: list[pa.Table | None] = [None] * n
        dense = np.zeros(len(asked.weight), np.int64)
        for bucket in buckets(batches, bucket_rows, bucket_entries):
            reach = asked.length * bucket.length[0] * (1 + SLACK)
            for q in np.flatnonzero((asked.length > 0) & (reach >= least)):
                terms = asked.terms[q]
                rows = bucket.candidates(terms, asked.weight, asked.length[q], least[q])
                if not len(rows):
                    continue
                dense[terms] = asked.weight[terms]
                score = bucket.scores(rows, dense)
                dense[terms] = 0
                fit = (score > 0) & (score >= least[q])
                found = pa.table({"score": score[fit], "doc_id": bucket.ids.take(rows[fit])})
                if best[q] is not None:
                    found = pa.concat_tables([best[q], found])
                keys = [("score", "descending"), ("doc_id", "ascending")]
                order = pc.sort_indices(found, sort_keys=keys, null_placement="at_end")
                best[q] = found.take(order[:k])
                if len(best[q]) == k:
                    least[q] = max(least[q], best[q]["score"][k - 1].as_py())
        for q, found in enumerate(best):
            if found is not None and len(found):
                yield pa.RecordBatch.from_pydict(
                    {
                        "item": pa.array([q] * len(found), pa.int32()),
                        "doc_id": found["doc_id"].combine_chunks(),
                        "score": found["score"].combine_chunks(),
                    }
                )

    return run


def buckets(batches, bucket_rows: int, bucket_entries: int) -> Iterator[Bucket]:
    held, rows, entries = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        entries += sum(pc.binary_length(batch["terms"]).to_pylist()) // 4
        if rows >= bucket_rows or entries >= bucket_entries:
            yield Bucket(held)
            held, rows, entries = [], 0, 0
    if held:
        yield Bucket(held)


def rank(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 50,
    block_terms: int = 500_000,
    bucket_rows: int = BUCKET_ROWS,
    bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for each item: ``item_id, rank, doc_id,
    score``; equal scores by ascending id, null ids last.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z in lower case. All
    documents and their whole texts count in the statistics and are candidates. Items are taken
    in blocks of about ``block_terms`` terms, which bounds what the driver holds and broadcasts.

    Null and empty texts have no terms: such a document is never found, such an item has no
    rows. Rows with null or repeated ids are documents, or items, of their own. Without documents
    or items the result is empty. Columns other than those named are not read.
    """
    spark = ready(df.sparkSession)
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col(item_id_col).alias("item_id"),
        F.col(item_text_col).alias("text"),
    )
    kind = items.schema[item_id_col].dataType.simpleString()
    shape = f"item long, item_id {kind}, terms array<binary>"
    asked = stage(asked.mapInArrow(item_terms, shape).where("size(terms) > 0"), "lexical-items")
    size = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    out = []
    n_blocks = ceil_div(size, block_terms)
    for n in range(n_blocks):
        block = asked.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == n)
        out.append(rank_block(docs, block, k, bucket_rows, bucket_entries))
    made = [part for part in out if part is not None]
    if not made:
        kinds = f"item_id {kind}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}"
        return spark.createDataFrame([], f"{kinds}, score long")
    return reduce(DataFrame.unionByName, made)


def rank_block(
    docs: DataFrame, block: DataFrame, k: int, bucket_rows: int, bucket_entries: int
) -> DataFrame | None:
    """Results of a block of items; None if it has no items or no document has a term."""
    spark = docs.sparkSession
    listed = block.orderBy("item").collect()  # bounded by the size of a block
    if not listed:
        return None
    vocabulary = sorted({bytes(t) for row in listed for t in row.terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    terms = [np.array([number[bytes(t)] for t in row.terms], np.int64) for row in listed]
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = stage(
        docs.mapInArrow(
            count_terms(spark.sparkContext.broadcast(number)),
            f"doc_id {kind}, n long, terms binary, tf binary",
        ),
        "lexical-counts",
    )
    documents, total = counted.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not documents:
        return None
    per_term = counted.select("terms").mapInArrow(
        documents_per_term(len(vocabulary)), "term long, docs long"
    )
    held = np.zeros(len(vocabulary), np.int64)
    for row in per_term.groupBy("term").agg(F.sum("docs").alias("docs")).collect():
        held[row.term] = row.docs
    weight = np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in held], np.int64
    )
    vectors = stage(
        counted.where("length(terms) > 0").mapInArrow(
            impacts(documents, total), f"doc_id {kind}, terms binary, impact binary, length double"
        ),
        "lexical-impacts",
    )

    def best(rows: DataFrame, least: np.ndarray) -> DataFrame:
        queries = spark.sparkContext.broadcast(Queries(terms, weight, least))
        return (
            rows.repartitionByRange(F.col("length").desc())
            .sortWithinPartitions(F.col("length").desc())
            .mapInArrow(
                search(queries, k, bucket_rows, bucket_entries),
                f"item int, doc_id {kind}, score long",
            )
        )

    # Scores to reach: the k-th best of an item among the longest vectors.
    limit = vectors.approxQuantile("length", [1 - 1 / 16], 0.01)
    limit = limit[0] if limit else 0.0
    none = np.zeros(len(terms), np.int64)
    first = stage(best(vectors.where(F.col("length") >= limit), none), "lexical-first")
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = first.withColumn("rank", F.row_number().over(by_score))
    least = none.copy()
    for row in ranked.where(F.col("rank") == k).select("item", "score").collect():
        least[row.item] = row.score
    rest = best(vectors.where(F.col("length") < limit), least)
    named = spark.createDataFrame(
        [(i, row.item_id) for i, row in enumerate(listed)],
        f"item int, item_id {block.schema['item_id'].dataType.simpleString()}",
    )
    return (
        first.unionByName(rest)
        .withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .join(F.broadcast(named), "item")
        .select("item_id", "rank", "doc_id", "score")
    )
