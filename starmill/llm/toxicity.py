"""Toxicity by multiple-instance learning: sentence scores under a noisy-or, trained from
document labels."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import crc_mod, ready
from starmill.session import stage

BUCKETS = 1 << 20
TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
ENDS = np.array([zlib.crc32(c) for c in (b".", b"!", b"?", b"\n")], np.uint32)


def words(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the number of its sentence. Case is ignored; a sentence ends
    at . ! ? or a line break."""
    tokens = TOKEN.findall((text or "").lower())
    h = np.fromiter((zlib.crc32(t.encode("utf-8", "replace")) for t in tokens), np.uint32, len(tokens))
    end = np.isin(h, ENDS)
    return (h[~end] % BUCKETS).astype(np.int64), np.cumsum(end)[~end]


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per word hash and label, summed over the partition."""
    total = np.zeros((2, BUCKETS), np.int64)
    docs = np.zeros(2, np.int64)
    for batch in batches:
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
            total[toxic, np.unique(words(text)[0])] += 1
            docs[toxic] += 1
    used = np.flatnonzero(total.any(0))
    yield pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array(np.r_[-1, used]),
            "clean": pa.array(np.r_[docs[0], total[0, used]]),
            "toxic": pa.array(np.r_[docs[1], total[1, used]]),
        }
    )


def telling(clean, toxic, docs: tuple[int, int], least: float) -> np.ndarray:
    """Which hashes occur in toxic documents more often by ``least`` standard errors."""
    a, b = docs
    pooled = (clean + toxic) / max(a + b, 1)
    error = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / max(a, 1) + 1 / max(b, 1)))
    p, q = toxic / max(b, 1), clean / max(a, 1)
    return (p - q) / error >= least


def found_words(texts: list[str | None], place: np.ndarray) -> tuple[list, list]:
    """Per text, the telling words and their sentences."""
    features, sentences = [], []
    for text in texts:
        h, sentence = words(text)
        f = place[h]
        features.append(f[f >= 0])
        sentences.append(sentence[f >= 0])
    return features, sentences


def instances(shared):
    """One row per batch: its number of texts, and as 32-bit numbers its labels and what
    ``NoisyOr.flat`` gives."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = found_words(batch["text"].to_pylist(), shared.value["place"])
            pairs, doc = NoisyOr.flat(*found)
            columns = (batch["toxic"].to_numpy(), pairs, doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(batch)])]
                + [pa.array([np.ascontiguousarray(c, "<i4").tobytes()]) for c in columns],
                ["n", "toxic", "pairs", "doc"],
            )

    return find


def sum_losses(shared):
    """``NoisyOr.losses`` summed over the rows of ``instances`` in a partition."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        total = np.zeros(len(model.weight) + 3)
        for batch in batches:
            for row in zip(*(batch[c] for c in ("pairs", "doc", "toxic")), strict=True):
                pairs, doc, y = (np.frombuffer(x.as_buffer(), "<i4") for x in row)
                total += model.losses(pairs.reshape(-1, 2), doc, y)
        yield pa.RecordBatch.from_pydict({"total": pa.array([total.tobytes()], pa.binary())})

    return add


class NoisyOr:
    """A text is clean if no sentence makes it toxic and no leak does. A sentence with telling
    words has the score sigmoid(bias + weights of its distinct words), any other 0."""

    def __init__(self, n: int):
        self.weight = np.ones(n)
        self.bias = -1.0
        self.leak = -2.0

    @staticmethod
    def flat(features: list, sentences: list):
        """Distinct (text, sentence, word) triples, as arrays of sentence number and word, and
        the text of each sentence."""
        sizes = np.fromiter(map(len, features), np.int64, len(features))
        if not sizes.sum():
            return np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(features)), sizes)
        triples = np.unique(
            np.stack([doc, np.concatenate(sentences), np.concatenate(features)], 1).astype(np.int64),
            axis=0,
        )
        new = np.r_[True, (triples[1:, :2] != triples[:-1, :2]).any(1)]
        return np.stack([np.cumsum(new) - 1, triples[:, 2]], 1), triples[new, 0]

    def clean(self, pairs: np.ndarray, doc: np.ndarray, n: int):
        """Logarithm of each text's chance to be clean, and the sentence scores."""
        a = self.bias + np.bincount(pairs[:, 0], self.weight[pairs[:, 1]], len(doc))
        log_q = -np.logaddexp(0, self.leak) - np.bincount(doc, np.logaddexp(0, a), n)
        return log_q, 1 / (1 + np.exp(-a))

    def losses(self, pairs: np.ndarray, doc: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The loss of texts with labels y, and its gradient by weights, bias and leak."""
        log_q, s = self.clean(pairs, doc, len(y))
        q = np.exp(log_q)
        p = np.maximum(1 - q, 1e-9)
        pull = np.where(y == 1, -q / p, 1.0)  # towards clean or toxic
        ga = pull[doc] * s
        return np.r_[
            np.where(y == 1, -np.log(p), -log_q).sum(),
            np.bincount(pairs[:, 1], ga[pairs[:, 0]], len(self.weight)),
            ga.sum(),
            pull.sum() / (1 + np.exp(-self.leak)),
        ]

    def fit(self, features: list, sentences: list, y: np.ndarray) -> None:
        pairs, doc = self.flat(features, sentences)
        self.fit_sums(lambda: self.losses(pairs, doc, y), len(y))

    def fit_sums(self, sums: Callable[[], np.ndarray], n: int, rounds: int = 60) -> None:
        """Fit to n texts by L-BFGS; ``sums`` gives their losses at the present weights."""
        if not n:
            return
        k = len(self.weight)
        ridge = np.r_[np.full(k, 0.1), 0.0, 0.0]

        def at(x: np.ndarray) -> tuple[float, np.ndarray]:
            self.weight, self.bias, self.leak = x[:k], float(x[k]), float(x[k + 1])
            total = sums()
            return (total[0] + ridge @ (x * x) / 2) / n, (total[1:] + ridge * x) / n

        x = np.r_[self.weight, self.bias, self.leak]
        loss, g = at(x)
        steps: list[tuple[np.ndarray, np.ndarray]] = []  # the last moves and gradient changes
        for _ in range(rounds):
            d, used = -g, []
            for move, change in reversed(steps):
                used.append(move @ d / (move @ change))
                d = d - used[-1] * change
            if steps:
                d = d * (steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1])
            for move, change in steps:
                d = d + (used.pop() - change @ d / (move @ change)) * move
            slope = d @ g
            if slope > -1e-9:
                break
            rate = 1.0 if steps else min(1.0, 1 / np.abs(g).sum())
            new, new_g = at(x + rate * d)
            while not new <= loss + 1e-4 * rate * slope and rate > 1e-4:
                rate /= 4
                new, new_g = at(x + rate * d)
            if not new < loss:
                break
            move, change = rate * d, new_g - g
            if move @ change > 1e-12:
                steps = [*steps[-9:], (move, change)]
            small = loss - new < 1e-6 * loss
            x, loss, g = x + move, new, new_g
            if small:
                break
        self.weight, self.bias, self.leak = x[:k], float(x[k]), float(x[k + 1])


def score_texts(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, model = shared.value["place"], shared.value["model"]
        for batch in batches:
            features, sentences = found_words(batch["text"].to_pylist(), place)
            pairs, doc = model.flat(features, sentences)
            log_q, s = model.clean(pairs, doc, len(features))
            # sentence numbers of the flat list, and those whose score alone reaches a half
            numbers = [np.unique(x) for x in sentences]
            ends = np.cumsum([0, *map(len, numbers)])
            worst = [
                numbers[i][s[ends[i] : ends[i + 1]] >= 0.5].tolist() for i in range(len(features))
            ]
            p = np.clip(1 - np.exp(log_q), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(p), pa.array(worst, pa.list_(pa.int32()))],
                ["doc_id", "held_out", "score", "sentences"],
            )

    return score


def score_toxicity(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    modulus: int = 5,
    held: int = 0,
    least: float = 5.0,
    sample: int = 65_536,
) -> DataFrame:
    """Toxicity of each text: ``doc_id, held_out, score, predicted, sentences``.

    Labels are used only where crc32(id) modulo ``modulus`` is not ``held``. Words that occur in
    toxic documents more often by ``least`` standard errors, over all those rows, are telling
    (at most 2^20 hashed counts come to the driver). The noisy-or over sentences is fitted on
    the telling words of at most ``sample`` labelled documents, those with the least hash of
    their id; tasks sum its gradients over the staged words, so the driver holds weights only.
    ``sentences`` numbers the sentences, from 0, whose own score is 0.5 or more.

    Null and empty texts have no sentences and get the leak. Null labels and other values than
    0 and 1 teach nothing, repeated labels and rows count as often as they occur, null ids have
    no label. Without labels all scores are those of an untrained leak. An empty table gives no
    rows; columns other than those named are not read.
    """
    spark = ready(df.sparkSession)
    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    learn = crc_mod("doc_id", modulus) != held
    taught = labels.select(
        F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic")
    ).where(learn & F.col("toxic").isin(0, 1))
    # Labels grow with the texts, so they meet in a shuffle at every size.
    rows = texts.where(learn & F.col("text").isNotNull()).join(taught.hint("merge"), "doc_id")
    counts = (
        rows.select("text", "toxic")
        .mapInArrow(count_words, "bucket long, clean long, toxic long")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toArrow()
    )
    bucket, clean, toxic = (counts[c].to_numpy() for c in ("bucket", "clean", "toxic"))
    docs = tuple(int(x[bucket == -1].sum()) for x in (clean, toxic))
    chosen = np.sort(bucket[telling(clean, toxic, docs, least) & (bucket >= 0)])
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    kind = df.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast({"place": place})
    order = F.xxhash64("doc_id", F.lit(11))
    few = taught.withColumn("order", order).orderBy("order", "doc_id", "toxic").limit(sample)
    few = stage(few, "toxic-sample")  # at most ``sample`` ids, so they can be broadcast
    few = stage(
        texts.join(F.broadcast(few), "doc_id")
        .select("toxic", "text")
        .mapInArrow(instances(shared), "n long, toxic binary, pairs binary, doc binary"),
        "toxic-words",
    )
    model = NoisyOr(len(chosen))
    parts = min(spark.sparkContext.defaultParallelism, 32)  # each sends a gradient per round

    def sums() -> np.ndarray:
        now = spark.sparkContext.broadcast(model)
        got = few.drop("n").coalesce(parts).mapInArrow(sum_losses(now), "total binary").collect()
        now.destroy()
        zero = np.zeros(len(chosen) + 3)
        return sum((np.frombuffer(r["total"]) for r in got), zero)

    model.fit_sums(sums, few.agg(F.sum("n")).first()[0] or 0)
    shared = spark.sparkContext.broadcast({"place": place, "model": model})
    scored = texts.select("doc_id", "text", (~learn).alias("held_out")).mapInArrow(
        score_texts(shared), f"doc_id {kind}, held_out boolean, score double, sentences array<int>"
    )
    return scored.select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "sentences",
    )
