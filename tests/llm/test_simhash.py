import itertools
import re

import numpy as np
import pytest
import xxhash
from cases import corpus, frame, nameless
from pyspark.sql import functions as F

from starmill.llm import simhash as module
from starmill.llm.links import components
from starmill.llm.simhash import links_of, near, near_duplicates, simhash, spanning_links


def plain(text, shingle=3):
    """The definition, bit by bit."""
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(n)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def groups(fps, ids, distance=3):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= distance:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    roots = [find(i) for i in range(len(fps))]
    least = {}
    for root, id_ in zip(roots, ids, strict=True):
        if id_ is not None and (root not in least or id_ < least[root]):
            least[root] = id_
    return [least.get(r) for r in roots]


@pytest.mark.parametrize("text", [None, "", "  ", "One", "Two w", "A b C d É", "x " * 70_000])
def test_fingerprint_is_the_definition(text):
    assert simhash(text) % 2**64 == plain(text)


@pytest.mark.parametrize("change", [lambda r: r, nameless])
def test_components(spark, change):
    rows = change(corpus())
    got = near_duplicates(frame(spark, rows), block=5, per_bucket=50).collect()
    fps = [plain(r[1]) for r in rows]
    want = groups(fps, [r[0] for r in rows])
    want = sorted((str(r[0]), f"{fp:016x}", str(c)) for r, fp, c in zip(rows, fps, want, strict=True))
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == want


def test_chain_of_links(spark):
    """Each step flips three bits, so the ends are far apart but in one component."""
    fps = [0]
    for i in range(20):
        fps.append(fps[-1] ^ (0b111 << 3 * i))
    array = np.array(fps, np.uint64)
    links = spanning_links(array, 3)
    assert sum(len(b) for _, b in links) == len(fps) - 1
    pairs = [(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)]
    df = spark.createDataFrame(pairs, "a long, b long")
    roots = {r.node: r.root for r in components(df).collect()}
    assert roots == {**{i: 0 for i in range(1, 201)}, 501: 500}


def test_three_bits_link_and_four_do_not():
    base = np.array([0], np.uint64)
    for bits, linked in ((0, True), (0b111, True), (1 | 1 << 20 | 1 << 40, True), (0b1111, False)):
        assert near(base, np.uint64(bits), 3)[0] == linked


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).collect() == []


def test_index_entries_are_not_broadcast(spark, conf, monkeypatch):
    """However small the fingerprints are said to be: there are many times as many entries."""
    conf(spark__sql__autoBroadcastJoinThreshold="10MB")
    plans = []

    def watched(df, label):
        rows = df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return spark.createDataFrame(rows, df.schema)

    monkeypatch.setattr(module, "stage", watched)
    base = F.xxhash64(F.floor(F.col("id") / 2))
    fps = spark.range(200).select(base.bitwiseXOR(F.col("id") % 2).alias("fp"))
    links = links_of(fps, 3, 4, 20_000, 200_000).distinct().collect()
    assert len(links) == 100
    assert all((r.a ^ r.b) == 1 for r in links)
    assert len(plans) == 1
    assert "SortMergeJoin" in plans[0]
    assert "Broadcast" not in plans[0]
