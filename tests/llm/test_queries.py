"""Registered queries against their SQL, and the pipeline, on the smallest tables."""

import os
import sys

import pytest
from cases import corpus, frame, nameless

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]
FOLDER = "/root/testdata/sf0.001"

import corpus_pipeline  # noqa: E402
from check_oracles import compare, open_tables  # noqa: E402
from starmill.llm.langid import identify  # noqa: E402
from starmill.llm.mixing import mix  # noqa: E402
from starmill.llm.queries import ORACLES, QUERIES  # noqa: E402
from starmill.llm.simhash import near_duplicates  # noqa: E402


def test_operators_in_their_order():
    assert [f"op{n}" for n in range(1, len(QUERIES) + 1)] == [name.split("_")[0] for name in QUERIES]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    outcome = compare(QUERIES[name](spark, FOLDER), open_tables(FOLDER), ORACLES[name])
    assert outcome.startswith("ok"), outcome


def run_stages(spark, rows):
    docs, seen = frame(spark, rows), {}
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, "").cache()
        seen[name] = docs
    return seen


def test_pipeline_follows_its_operators(spark):
    rows = corpus()[:-1]
    given = frame(spark, rows)
    seen = run_stages(spark, rows)
    for name in list(seen)[:-1]:
        assert seen[name].columns == corpus_pipeline.COLUMNS
    rejected = {r.doc_id for r in identify(given).collect() if r.rejected}
    first = {r.doc_id: r for r in seen["language_id"].collect()}
    assert set(first) == {r[0] for r in rows} - rejected
    assert all(r.lang for r in first.values())
    kept = {r.doc_id for r in near_duplicates(seen["language_id"]).collect() if r[0] == r[2]}
    second = {r.doc_id: r.text for r in seen["simhash_near_dedup"].collect()}
    assert set(second) == kept
    windows = set()
    for doc_id, text in sorted(second.items()):
        raw = text.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if raw[p : p + 50] in windows:
                gone[p : p + 50] = b"\1" * 50
        windows |= {raw[p : p + 50] for p in range(len(raw) - 49)}
        rest = bytes(b for b, g in zip(raw, gone, strict=True) if not g).decode("utf-8", "ignore")
        second[doc_id] = rest
    third = {r.doc_id: r for r in seen["suffix_array_dedup"].collect()}
    assert {i: r.text for i, r in third.items()} == second
    assert all(r.n_chars == len(r.text) for r in third.values())
    taken = {r.doc_id: r.taken for r in mix(seen["suffix_array_dedup"]).collect() if r.taken}
    fourth = {r.doc_id: r.text for r in seen["mixing"].collect()}
    assert {i: len(t.encode().split()) for i, t in fourth.items()} == taken
    for i, text in fourth.items():
        once = second[i].encode().split()
        assert text.encode().split() == (once * 2)[: taken[i]]
    pieces = {}
    for r in seen["packing"].collect():
        pieces[r.doc_id] = pieces.get(r.doc_id, 0) + r.length
        assert r.doc_tokens >= r.start + r.length
    assert set(pieces) == set(fourth)


def test_pipeline_with_awkward_rows(spark):
    seen = run_stages(spark, nameless(corpus(20)))
    assert seen["packing"].count() > 0
    seen = run_stages(spark, [])
    assert all(df.isEmpty() for df in seen.values())
