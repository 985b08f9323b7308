import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from cases import corpus, frame, nameless, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from starmill.llm import suffixes
from starmill.llm.suffixes import (
    hopeful,
    later_windows,
    least_ranks,
    order_of,
    planes,
    remove_repeats,
    same_windows,
    scramble,
)


def plain(rows, length):
    """Per row: bytes, removed bytes, stretches, digest of the rest, the rest."""
    least = {}
    raws = [(r[0], (r[1] or "").encode()) for r in rows]
    rank = [float("inf") if i is None else i for i, _ in raws]
    for k, (_, raw) in zip(rank, raws, strict=True):
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            least[w] = min(least.get(w, k), k)
    out = []
    for k, (i, raw) in zip(rank, raws, strict=True):
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if least[raw[p : p + length]] < k:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        stretches = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out.append((str(i), len(raw), sum(gone), stretches, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.text("ab", min_size=4, max_size=30), min_size=1, max_size=12),
    st.integers(1, 4),
)
def test_least_ranks(segments, length):
    raw = [s.encode() for s in segments]
    ranks = np.array(random.Random(len(raw)).sample(range(100), len(raw)))
    least = {}
    for r, s in zip(ranks.tolist(), raw, strict=True):
        for p in range(len(s) - length + 1):
            w = s[p : p + length]
            least[w] = min(least.get(w, r), r)
    want = [least[s[p : p + length]] for s in raw for p in range(len(s) - length + 1)]
    assert least_ranks(raw, ranks, length).tolist() == want


@pytest.mark.parametrize("length", [20, 37, 50])
def test_least_ranks_of_long_strings(length):
    """Longer than what the sort begins with, so intervals are extended over many levels."""
    rng = random.Random(length)
    blocks = [prose(i, 9)[: rng.randint(5, 30)] for i in range(6)]
    raw = ["".join(rng.choices(blocks, k=9)).encode() for _ in range(30)]
    raw = [s for s in raw if len(s) >= length]
    ranks = np.array(rng.sample(range(100), len(raw)))
    least = {}
    for r, s in zip(ranks.tolist(), raw, strict=True):
        for p in range(len(s) - length + 1):
            w = s[p : p + length]
            least[w] = min(least.get(w, r), r)
    want = [least[s[p : p + length]] for s in raw for p in range(len(s) - length + 1)]
    assert least_ranks(raw, ranks, length).tolist() == want


def test_order_of_keys_with_and_without_room_for_places():
    key = np.array([7, 3, 1 << 50, 0, 5], np.uint64)
    assert order_of(key, 51).tolist() == order_of(key, 64).tolist() == [3, 1, 4, 0, 2]


def test_hopeful_windows_have_several_ranks():
    h = scramble(np.array([9, 5, 9, 7, 7, 3], np.uint64) * suffixes.FACTORS[0])
    rank = np.array([0, 1, 2, 1, 1, 0], np.uint64)
    assert np.flatnonzero(hopeful(h, rank)).tolist() == [0, 2]
    assert hopeful(h[:0], h[:0]).tolist() == []


def test_different_windows_with_one_hash_stay_apart(monkeypatch):
    text = np.frombuffer(b"abcdabcxabcd", np.uint8)
    place = np.array([0, 4, 8])
    first, number, h = same_windows(text, place, 4)
    assert number[0] == number[2] != number[1] and len(first) == len(h) == 2
    monkeypatch.setattr(suffixes, "window_hashes", lambda t, p, n: np.zeros(len(p), np.uint64))
    first, number, h = same_windows(text, place, 4)
    assert number.tolist() == [0, 1, 0] and first.tolist() == [0, 1] and len(h) == 2


def test_windows_of_batches_meet_in_lots():
    """Ten windows of three batches, sorted two at a time; each batch hears of those that a text
    of lower rank has, wherever that is."""
    words = [f"w{i:03}" for i in range(10)]
    ranks = {7: 5, 8: 2, 9: 5}
    held = {7: [0, 1, 2, 3, 4, 5], 8: [4, 5, 6, 7, 9], 9: [0, 4, 6, 8]}
    payloads = []
    for batch, of in held.items():
        raw = [
            np.array([len(of)], "<i8").tobytes(),
            planes(np.array(of), 4),
            planes(np.diff(np.full(len(of), ranks[batch]), prepend=0), 8),
            "".join(words[i] for i in of).encode(),
        ]
        payloads.append(zstandard.ZstdCompressor().compress(b"".join(raw)))
    part = pa.table({"batch": list(held), "payload": pa.array(payloads, pa.binary())})
    for most in (2, 100):
        got = later_windows(4, most)(part).to_pylist()
        later = {r["batch"]: np.frombuffer(r["later"], "<i4").tolist() for r in got}
        assert later == {7: [4, 5], 9: [4, 6]}


@pytest.mark.parametrize("share", [2000, 3])  # few or many keys dealt window by window
@pytest.mark.parametrize("change", [lambda r: r, nameless])
def test_removed_bytes(spark, share, change):
    rows = change(corpus(24))
    got = remove_repeats(frame(spark, rows), share=share, bytes_per_bucket=20_000).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == plain(rows, 50)


def test_matches_need_the_whole_length_and_stay_in_documents(spark):
    passage = prose(5, 3)[:50]
    rows = [
        (1, "x" + passage + "y", None, None, None),
        (2, passage, None, None, None),
        (3, passage[:49], None, None, None),
        (4, passage[:25], None, None, None),
        (5, passage[25:], None, None, None),
        (6, "é" + passage + "é" + passage, None, None, None),
    ]
    got = {r.doc_id: r for r in remove_repeats(frame(spark, rows), carry=["lang"]).collect()}
    assert [got[i].n_removed for i in range(1, 7)] == [0, 50, 0, 0, 0, 100]
    assert [got[i].n_spans for i in (2, 6)] == [1, 2]
    assert got[6].kept == "éé" and got[2].kept == ""


def test_empty_table(spark):
    assert remove_repeats(frame(spark, [])).collect() == []


def test_a_frequent_passage_is_aggregated_by_window(spark, monkeypatch):
    """A passage with other text around each copy: its key leaves the buckets by its bytes, not
    by its share, and its windows are aggregated before any Python function groups them."""
    staged = {}

    def spy(df, label, *rest, keep=suffixes.stage):
        staged.setdefault(label, []).append(df._jdf.queryExecution().toString())
        return keep(df, label, *rest)

    monkeypatch.setattr(suffixes, "stage", spy)
    passage = prose(1000, 2)
    texts = [f"{prose(i, 3)} {passage} {prose(i + 500, 3)}" for i in range(60)]
    texts += [prose(i, 40) for i in range(1000, 1060)]
    rows = [(i, t, "en", "src0", 1) for i, t in enumerate(texts)]
    got = remove_repeats(frame(spark, rows), share=1, bytes_per_bucket=20_000).collect()
    assert "passage-segments" in staged
    grouped = [p for p in staged["passage-spans"] if "FlatMapGroupsInPandas" in p]
    assert len(grouped) == 1 and len(staged["passage-spans"]) == 2
    assert sorted((str(r[0]), *r[1:]) for r in got) == plain(rows, 50)


def test_a_frequent_passage_sends_a_row_per_batch_and_bucket(spark, monkeypatch):
    """Not one per run, window or join of the two: 300 texts of one batch hold a passage, each
    with other text around it."""
    staged = {}

    def spy(df, label, *rest, keep=suffixes.stage):
        staged.setdefault(label, []).append(keep(df, label, *rest))
        return staged[label][-1]

    monkeypatch.setattr(suffixes, "stage", spy)
    passage = prose(1000, 2)
    texts = [f"{prose(i, 1)} {passage} {prose(i + 500, 1)}" for i in range(300)]
    rows = [(i, t, "en", "src0", 1) for i, t in enumerate(texts)]
    got = remove_repeats(frame(spark, rows).coalesce(1), share=20).collect()
    counts = {label: [df.count() for df in dfs] for label, dfs in staged.items()}
    assert counts.pop("passage-cells") and counts.pop("passage-segments") == [2]
    assert [n <= 300 for n in counts.pop("passage-spans")] == [True, True]
    assert not counts
    assert sorted((str(r[0]), *r[1:]) for r in got) == plain(rows, 50)


def test_spans_are_not_broadcast(spark, conf):
    """However small their files are: equal spans of many texts take little room there."""
    conf(spark__sql__autoBroadcastJoinThreshold="10MB")
    passage = prose(3)
    rows = [(i, f"{i} {passage}") for i in range(20)]
    df = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.n_removed for r in df.collect()}
    assert got[0] == 0
    assert all(got[i] >= len(passage) for i in range(1, 20))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "Broadcast" not in plan
