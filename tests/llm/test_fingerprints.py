import hashlib

import numpy as np
import pytest
from cases import corpus, frame, nameless
from hypothesis import given, settings
from hypothesis import strategies as st

from starmill.llm.fingerprints import Paragraphs, differing, digests, fingerprint, likeness, paragraphs

sets = st.sets(st.integers(1, 2**64 - 1), max_size=60)


@settings(max_examples=60, deadline=None)
@given(sets, sets)
def test_peeling_finds_the_difference(a, b):
    a, b = a | {7, 8, 9}, b | {7, 8, 9}
    only_a, only_b = differing(*(Paragraphs(np.array(list(x), np.uint64)) for x in (a, b)))
    assert (set(only_a.tolist()), set(only_b.tolist())) == (a - b, b - a)


def test_small_sketch_fails_and_grows():
    keys = np.random.default_rng(1).integers(1, 2**63, 500).astype(np.uint64)
    full, none = Paragraphs(keys), Paragraphs(keys[:0])
    assert full.sketch(8).minus(none.sketch(8)).peel() is None
    assert full.sketch(128).minus(none.sketch(128)).peel() is None
    assert len(differing(full, none)[0]) == 500


def test_paragraphs_lose_nothing():
    for text in (r[1] or "" for r in corpus()):
        assert "".join(paragraphs(text)) == text


def plain_likeness(a, b):
    a, b = set(digests(a).tolist()), set(digests(b).tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("bytes_per_bucket", [3_000, 1 << 24])
def test_neighbours(spark, bytes_per_bucket):
    rows = corpus()[:-1]
    got = fingerprint(frame(spark, rows), bytes_per_bucket=bytes_per_bucket).collect()
    got = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for i, (doc_id, text, *_) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        n, r = len(text), got[doc_id]
        edited = text[: n - n // 4] + after[: n // 4]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(plain_likeness(text, edited))
        assert r.near_next == pytest.approx(plain_likeness(text, after))
        assert (r.fingerprint == r.edited_fingerprint) == (sorted(digests(text)) == sorted(digests(edited)))
    by_text = {}
    for doc_id, text, *_ in rows:
        by_text.setdefault(text or "", set()).add(got[doc_id].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_awkward_tables(spark):
    rows = nameless(corpus())
    assert fingerprint(frame(spark, rows), bytes_per_bucket=5_000).count() == len(rows)
    assert fingerprint(frame(spark, [])).collect() == []
    one = fingerprint(frame(spark, [(5, "One. Two.", None, None, None)])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(5, 1.0)]


def test_likeness_of_nothing():
    none, one = (Paragraphs(digests(t)) for t in ("", "a"))
    assert likeness(none, none) == 1.0 and likeness(none, one) == 0.0
