from fractions import Fraction

import pytest
from cases import corpus, frame, nameless, prose
from hypothesis import given
from hypothesis import strategies as st

from starmill.llm.mixing import fill, mix, sainte_lague, take_words

parties = st.lists(st.tuples(st.integers(0, 50), st.integers(0, 30)), min_size=1, max_size=8)


@given(parties, st.integers(0, 80))
def test_highest_quotients_win(rows, seats):
    weights, caps = zip(*rows, strict=True)
    quotients = sorted(
        (-Fraction(w, 2 * k + 1), i) for i, (w, c) in enumerate(rows) for k in range(c)
    )
    want = [0] * len(rows)
    for _, i in quotients[:seats]:
        want[i] += 1
    assert sainte_lague(weights, seats, caps) == want


def test_full_sources_hand_on():
    targets = fill([100, 10, 300], [5, 2, 1], 1.5, 2.0)
    assert targets == [200, 20, 395]
    assert fill([], [], 1.5, 2.0) == [] and fill([0, 0], [5, 2], 1.5, 2.0) == [0, 0]


@pytest.mark.parametrize("change", [lambda r: r, nameless])
def test_mix(spark, change):
    rows = change(corpus())
    df = frame(spark, rows)
    got = mix(df, docs_per_shard=10).collect()
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").encode().split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = fill([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2)
    for i, name in enumerate(names):
        mine = [r for r in got if r.source_number == i]
        assert len(mine) == sum(r[3] == name for r in rows)
        assert {(r.source_size, r.target) for r in mine} == {(sizes[name], targets[i])}
        assert abs(sum(r.taken for r in mine) - targets[i]) <= 16 * len({r.shard for r in mine})
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    again = mix(frame(spark, rows[::-1]), docs_per_shard=10).collect()
    key = lambda r: (str(r.doc_id), r["size"], r.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_taken_words(spark):
    rows = [(1, " a b\tc", 3, 2), (2, "a b", 2, 4), (3, "a b c", 3, 5), (4, "a", 1, 0), (5, None, 0, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, size long, taken long")
    got = {r.doc_id: r.text for r in take_words(df, "text", "size", "taken").collect()}
    assert got == {1: " a b", 2: "a b\na b", 3: "a b c\na b"}


def test_one_large_source_is_dealt_over_shards(spark):
    rows = [(i, prose(i, 1), "big" if i % 3 else f"s{i % 5}", None, None) for i in range(600)]
    rows = [(*r[:2], None, r[2], None) for r in rows]
    got = mix(frame(spark, rows), docs_per_shard=50).collect()
    big = [r for r in got if r.source_number == 0]
    assert len({r.shard for r in big}) == 12


def test_empty_table(spark):
    assert mix(frame(spark, [])).collect() == []
