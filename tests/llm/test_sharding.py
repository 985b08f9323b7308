import zlib

import pytest
from cases import corpus, frame, nameless, prose

from starmill.llm.sharding import shard_by_bytes


def check(rows, got, shards):
    want = sorted(
        (str(r[0]), len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows
    )
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == want
    for shard in range(shards):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert {r.law for r in got} <= {"bytes"} and {r.grown_shard for r in got} <= {None}


@pytest.mark.parametrize("change", [lambda r: r, nameless])
def test_every_row_has_one_slot(spark, change):
    rows = change(corpus())
    got = shard_by_bytes(frame(spark, rows), shards=4, rows_per_part=5).collect()
    check(rows, got, 4)


def test_sizes_are_near_equal_and_copies_stay_together(spark):
    rows = [(i, prose(i % 700, 3), None, None, None) for i in range(2000)]
    got = shard_by_bytes(frame(spark, rows), shards=10, tolerance=0.02).collect()
    check(rows, got, 10)
    sizes = [sum(r["size"] for r in got if r.shard == s) for s in range(10)]
    assert max(sizes) < 1.05 * min(sizes)
    places = {}
    for r in got:
        places.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(p) > 1 for p in places.values()) <= 9


def test_a_text_in_a_third_of_the_rows_is_cut(spark):
    rows = [(i, "same" if i % 3 else prose(i, 1), None, None, None) for i in range(1500)]
    got = shard_by_bytes(frame(spark, rows), shards=8).collect()
    check(rows, got, 8)
    sizes = [sum(r["size"] for r in got if r.shard == s) for s in range(8)]
    assert max(sizes) < 1.05 * min(sizes)


def test_native(spark):
    plan = shard_by_bytes(frame(spark, corpus()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert shard_by_bytes(frame(spark, [])).collect() == []
