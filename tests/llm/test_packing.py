import zlib

import numpy as np
import pytest
from cases import corpus, frame, nameless
from hypothesis import given, settings
from hypothesis import strategies as st

from starmill.llm import packing
from starmill.llm.packing import Encoder, first_fit_decreasing, pack, sequences

tokenizers = pytest.importorskip("tokenizers")
PATH = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    made = tokenizers.Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


parts = [*"aÉ1.'\n\t \x1c\xa0漢½²", "  ", "'s ", " <|endoftext|>", " to.\nBe,", "don't", " x,"]


@settings(deadline=None, max_examples=400)
@given(st.one_of(st.text(max_size=30), st.lists(st.sampled_from(parts)).map("".join)))
def test_both_libraries_give_the_same_ids(text):
    encoder = Encoder.of(open(PATH, encoding="utf-8").read())
    assert encoder.fast
    want = ids_of(encoder.tokenizer, text)
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want


def test_other_tokenizers_are_not_taken_for_byte_level_ones():
    import json

    with open(PATH, encoding="utf-8") as f:
        definition = json.load(f)
    assert len(packing.merge_ranks(definition)) == 50_256
    assert packing.merge_ranks(definition | {"normalizer": {"type": "Lowercase"}}) is None
    swapped = definition["model"]["merges"]
    swapped[0], swapped[1] = swapped[1], swapped[0]
    assert packing.merge_ranks(definition) is None


@given(st.lists(st.integers(1, 100), min_size=1, max_size=80))
def test_tournament_is_first_fit(lengths):
    lengths = np.array(sorted(lengths, reverse=True))
    bins, offsets = first_fit_decreasing(lengths, 100)
    filled = []
    for size, b, o in zip(lengths, bins, offsets, strict=True):
        place = next((i for i, f in enumerate(filled) if f + size <= 100), len(filled))
        if place == len(filled):
            filled.append(0)
        assert (b, o) == (place, filled[place])
        filled[place] += size


@pytest.mark.parametrize("change", [lambda r: r, nameless])
def test_pieces_and_sequences(spark, tokenizer, change):
    rows = change(corpus())
    made = pack(frame(spark, rows), PATH, docs_per_group=10, with_ids=True).cache()
    got = made.collect()
    want = []
    for r in rows:
        ids = [*ids_of(tokenizer, r[1]), 0]
        for at in range(0, len(ids), 1024):
            piece = np.array(ids[at : at + 1024], "<u4")
            want.append((str(r[0]), at, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
    assert sorted((str(r.doc_id), *r[1:5]) for r in got) == sorted(want)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids))
    for pieces in by_sequence.values():
        end = 0
        for offset, length, _ in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024
    read = {r.sequence_id: r.ids for r in sequences(made).collect()}
    assert read == {s: [i for p in sorted(ps) for i in p[2]] for s, ps in by_sequence.items()}


def test_empty_table(spark):
    assert pack(frame(spark, []), PATH).collect() == []


@pytest.mark.parametrize("text", ["end of page<|endoftext|>next", "<|endoftext|>", "Ωд <|endoftext|> 漢ಅ"])
def test_added_tokens_are_those_of_the_unmodified_tokenizer(text):
    encoder = Encoder.of(open(PATH, encoding="utf-8").read(), added=True)
    want = tokenizers.Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert 50_256 in want
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want


def test_the_query_and_the_pipeline_take_added_tokens(spark, tmp_path):
    import corpus_pipeline

    from starmill.llm.queries import op5_first_fit

    text = "end of page<|endoftext|>next"
    rows = frame(spark, [(1, text, "en", "src0", len(text))])
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    want = len(tokenizers.Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids) + 1
    assert [r.doc_tokens for r in op5_first_fit(spark, str(tmp_path)).collect()] == [want]
    assert [r.doc_tokens for r in corpus_pipeline.packing(spark, rows, "").collect()] == [want]
