import hashlib
import random

import pytest
from cases import corpus, frame, nameless, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from starmill.llm import alignment
from starmill.llm.alignment import Aligner, Closed, Fragment, align, aligned_tokens, groups_of

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
public = pytest.importorskip("public_tokenizers")
A_PATH, B_PATH = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def aligner():
    with open(A_PATH, encoding="utf-8") as f, open(B_PATH, "rb") as g:
        return Aligner.of(f.read(), g.read())


@pytest.fixture(scope="module")
def libraries():
    first = tokenizers.Tokenizer.from_file(A_PATH)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def plain_groups(aligner, libraries, text):
    """Groups by the libraries' own tokens of the whole text."""
    first, second = libraries
    if not text:
        return []
    a = first.encode(" " + text, add_special_tokens=False).ids
    b = second.encode(text)
    want = (" " + text).encode()
    for ids, token_bytes in ((a, aligner.first_bytes), (b, aligner.second_bytes)):
        if b"".join(token_bytes[i] for i in ids) != want:
            return []
    groups, left, right, i, j, x, y = [], [], [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if x <= y:
            x += len(aligner.first_bytes[a[i]])
            left.append(a[i])
            i += 1
        else:
            y += len(aligner.second_bytes[b[j]])
            right.append(b[j])
            j += 1
        if x == y:
            groups.append((left, right))
            left, right = [], []
    return groups


def plain(aligner, libraries, texts):
    made = [plain_groups(aligner, libraries, t) for t in texts]
    count, best = {}, {}
    for groups in made:
        for pair in {(p, q) for left, right in groups for p in left for q in right}:
            count[pair] = count.get(pair, 0) + 1
    for (p, _), n in count.items():
        best[p] = max(best.get(p, 0), n)
    out = []
    for groups in made:
        links = [(p, q) for left, right in groups for p in left for q in right]
        written = ";".join(
            ",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups
        )
        out.append((
            sum(len(left) for left, _ in groups),
            sum(len(right) for _, right in groups),
            len(groups),
            len(links),
            sum(count[x] == best[x[0]] for x in links),
            sum(count[x] for x in links),
            hashlib.sha256(written.encode()).hexdigest() if groups else "",
        ))
    return out


def listed(closed):
    out, i, j = [], 0, 0
    for x, y in zip(closed.na.tolist(), closed.nb.tolist(), strict=True):
        out.append((closed.a[i : i + x].tolist(), closed.b[j : j + y].tolist()))
        i, j = i + x, j + y
    return out if closed.sound else []


parts = ["a", "É", "1", ".", "'s", "\n", "\t", " ", "  ", "\x1c", "\xa0", "漢字", "½", "☃", "x " * 3,
         "<|endoftext|>", "</s>", "<unk>", "<0x41>", " to", "be,", "🙂👍", "　", "don't", "=" * 9]
texts = st.one_of(st.text(max_size=40), st.lists(st.sampled_from(parts)).map("".join))


@settings(deadline=None, max_examples=300)
@given(texts)
def test_words_give_the_tokens_of_the_whole_text(aligner, libraries, text):
    want = plain_groups(aligner, libraries, text)
    assert (listed(aligner.close([text])[0]) if text else []) == want


@settings(deadline=None, max_examples=300)
@given(texts.filter(bool), st.integers(1, 7), st.randoms(use_true_random=False))
def test_fragments_compose_in_any_grouping(aligner, libraries, text, size, rng):
    pieces = [text[i : i + size] for i in range(0, len(text), size)]
    fragments = Fragment.of(aligner, pieces)
    while len(fragments) > 1:
        i = rng.randrange(len(fragments) - 1)
        n = rng.randint(2, 4)
        fragments[i : i + n] = [Fragment.composed(aligner, fragments[i : i + n])]
        packed = dict(zip(alignment.FIELDS, fragments[i].packed(), strict=True))
        fragments[i] = Fragment.unpacked(packed)
    assert listed(fragments[0].whole(aligner)) == plain_groups(aligner, libraries, text)


def test_kept_words_are_forgotten_and_long_ones_not_kept(aligner, monkeypatch):
    before = listed(aligner.close([prose(1)])[0])
    monkeypatch.setattr(alignment, "WORDS_KEPT", 3)
    monkeypatch.setattr(alignment, "LONGEST_KEPT", 4)
    assert listed(aligner.close([prose(2), prose(1)])[1]) == before
    aligner.close(["a b"])
    assert all(len(w) <= 4 for w in aligner.known)


@pytest.mark.parametrize("change", [lambda r: r, nameless])
def test_against_brute_force(spark, aligner, libraries, change):
    rows = change([*corpus(), (900, "ab▁cd ef", "en", "s", 1), (901, " x  y ", "en", "s", 1)])
    got = align(frame(spark, rows), A_PATH, B_PATH, part_chars=500, lot_tokens=3000).collect()
    want = plain(aligner, libraries, [r[1] for r in rows])
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, *[r[c] for c in COLUMNS]) for r in got), key=key) == sorted(
        ((r[0], *w) for r, w in zip(rows, want, strict=True)), key=key
    )


def test_long_groups_in_blocks(monkeypatch):
    rng = random.Random(4)
    a, b = [rng.randrange(9) for _ in range(400)], [rng.randrange(7) for _ in range(300)]
    import numpy as np

    sizes = [np.array(x) for x in (a, b, [390, 10], [250, 50])]
    want = {}
    for left, right in ((a[:390], b[:250]), (a[390:], b[250:])):
        for p in left:
            for q in right:
                want[p * 100 + q] = want.get(p * 100 + q, 0) + 1
    for at_once in (1, 20, 10**6):
        monkeypatch.setattr(alignment, "LINKS_AT_ONCE", at_once)
        blocks = list(alignment.links_of(*sizes, 100))
        got = [pair for codes, n in blocks for pair in zip(codes.tolist(), n.tolist(), strict=True)]
        assert len(got) == len(want) and dict(got) == want


def test_groups_as_rows(spark, aligner, libraries):
    rows = corpus(6)
    tokens = aligned_tokens(frame(spark, rows), A_PATH, B_PATH, part_chars=300)
    got = {}
    for r in groups_of(tokens).orderBy("place").collect():
        got.setdefault(r.doc_id, []).append((r.a_ids, r.b_ids))
    for r in rows[:-2]:  # but the one that comes twice
        assert got.get(r[0], []) == plain_groups(aligner, libraries, r[1])


def test_empty_table(spark):
    assert align(frame(spark, []), A_PATH, B_PATH).collect() == []


def test_closed_groups_of_nothing():
    assert listed(Closed.empty()) == []
