import math
import random
from collections import Counter

import numpy as np
import pytest
from cases import frame, nameless

from starmill.llm.langid import BITS, CLASSES, ORDER, Models, distinct, grams, identify, levels, probability

WORDS = {
    "de": "der die das und ist nicht ein eine mit für haus straße gegen über schön grün".split(),
    "en": "the of and that house street with from would there where which should green".split(),
    "es": "el la los que una con para calle casa verde donde porque también niño señor".split(),
}


def text(lang, seed, n=30):
    return " ".join(random.Random(f"{lang}{seed}").choices(WORDS[lang], k=n)).capitalize() + "."


def corpus():
    rows = [
        (i, text(lang, i), lang, f"src{i % 3}", 1)
        for i, lang in enumerate(sorted(WORDS) * 60)
    ]
    rows += [
        (500, None, "en", None, None),
        (501, "", "en", "src0", 0),
        (502, "12 ... !!", None, "src0", 0),
        (503, "qxzjvk " * 50, None, None, None),
        (504, text("de", 9, 20_000), None, None, None),
        (505, "Der", None, None, None),
        (505, "Der", None, None, None),
    ]
    return rows


def test_models_are_interpolated_kneser_ney():
    """Against the textbook recursion over dictionaries, and every context sums to one."""
    code = np.concatenate([grams(text("de", i)) for i in range(20)])
    model = levels(*distinct(code))
    tuples = Counter(
        tuple(int(c) >> BITS * (ORDER - 1 - k) & CLASSES - 1 for k in range(ORDER)) for c in code
    )
    tables = [tuples]
    for _ in range(ORDER - 1):
        tables.append(Counter(t[1:] for t in tables[-1]))

    def p(t):
        if not t:
            return 1 / CLASSES
        table = tables[ORDER - len(t)]
        ones, twos = (sum(v == k for v in table.values()) for k in (1, 2))
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        same = [v for k, v in table.items() if k[:-1] == t[:-1]]
        if not same:
            return p(t[1:])
        return max(table[t] - d, 0) / sum(same) + d * len(same) / sum(same) * p(t[1:])

    for t in [*list(tuples)[:50], (1, 2, 3, 4), (0, 0, 0, 63)]:
        number = sum(c << BITS * (ORDER - 1 - k) for k, c in enumerate(t))
        assert math.isclose(probability(model, np.array([number], np.uint32))[0], p(t), rel_tol=1e-9)
    for context in (int(code[5]) >> BITS, 0, 4242):
        every = (np.uint32(context) << np.uint32(BITS)) | np.arange(CLASSES, dtype=np.uint32)
        assert math.isclose(probability(model, every).sum(), 1.0, rel_tol=1e-9)


def test_predictions(spark):
    rows = corpus()
    got = {r.doc_id: r for r in identify(frame(spark, rows)).collect()}
    held = [r for r in rows[:180] if got[r[0]].held_out]
    assert len(held) > 20
    assert all(got[r[0]].lang_pred == r[2] and not got[r[0]].rejected for r in rows[:180])
    for i in (500, 501, 502):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[503].lang_pred in WORDS and got[503].rejected
    assert got[504].lang_pred == got[505].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_are_not_learned(spark):
    rows = corpus()
    held = {r.doc_id for r in identify(frame(spark, rows)).collect() if r.held_out}
    other = [(r[0], r[1], "xx" if r[0] in held else r[2], r[3], r[4]) for r in rows]
    a, b = (
        sorted((r.doc_id, r.lang_pred, r.score) for r in identify(frame(spark, x)).collect())
        for x in (rows, other)
    )
    assert a == b


def test_nameless_rows_and_nothing_learned(spark):
    rows = nameless(corpus())
    assert identify(frame(spark, rows)).count() == len(rows)
    rows = [(i, text("en", i), None, None, None) for i in range(5)]
    got = identify(frame(spark, rows)).collect()
    assert {(r.lang_pred, r.score, r.rejected) for r in got} == {("und", 0.0, True)}


def test_empty_table(spark):
    assert identify(frame(spark, [])).collect() == []


def test_no_model_without_counts():
    assert Models({}).entropies("text") == (None, 0)


@pytest.mark.parametrize("same", [("ABC", "abc"), ("a  b", "a.b"), ("É", "é")])
def test_case_and_other_characters(same):
    assert grams(same[0]).tolist() == grams(same[1]).tolist()
