import random

import numpy as np
from cases import frame, nameless, prose

from starmill.llm.toxicity import NoisyOr, score_toxicity, words


def corpus(n=400):
    rows, labels = [], []
    rng = random.Random(3)
    for i in range(n):
        text, toxic = prose(i, 6), int(i % 4 == 0)
        if toxic:
            at = rng.randrange(6)
            parts = text.split(". ")
            parts[at] += " you " + rng.choice(["Vile", "rotten###", "nasty"])
            text = ". ".join(parts)
        rows.append((i, text, "en", "src0", 1))
        labels.append((i, 1, toxic))
    rows += [
        (n, None, None, None, None),
        (n + 1, "", None, None, None),
        (n + 2, "All fine. What a vile thing! Good.\nAnd a nasty one", None, None, None),
        (n + 2, "All fine. What a vile thing! Good.\nAnd a nasty one", None, None, None),
        (n + 3, prose(1, 3000), None, None, None),
    ]
    labels += [(n, 1, 1), (n + 1, 0, None), (None, 1, 1), (3, 1, 7), (5, 1, 0)]
    return rows, labels


def taught(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr(
        "*", "'clash' AS text", "'clash' AS score"
    )


def test_scores_and_sentences(spark):
    rows, labels = corpus()
    found = score_toxicity(frame(spark, rows), taught(spark, labels)).collect()
    assert len(found) == len(rows)
    got = {r.doc_id: r for r in found}
    held = [(r[0], r[2]) for r in labels[:400] if got[r[0]].held_out]
    assert len(held) > 40
    assert np.mean([got[i].predicted == y for i, y in held]) > 0.95
    assert got[402].sentences == [1, 4] and got[402].predicted == 1
    assert got[400].score == got[401].score < 0.5 and not got[403].predicted
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)


def test_held_out_labels_are_not_learned(spark):
    rows, labels = corpus(200)
    a = score_toxicity(frame(spark, rows), taught(spark, labels)).collect()
    held = {r.doc_id for r in a if r.held_out}
    other = [(i, q, 1 - y if i in held and y in (0, 1) else y) for i, q, y in labels]
    b = score_toxicity(frame(spark, rows), taught(spark, other)).collect()
    key = lambda r: (r.doc_id, r.score)
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_gradient_of_the_noisy_or():
    """The fit lowers the loss, and one sentence with a telling word is enough."""
    features = [np.array([0]), np.array([1, 1]), np.array([0, 1]), np.zeros(0, int)] * 10
    sentences = [np.array([0]), np.array([0, 2]), np.array([1, 1]), np.zeros(0, int)] * 10
    y = np.array([1, 0, 1, 0] * 10)
    model = NoisyOr(2)
    model.fit(features, sentences, y)
    log_q, _ = model.clean(*model.flat(features, sentences), len(y))
    assert ((1 - np.exp(log_q) >= 0.5) == (y == 1)).all()


def test_awkward_tables(spark):
    rows, labels = corpus(60)
    few = nameless(rows)
    assert score_toxicity(frame(spark, few), taught(spark, labels)).count() == len(few)
    assert score_toxicity(frame(spark, []), taught(spark, [])).collect() == []
    got = score_toxicity(frame(spark, rows), taught(spark, [])).collect()
    assert {r.predicted for r in got} == {0}


def test_words():
    h, sentence = words("You VILE. you! a1b\n\nvile")
    assert sentence.tolist() == [0, 0, 1, 2, 2, 4]
    assert h[1] == h[5] and h[0] == h[2] and words(None)[0].size == 0


def test_words_twice_as_frequent_in_toxic_documents_teach(spark):
    """Significant words need no multiple of their clean frequency: no toxic text here has a
    word that is three times as frequent in toxic texts."""
    rng = random.Random(5)
    hints = ["grim", "sour", "bleak", "harsh", "stern", "crude", "blunt", "coarse"]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 2
        said = [w for w in hints if rng.random() < (0.9 if toxic else 0.4)]
        rows.append((i, f"{prose(i, 1)} {' '.join(said)}.", "en", "src0", 1))
        labels.append((i, 1, toxic))
    got = score_toxicity(frame(spark, rows), taught(spark, labels)).collect()
    held = [r for r in got if r.held_out]
    assert len({r.score for r in held}) > 5
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.85
