import hashlib
import random
import re

import pytest
from cases import corpus, frame, nameless, prose
from pyspark.sql import functions as F

from starmill.llm import private
from starmill.llm.private import (
    KINDS, Split, best_split, cells, digest_private, doubtful, find_private, fit, proposals, redact,
    running_sum, spans,
)

# The base patterns as they were asked for.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    """Base spans by the definition: (start, kind, end)."""
    out = []
    for i, kind in enumerate(KINDS):
        for m in re.finditer(PLAIN[kind], text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), i, m.end()))
    return sorted(out)


def written(found):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


PARTS = ["a", "b.c", "@", ".", "-", "+", "_", " ", "  ", "1", "12", "255", "256", "0", "00", "4111", "1111",
         "4111111111111111", "378282246310005", "(", ")", "é", "漢", "🙂", "\n", "x@y.zz", "1.2.3.4", "+1 (988) 555-2485",
         "tel ", "\t", "%", " "]


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(n)]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    texts = [*odd_texts(1500), "a" * 2000, "1 " * 2000, "1." * 2000, "a@" + "b." * 2000 + "c",
             "9" * 2000, "+1" + "2 " * 2000, "x@y.zz" * 200]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    found = proposals(df).select(
        "doc_id", F.filter("spans", lambda s: s["passed"]).alias("spans")
    )
    got = {
        r.doc_id: sorted((s.start, s.features.kind, s.end) for s in r.spans) for r in found.collect()
    }
    for i, text in enumerate(texts):
        assert got[i] == plain(text), repr(text[:200])


def test_long_runs_take_linear_time(spark):
    """Texts on which the plain patterns would go back over long runs again and again."""
    texts = ["a" * 200_000, "1 " * 100_000, "1." * 50_000, "a@" + "b." * 60_000 + "c", "9" * 300_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = [spans(F.col("text"), private.BASE[k], private.NEEDS[k]) for k in KINDS]
    counts = df.select(*[F.size(x) for x in found]).collect()
    assert [tuple(r) for r in counts] == [
        (0, 0, 0, 0), (0, 0, 1, 0), (0, 12_500, 0, 0), (1, 0, 0, 0), (0, 0, 1, 0)
    ]


def test_context_and_places(spark):
    df = spark.createDataFrame([("🙂 ab12cd345ef",), ("",), ("none",)], "t string")
    rows = [r[0] for r in df.select(spans(F.col("t"), "[0-9]+")).collect()]
    assert [tuple(s) for s in rows[0]] == [(4, 6, "12", "🙂 ab", "cd"), (8, 11, "345", "cd", "ef")]
    assert rows[1:] == [[], []]
    sums = spark.range(1).select(running_sum(F.array(*[F.lit(i) for i in range(1, 12)]))).first()[0]
    assert sums == [i * (i + 1) // 2 for i in range(1, 12)]


def people(n=60, seed=5):
    """Documents with personal data in its plain forms, and numbers that are none."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        digits = lambda k: "".join(rng.choices("0123456789", k=k))
        body = digits(14)
        card = next(f"4{body}{d}" for d in range(10) if luhn(f"4{body}{d}"))
        out.append((i, f"{prose(i, 1)} mail ab{i}.{digits(2)}@host{i}.example.com {prose(i, 1)}"
                       f" ring +1 ({digits(3)}) 555-{digits(4)} {prose(i + 9, 1)} paid by {card} from"
                       f" 10.{rng.randrange(256)}.{rng.randrange(256)}.7 since version 3.1 {prose(i, 1)}"))  # fmt: skip
    return out


WRITTEN_OUT = [
    ("reach bob (at) example (dot) com today", [("email", "bob (at) example (dot) com")]),
    ("jürgen.x@mail.de", [("email", "jürgen.x@mail.de"), ("email", "rgen.x@mail.de")]),
    ("please call (988) 555-2485 now", [("phone", "(988) 555-2485")]),
    ("from 10[.]0[.]0[.]1 again", [("ip", "10[.]0[.]0[.]1")]),
    ("card 4111.1111.1111.1111 paid", [("card", "4111.1111.1111.1111")]),
]
NOTHING = [
    "nums 1200 1300 1400 1500 and 77 88", "on 2024-01-15 at 12:30:45", "order no. 988-555-2485",
    "version 3.1.4, section 2.10.7", "id 4111.1111.1111.1112", "std::vector ab::cd", "look at dot matrix",
    "password=e3b3ed3cc8548923d6", "1.234.567,89 EUR", "write to me @ noon",
]


@pytest.fixture(scope="module")
def found(spark):
    rows = people() + [(1000 + i, t) for i, (t, _) in enumerate(WRITTEN_OUT)]
    rows += [(2000 + i, t) for i, t in enumerate(NOTHING)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return find_private(df, keep_text=True).cache()


def test_proposals_written_out_are_found_and_clean_texts_left_alone(found):
    got = {r.doc_id: r for r in found.collect()}
    for i, (text, want) in enumerate(WRITTEN_OUT):
        spans_of = [(KINDS[s.kind], text[s.start : s.end]) for s in got[1000 + i].spans]
        assert sorted(spans_of) == sorted(want)
    for i, text in enumerate(NOTHING):
        assert [text[s.start : s.end] for s in got[2000 + i].spans] == []
    for i, text in people():
        assert sorted((s.start, s.kind, s.end) for s in got[i].spans) == plain(text)


def test_redaction(found):
    got = {r.doc_id: r.text for r in redact(found).collect()}
    assert got[1000] == "reach [email] today"
    assert got[1001] == "[email]"
    assert got[2000] == NOTHING[0]
    assert "@" not in got[0] and "555" not in got[0]


@pytest.mark.parametrize("change", [lambda r: r, nameless])
def test_digest_against_brute_force(spark, change):
    texts = [t for _, t in people(12)] + odd_texts(40, 9)
    rows = change([*corpus(), *[(500 + i, t, "en", "s", 1) for i, t in enumerate(texts)]])
    got = digest_private(find_private(frame(spark, rows), rounds=2))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    got = got.collect()
    want = []
    for r in rows:
        base = plain(r[1])
        n = [sum(k == i for _, k, _ in base) for i in range(4)]
        want.append((str(r[0]), *n, hashlib.sha256(written(base).encode()).hexdigest()))
    assert sorted((str(r.doc_id), *r[1:6]) for r in got) == sorted(want)
    for r in got:
        parts = [p.split(":") for p in r.spans.split(",") if p]
        keys = [(int(a), KINDS.index(k), int(b)) for k, a, b in parts]
        assert keys == sorted(set(keys))


def test_no_spans_at_all(spark):
    assert find_private(frame(spark, [])).collect() == []
    got = find_private(spark.createDataFrame([(1, "nothing"), (2, None)], "doc_id long, text string"))
    assert [r.spans for r in got.collect()] == [[], []]


def test_only_spark_functions(spark):
    df = spark.createDataFrame(people(9), "doc_id long, text string")
    plan = digest_private(find_private(df, rounds=1))._jdf.queryExecution().toString()
    plan += cells(proposals(df))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapPartitions", plan)


def test_best_split_and_leaves():
    by_feature = {0: {0: (5.0, 5.0), 1: (-5.0, 5.0)}, 1: {0: (0.0, 10.0)}}
    split, left, right = best_split(by_feature, 0.0)
    assert split == (0, 0) and (left, right) == (1.0, -1.0)
    assert best_split({0: {3: (2.0, 4.0)}}, 0.0)[:2] == (None, 0.5)


def test_trees_learn_an_exclusive_or(spark):
    """Neither feature tells alone; both together do."""
    names = list(private.FEATURES)
    rows = []
    for a in (0, 1):
        for b in (0, 1):
            row = dict.fromkeys(names, 0) | {"marker": a, "valid": b}
            weight = 0.3 if (a, b) == (1, 1) else 0.2
            rows.append((int(a != b), *[row[n] for n in names], weight))
    schema = "label int, " + ", ".join(f"{n} int" for n in names) + ", weight double"
    examples = spark.createDataFrame(rows, schema).coalesce(1).cache()
    trees = fit(examples, 8, 2, 0.5, 0.01)
    assert isinstance(trees[0], Split)
    p = private.probability(trees, F.col)
    for r in examples.select("label", p.alias("p")).collect():
        assert abs(r.label - r.p) < 0.2


def test_doubt(spark):
    row = dict.fromkeys(private.FEATURES, 0) | {"kind": 3, "word": 1, "groups": 3, "sep": 1}
    def asked(**changes):
        values = {n: F.lit(v) for n, v in (row | changes).items()}
        return spark.range(1).select(doubtful(values.__getitem__)).first()[0]
    assert asked() and asked(groups=1, sep=4) and asked(word=0, sep=4)
    assert not asked(lead=2) and not asked(word=2) and not asked(marker=1) and not asked(sep=4)
