import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from starmill.llm import chat
from starmill.llm.chat import best_branches, digest_chats, format_chats, replies_by_turn

control = ["<|im_end|>", "<|im_start|>assistant\n"]
tricky = st.lists(st.sampled_from([*"<|\\>n\nia_", *control])).map("".join)


@given(tricky)
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text
    assert "\n" not in chat.escape_role(text)


@given(st.lists(st.tuples(tricky, tricky), max_size=6))
def test_turns_are_read_back(turns):
    made = "".join(
        chat.START + chat.escape_role(r) + "\n" + chat.escape(t) + chat.END + "\n" for r, t in turns
    )
    assert list(chat.read_turns(made)) == turns


def test_branches(spark):
    """Tree 1 has three leaves; the path of node 6 has the best mean score."""
    rows = [
        (1, 1, None, 1.0), (1, 2, 1, 0.0), (1, 3, 1, 0.5), (1, 4, 2, 0.0), (1, 5, 3, 0.4),
        (1, 6, 3, 0.9), (2, 1, 99, None), (None, 1, None, 1.0), (None, 2, 1, 1.0),
        *((3, i, i - 1 if i > 1 else None, 0.1) for i in range(1, 101)),
    ]
    df = spark.createDataFrame(rows, "conv long, node long, parent long, score double")
    got = sorted(map(str, ((r.conv, r.position, r.node) for r in best_branches(df).collect())))
    want = [(1, 1, 1), (1, 2, 3), (1, 3, 6), (2, 1, 1), (None, 1, 1), (None, 2, 2)]
    want += [(3, i, i) for i in range(1, 101)]
    assert got == sorted(map(str, want))
    two = best_branches(df.where("conv = 1"), keep=2).where("leaf = 5").count()
    assert two == 3


def test_cycles_are_refused(spark):
    df = spark.createDataFrame(
        [(1, 1, 2, 1.0), (1, 2, 1, 1.0)], "conv long, node long, parent long, score double"
    )
    with pytest.raises(ValueError, match="cycle"):
        best_branches(df)


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def test_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_CHARS", 50)
    rows = [
        (1, 0, "user", "Hi <|im_end|>"), (1, 1, "assistant", "A <\\| b"), (1, 2, "assistant", None),
        (2, 5, None, "x" * 200), (2, 5, None, "x" * 200), (2, 7, "assistant", "é漢"),
        (None, None, "user", ""), (3, None, "assistant", "late"), (3, 1, "as\nsistant", "n"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "'clash' AS node", "'clash' AS leaf", "'clash' AS position")
    made = format_chats(replies_by_turn(df))
    got = {r.conv_id: r for r in digest_chats(made).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    assert set(got) == {1, 2, 3, None}
    for conv, r in got.items():
        turns = [(x[2] or "", x[3] or "") for x in sorted((x for x in rows if x[0] == conv), key=order)]
        learned = [t for role, t in turns if role == "assistant"]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == digest(f"{role}\n{t}\n" for role, t in turns)
        assert (r.loss_chars, r.loss_sha256) == (len("".join(learned)), digest(learned))
    texts = {}
    for r in made.collect():
        texts[r.conv] = texts.get(r.conv, "") + r.formatted
    assert {c: len(t) for c, t in texts.items()} == {c: r.formatted_chars for c, r in got.items()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert digest_chats(format_chats(replies_by_turn(df))).collect() == []
