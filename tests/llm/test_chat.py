import hashlib

from hypothesis import given
from hypothesis import strategies as st

from clickpulse.llm import chat
from tests.llm.helpers import rows

TURNS = "conv_id LONG, turn LONG, role STRING, text STRING, kept INT, piece INT"


def run(spark, turns):
    df = spark.createDataFrame([(*t, 1, 2) for t in turns], TURNS)
    return {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@given(st.text(alphabet="<|\\im_endstar>a\n", max_size=30), st.text(alphabet="<|\\n\nuser", max_size=10))
def test_any_turn_reads_back(text, role):
    t = chat.CHATML
    assert "<|" not in t.escape(text) and t.unescape(t.escape(text)) == text
    assert t.parse("".join(x for x, _ in t.turn(role, text))) == [(role, text)]


def test_turn_order_and_digests(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>"), (2, 0, "assistant", "x"), (3, 1, "assistant", "b\né"), (3, 0, "system", None),
             (4, 0, "user", "q"), (5, 0, "user", "q"), (5, 1, "user", "q"), (None, 0, "user", "n"), (None, 1, "assistant", "m"),
             (6, 0, None, "t"), (7, 0, "user", "a"), (7, 0, "user", "a"), (8, 0, "system", "s"), (8, 1, "user", "u"), (8, 2, "assistant", ""), (8, 3, "user", "v")]
    got = run(spark, turns)
    ordered = sorted(turns, key=lambda t: (t[1], t[2] or "", t[3] or ""))
    for conv, r in got.items():
        own = [(role or "", text or "") for c, _, role, text in ordered if c == conv]
        loss = "".join(t for role, t in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), digest("".join(f"{a}\n{b}\n" for a, b in own)), len(loss), digest(loss)), conv
    assert {c: (r.valid, r.complete) for c, r in got.items()} == {
        1: (True, True), 2: (False, False), 3: (False, False), 4: (True, False), 5: (False, False), None: (True, True), 6: (False, False), 7: (False, False), 8: (True, False)}


def test_one_conversation_over_many_tasks(spark):
    turns = [(9, i, ("user", "assistant")[i % 2], f"t{i} <|") for i in range(6000)] + [(10, 0, "user", "x")]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(*t, 1, 2) for t in turns], TURNS)
        pieces = chat.format_chats(df)
        assert pieces.where("conv_id = 9").count() > 6
        got = {r.conv_id: r for r in chat.read_back(pieces).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got[9].n_turns == 6000 and got[9].valid and got[9].complete
    assert got[9].turns_sha256 == digest("".join(f"{r}\n{t}\n" for _, _, r, t in turns[:6000]))


def test_no_rows(spark):
    assert rows(chat.read_back(chat.format_chats(spark.createDataFrame([], TURNS)))) == []
