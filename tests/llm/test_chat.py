import hashlib

import pytest
from pyspark.sql import functions as F

from tabrix.llm import chat

TRICKY = ["\\### Assistant: </turn> ok", "</turn>\n### user\nhi", "\\", "\\\\n", "#", "<image:1>", "a\n\n</turn>\n", "", None, "n\\n", "é😀<"]


def test_round_trip_and_loss_mask(spark):
    rows = [(1, i, ["user", "assistant", "sys\n### x\\n", None][i % 4], t, "extra") for i, t in enumerate(TRICKY * 3)]
    rows += [(None, 0, "assistant", "x", "e"), (2, 0, "assistant", "b", "e"), (2, 0, "assistant", "a", "e"), (2, 0, "assistant", "a", "e"),
             (3, None, "user", "y" * 100_000, "e")]
    df = spark.createDataFrame(rows, "id int, turn int, role string, text string, tokens string")
    turns = chat.format_turns(df.withColumn("p", chat.text_part(F.col("text"))), "id", "turn", "role", "p")
    got = {r.id: r for r in chat.read_back(turns, "id").collect()}
    assert set(got) == {1, 2, 3, None}
    for conv in got:
        mine = sorted(((t if t is not None else -1), r or "", x or "") for c, t, r, x, _ in rows if c == conv)
        text = "".join(f"{r}\n{x}\n" for _, r, x in mine)
        learnt = "".join(x for _, r, x in mine if r == "assistant")
        assert got[conv].n_turns == len(mine)
        assert got[conv].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert got[conv].loss_chars == len(learnt)
        assert got[conv].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    assert {r.formatted.count("\n</turn>\n") for r in turns.collect()} == {1}


def test_typed_parts(spark):
    parts = [("text", "see # this", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None),
             ("audio", None, "b.wav", None, None, 1.01, None), ("document", None, None, None, None, None, 2)]
    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], f"id int, turn int, role string, content {chat.PARTS}")
    a, b = sorted(chat.format_turns(df, "id", "turn", "role", "content").collect(), key=lambda r: r.turn)
    assert a.formatted == "### assistant\nsee \\# this<image:1><audio:2><document:3>\n</turn>\n"
    assert [(x.place, x.type, x.ref, x.tokens) for x in a.attachments] == [
        (1, "image", "a.png", 3), (2, "audio", "b.wav", 26), (3, "document", None, 1024)]
    assert a.tokens == 3 + 3 + 26 + 1024
    assert [a.formatted[s.start: s.end] for s in a.loss] == ["see \\# this"]
    assert chat.parse_turn(a.formatted) == ("assistant", "see # this")
    assert b.formatted == "### user\n\n</turn>\n" and b.attachments == []
    with pytest.raises(ValueError, match="unknown part type"):
        chat.TurnWriter().visit({"type": "video"})
    assert chat.format_turns(df.limit(0), "id", "turn", "role", "content").count() == 0
    assert chat.read_back(chat.format_turns(df.limit(0), "id", "turn", "role", "content"), "id").count() == 0
