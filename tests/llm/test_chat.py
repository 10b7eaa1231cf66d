from __future__ import annotations

import hashlib
import random

import pytest

from tallygate.llm import chat
from tallygate.llm.queries import MARKED

PARTS = ["\\", "###", "#", " ", "</turn>", "</turn", ">", ":\n", ":", "\n", "a", "é"]


def test_any_turn_comes_back_from_its_text():
    rng = random.Random(3)
    for _ in range(3000):
        turns = [("".join(rng.choices(PARTS, k=rng.randint(0, 4))), "".join(rng.choices(PARTS, k=rng.randint(0, 8)))) for _ in range(2)]
        text = "".join(chat.render_turn(*t) for t in turns)
        assert [(r, t) for r, t, _, _ in chat.parse(text)] == turns


def test_plain_turns_are_not_escaped():
    assert "\\" not in chat.render_turn("user", "a # b : c </turn")
    assert chat.render_turn("user", MARKED).count("\\") == 3


@pytest.mark.parametrize("text", ["x", "### a", "### a :\nb", "### a :\nb </turn>", "### a :\nb ### c </turn>\n"])
def test_other_text_is_malformed(text):
    with pytest.raises(chat.Malformed):
        list(chat.parse(text))


def digest(rows):
    turns = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest()
    loss = "".join(t for r, t in rows if r == "assistant")
    return len(rows), turns, len(loss), hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("chunk", [chat.CHUNK, 10])
def test_conversations_of_any_rows_read_back(spark, chunk):
    rows = [
        (1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (2, None, None, None),
        (None, 5, "assistant", MARKED), (None, 4, "user", "é" * 3000), (3, 1, "assistant", ""),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as part", "2 as formatted")
    found = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(chat.formatted(frame, chunk)).collect()}
    expected = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        expected[conv] = digest([(r[2] or "", r[3] or "") for r in own])
    assert found == expected


def test_an_empty_table_gives_none(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.formatted(frame)).count() == 0
