import random

from grantledger.llm import chat

ROWS = "conv_id long, turn long, role string, text string, formatted string"


def plain(turns):
    return [(role or "", text or "") for _, role, text in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or ""))]


def test_any_text_is_read_back(spark):
    rng = random.Random(1)
    bits = ["\\", "#", "###", "### ", "</turn>", "</part>", "\n", ":", ": ", "h", "t", "p", "c", "=", "ü", "日", "", "\\h", "\\\\"]
    chats = {
        c: [(t, rng.choice(["system", "user", "assistant", "Assistant", "=x: ###", "", None, "tool\\"]),
             "".join(rng.choices(bits, k=rng.randrange(8))) if rng.random() < 0.9 else None) for t in range(rng.randrange(1, 9))]
        for c in range(60)
    }
    rows = [(c, t, role, text, "x") for c, turns in chats.items() for t, role, text in turns]
    rng.shuffle(rows)
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(spark.createDataFrame(rows, ROWS))).collect()}
    assert set(got) == set(chats)
    for c, turns in chats.items():
        assert [(t.role, t.text) for t in got[c].turns] == plain(turns)
        assert got[c].learned == "".join(text for role, text in plain(turns) if role == "assistant")
        assert "".join(s.text for s in got[c].segments) == got[c].formatted


def test_neighbours_of_one_role_are_one_block(spark):
    rows = [(1, 2, "user", "b", ""), (1, 1, "user", "a", ""), (1, 3, "assistant", "c", ""), (1, 4, "user", "d", "")]
    got = chat.format_chats(spark.createDataFrame(rows, ROWS)).first()
    assert got.formatted == "### User: a</part>b</turn>\n### Assistant: c</turn>\n### User: d</turn>\n"


def test_odd_conversations(spark):
    rows = [(None, None, None, None, ""), (1, 1, "user", "x", ""), (1, 1, "user", "x", ""), (1, 1, "user", "a", ""), (2, 0, "user", "w " * 200_000, "")]
    df = spark.createDataFrame(rows, ROWS)
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    assert [(t.role, t.text) for t in got[None].turns] == [("", "")]
    assert [t.text for t in got[1].turns] == ["a", "x", "x"]
    assert got[2].turns[0].text == "w " * 200_000
    assert chat.read_back(chat.format_chats(df.where("false"))).count() == 0
