import hashlib
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from surveyloom.llm import chat
from surveyloom.llm.frames import new_path

PIECES = st.lists(st.sampled_from(["\\", "\n", "### ", "User:", "Assistant:", "System:", 'Role "', "</turn>", "</turn", ">", "a", '"', ":", "é"]),
                  max_size=14).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "", "tool"]), PIECES), PIECES), max_size=5))
def test_turns_come_back(turns):
    parts = [chat.render(role, text) for role, text in turns]
    whole, at = "".join(p for p, _, _ in parts), 0
    got = chat.parse(whole)
    assert [(r, t) for r, t, _, _ in got] == turns
    for (_, text), (part, start, end), (_, _, a, b) in zip(turns, parts, got):
        assert (at + start, at + end) == (a, b) and chat.unescape(whole[a:b]) == text
        at += len(part)


def test_plain_text_is_not_escaped():
    assert chat.render("user", "C:\\dir ### heading")[0] == "### User:\nC:\\dir ### heading\n</turn>\n"


def test_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_CHARS", 300)
    hard = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, None, hard), (2, None, "assistant", hard), (None, 5, "user", ""),
            (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"), (4, 0, "system", "y" * 5000)]
    rows += [(9, n, ("user", "assistant")[n % 2], f"turn {n} {hard}") for n in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS loss", "1 AS part")
    formatted = chat.format_conversations(df)
    back = chat.written(formatted, new_path(spark, "chat-test"))
    assert back.where("conv_id = 9").count() > 10
    got = {r["conv_id"]: r for r in chat.conversation_digests(back).collect()}
    convs = {}
    for c, n, role, text in rows:
        convs.setdefault(c, []).append((n is not None, n, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        r = got[c]
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(learned)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
        assert r["formatted_chars"] == sum(len(chat.render(r, t)[0]) for _, _, r, t in turns)


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(chat.format_conversations(df)).count() == 0


def test_many_short_conversations_take_linear_time(spark):
    """Rendered rows that wait for a batch are counted once, not once for each turn."""
    rows = spark.range(60_000).selectExpr("id AS conv_id", "0L AS turn", "'user' AS role", "'hi' AS text").coalesce(1)
    began = time.time()
    assert chat.format_conversations(rows).count() == 60_000
    assert time.time() - began < 60
