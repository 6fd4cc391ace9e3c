"""Chat formatting: what is written parses back to what was given."""

from hypothesis import given, settings
from hypothesis import strategies as st

from storyloom.llm import chat
from tests.llm import plain

PIECES = st.sampled_from(["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "~", " ", "[INST", "]", "<", ">", "\n", "a", "é", "<</", "s>"])
TEXT = st.one_of(st.text(max_size=20), st.lists(PIECES, max_size=12).map("".join))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "", "role"]), TEXT), TEXT), max_size=6))
def test_round_trip(turns):
    assert chat.parse("".join(chat.render(r, t)[0] for r, t in turns)) == turns


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    made, start, size = chat.render("assistant", text)
    assert chat.unescape(made[start:start + size]) == text


def test_plain_turns_are_not_escaped():
    assert chat.render("user", "a ~ <b> [c]")[0] == "[INST] a ~ <b> [c] [/INST]"
    assert chat.render("assistant", "</s>[INST] ok [/INST]")[0] == "<s> </s~>[INST~] ok [/INST~] </s>"


def _turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_digests(spark):
    rows = [(1, 1, "assistant", "hé </s>"), (1, 0, "user", "[INST] x"), (1, 2, "assistant", None), (2, 0, None, "x"),
            (2, 0, None, "x"), (None, 3, "tool", ""), (3, 5, "assistant", "")]
    frame = _turns(spark, rows).selectExpr("*", "1 AS part", "'x' AS formatted").repartition(3)
    for ordered in (True, False):
        got = {r.conv_id: r for r in chat.read_back(chat.format_chats(frame), ordered).collect()}
        assert set(got) == {1, 2, 3, None}
        assert (got[1].n_turns, got[1].loss_chars, got[2].n_turns, got[None].n_turns) == (3, 7, 2, 1)
        assert got[1].turns_sha256 == plain.sha("user\n[INST] x\nassistant\nhé </s>\nassistant\n\n")
        assert got[1].loss_sha256 == plain.sha("hé </s>") and got[3].loss_sha256 == plain.sha("")
        assert got[2].turns_sha256 == plain.sha("\nx\n\nx\n")
    assert chat.read_back(chat.format_chats(_turns(spark, []))).count() == 0


def test_one_conversation_of_many_turns_is_a_stream(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"turn {i} " * 20) for i in range(12000)]
    got = chat.read_back(chat.format_chats(_turns(spark, rows))).collect()
    assert len(got) == 1 and got[0].n_turns == 12000
    assert got[0].loss_sha256 == plain.sha("".join(t for *_, r, t in rows if r == "assistant"))
