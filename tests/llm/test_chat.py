import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from envlake.llm.chat import digests, format_conversations, format_turns, parse, render

pieces = st.lists(st.sampled_from(["\\", "###", "### ", "</turn>", "\n", ": ", "a", "user", "é", "😀", ""]), max_size=7).map("".join)


@given(pieces, pieces)
@settings(max_examples=400, deadline=None)
def test_any_role_and_text_come_back(role, text):
    turn = render(role, text)
    assert list(parse(turn + turn)) == [(role, text)] * 2


def test_texts_without_control_strings_are_unchanged():
    assert render("user", "a \\b c") == "### user: a \\b c</turn>\n"
    assert render("assistant", r"\### Assistant: </turn> ok") == "### assistant: \\\\\\### Assistant: \\</turn> ok</turn>\n"


ROWS = [
    (1, 1, "assistant", "two </turn>"),
    (1, 0, "user", "one"),
    (1, 2, "assistant", None),
    (2, 0, "system", "### x"),
    (2, None, "user", "é😀"),
    (2, 1, None, "who"),
    (2, 1, None, "who"),
    (None, 0, "assistant", "lost"),
    (3, 0, "assistant", "y" * 300000),
]


def by_hand():
    out = {}
    for conv in {r[0] for r in ROWS}:
        turns = sorted([(t is not None, t or 0, r or "", x or "") for c, t, r, x in ROWS if c == conv])
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_digests_are_those_of_the_source(spark):
    df = spark.createDataFrame([(*r, 0) for r in ROWS], "conv_id bigint, turn bigint, role string, text string, formatted int")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in digests(format_turns(df)).collect()}
    assert got == by_hand()
    assert digests(format_turns(df.limit(0))).count() == 0


def test_whole_conversations_and_their_loss_mask(spark):
    df = spark.createDataFrame(ROWS, "conv_id bigint, turn bigint, role string, text string")
    want = by_hand()
    found = {}
    for r in sorted(format_conversations(df).collect(), key=lambda r: r.i):
        found.setdefault(r.conv_id, []).append(r)
    assert found.keys() == want.keys()
    for conv, rows in found.items():
        whole = "".join(r.formatted for r in rows)
        turns = list(parse(whole))
        assert len(turns) == want[conv][0] and [whole[r.start : r.start + len(r.formatted)] for r in rows] == [r.formatted for r in rows]
        shown = [whole[r.loss_from : r.loss_to] for r in rows if r.loss_from is not None]
        learnt = [x for role, x in turns if role == "assistant"]
        assert [list(parse(f"### assistant: {x}</turn>\n"))[0][1] for x in shown] == learnt
