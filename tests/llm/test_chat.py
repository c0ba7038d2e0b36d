"""Event folding, rendering and the exact round trip."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from riskweave.llm import chat
from riskweave.llm.queries import op10_chat_formatting
from tests.llm.data import on_disk

EVENTS = "conv_id long, seq long, kind string, msg long, turn long, role string, text string"


def messages(spark, events):
    return {r.conv_id: [tuple(m)[1:] for m in r.messages] for r in chat.conversations(spark.createDataFrame(events, EVENTS)).collect()}


def test_deltas_edits_and_regenerations(spark):
    e = [
        (1, 0, "open", 10, 0, "user", None), (1, 1, "delta", 10, None, None, "he"), (1, 2, "delta", 10, None, None, "llo"),
        (1, 3, "open", 11, 1, "assistant", None), (1, 4, "delta", 11, None, None, "bad"), (1, 5, "open", 12, 2, "user", None),
        (1, 6, "delta", 12, None, None, "why"), (1, 7, "regenerate", 11, None, None, None), (1, 9, "delta", 11, None, None, "od"),
        (1, 8, "delta", 11, None, None, "go"), (1, 10, "open", 13, 2, "user", None), (1, 11, "delta", 13, None, None, "thx"),
        (1, 12, "edit", 10, None, None, "hi"), (1, 13, "delta", 10, None, None, None),
        (2, 0, "delta", 20, None, None, "never opened"), (None, 0, "open", 30, 0, None, None),
    ]
    got = messages(spark, e)
    # the reply to the discarded text goes, the one opened after the regeneration stays
    assert got[1] == [("user", "hi"), ("assistant", "good"), ("user", "thx")]
    assert got[None] == [("", "")] and 2 not in got


def test_empty_log(spark):
    assert chat.read_back(chat.render(chat.conversations(spark.createDataFrame([], EVENTS)))).count() == 0


TEXT = st.lists(st.sampled_from(["<|im_end|>", "<|im_start|>", "<|", "&lt;|", "&amp;", "&", "\n", "assistant\n", "é", "中", " ", "|>", "\\", "x"]), max_size=12).map("".join)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb", "", None]), st.one_of(st.none(), TEXT)), min_size=1, max_size=5), min_size=8, max_size=8))
def test_round_trip(spark, convs):
    rows = [(c, t, role, text) for c, turns in enumerate(convs) for t, (role, text) in enumerate(turns)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.read_back(chat.render(chat.conversations(chat.log_of_rows(frame)))).collect()
    assert len(out) == len(convs)
    for r in out:
        want = [(role or "", text or "") for role, text in convs[r.conv_id]]
        assert [(m.role, m.text) for m in r.turns] == want
        assert r.loss_text == "".join(t for role, t in want if role == "assistant")


def test_query_with_ties_and_extra_columns(spark, tmp_path):
    rows = [(1, 0, "user", "b", 9), (1, 0, "user", "a", 9), (1, 0, "user", "a", 9), (1, None, "system", None, 9), (None, 1, "assistant", "x", 9), (2, 5, None, "t", 9)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, msg long")
    on_disk(frame, tmp_path, "conversations")
    got = {r.conv_id: r for r in op10_chat_formatting(spark, str(tmp_path)).collect()}
    said = "system\n\nuser\na\nuser\na\nuser\nb\n"
    assert got[1].n_turns == 4 and got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[1].loss_chars == 0 and got[None].loss_chars == 1
    assert got[-1].loss_sha256 == hashlib.sha256(b"<|im_end|><|im_start|>assistant ok").hexdigest()
    assert set(got) == {1, 2, None, -1}
