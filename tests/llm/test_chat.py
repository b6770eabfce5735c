import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from delaystar.llm import chat

ROW = "conv_id bigint, turn bigint, role string, text string"
hard = st.lists(st.sampled_from(["\\", "###", "</turn>", "#", "<", "/turn>", "\n", " ", ":", "a", "\u00e9", "Assistant", "@"]), max_size=14).map("".join)


@settings(max_examples=400, deadline=None)
@given(role=st.one_of(st.sampled_from(["user", "assistant", "system"]), hard), text=hard)
def test_a_turn_reads_back_exactly(role, text):
    segment, start, end = chat.render(role, text)
    assert chat.parse(segment) == (role, text)
    assert (start >= 0) == (role == "assistant")
    if start >= 0:
        assert chat.unescape(segment[start:end]) == text


@settings(max_examples=200, deadline=None)
@given(turns=st.lists(st.tuples(hard, hard), max_size=5))
def test_turns_in_a_row_are_told_apart(turns):
    whole = "".join(chat.render(r, t)[0] for r, t in turns)
    assert [chat.parse(m[0]) for m in chat._TURN.finditer(whole)] == turns
    assert "".join(m[0] for m in chat._TURN.finditer(whole)) == whole


LAYOUTS = [
    ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p"}, [("user", "p")]),
    ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"instruction": "i", "input": "x", "output": "o"}, [("user", "i\n\nx"), ("assistant", "o")]),
    ({"instruction": "i", "input": None, "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}, {"role": "tool", "content": None}]},
     [("user", "u"), ("assistant", "a"), ("tool", "")]),
    ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}, [("user", "h"), ("assistant", "g")]),
    ({"role": "user", "content": "u"}, [("user", "u")]),
    ({}, [("", "")]),
]
STRANGE = [{"prompt": 5}, {"prompt": "p", "extra": "e"}, {"messages": "text"}, {"messages": []}, [1], "text", None]


def test_layouts_are_chosen_by_fingerprint(spark):
    rows = [(i, 0, json.dumps(r)) for i, (r, _) in enumerate(LAYOUTS)] + [(100 + i, 0, json.dumps(r)) for i, r in enumerate(STRANGE)]
    rows += [(200, 0, "{broken"), (201, 0, None)]
    records = spark.createDataFrame(rows, "conv_id bigint, turn bigint, record string")
    got = {}
    for r in chat.canonical_turns(records).orderBy("conv_id", "seq").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {i: turns for i, (_, turns) in enumerate(LAYOUTS)}
    left = {r["fingerprint"]: r["n"] for r in chat.unmapped(records).collect()}
    assert sum(left.values()) == len(STRANGE) + 2 and left[None] == 5


def test_fingerprint_depends_on_paths_and_kinds_only():
    paths = lambda r: chat.fingerprint(chat.field_paths(r))
    assert paths({"a": "x", "b": [{"c": 1}]}) == paths({"b": [{"c": 2}, {"c": None}], "a": "y", "d": None})
    assert paths({"a": "x"}) != paths({"a": 1}) != paths({"a": True})


def brute(rows):
    out = {}
    order = lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=order)]
        mine = "".join(t for role, t in turns if role == "assistant")
        out[conv] = (
            len(turns), hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in turns).encode()).hexdigest(),
            len(mine), hashlib.sha256(mine.encode()).hexdigest(), sum(len(chat.render(a, t)[0]) for a, t in turns),
        )
    return out


def test_conversations_with_nulls_ties_repeats_and_a_long_one(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "tie"), (1, None, "user", "last"), (2, 0, None, "no role"),
            (None, 0, "user", "no id"), (None, 1, "assistant", "\\"), (3, 0, "assistant", "</turn>\n### User: x"), (3, 0, "assistant", "</turn>\n### User: x"),
            (4, 0, "weird: role\n", ""), (6, 0, "assistant", "\U0001f600" * 200_000)]
    rows += [(5, i, ("user", "assistant")[i % 2], f"turn {i} ###") for i in range(15_000)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], ROW + ", segment string, seq int")
    said = "\\### Assistant: </turn> ok"
    want = brute([*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)])
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.format_conversations(spark, table).collect()}
    assert got == want


def test_empty_table_has_the_control_case_only(spark):
    rows = chat.format_conversations(spark, spark.createDataFrame([], ROW)).collect()
    assert [(r["conv_id"], r["n_turns"]) for r in rows] == [(-7, 2)]


def test_segments_that_are_no_turn_are_refused():
    for text in ("", "### User: x</turn>", "### User: x</turn>\n### User: y</turn>\n", "User: x</turn>\n"):
        with pytest.raises(ValueError):
            chat.parse(text)
