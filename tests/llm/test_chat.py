"""Chat formatting: layouts, control strings, loss masks, round trips."""

import json

import pytest
from helpers import empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeledger.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"
RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "id": 7, "meta": {"score": 1.5}}, "messages", [("user", "a"), ("assistant", "b")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "tool", "value": "c"}]}, "from-value",
     [("user", "a"), ("assistant", "b"), ("tool", "c")]),
    ({"data": {"dialog": [{"speaker": {"role": "user"}, "utterance": {"text": "a"}}]}}, "nested", [("user", "a")]),
    ({"prompt": "a", "completion": "b"}, "prompt", [("user", "a"), ("assistant", "b")]),
    ({"prompt": "a", "response": "b"}, "prompt-response", [("user", "a"), ("assistant", "b")]),
    ({"question": "a", "answer": "b"}, "question", [("user", "a"), ("assistant", "b")]),
    ({"system": "s", "question": "a", "answer": "b"}, "question", [("system", "s"), ("user", "a"), ("assistant", "b")]),
    ({"instruction": "a", "output": "b"}, "instruction", [("user", "a"), ("assistant", "b")]),
    ({"system": "s", "instruction": "a", "input": "i", "output": None}, "instruction", [("system", "s"), ("user", "a"), ("user", "i"), ("assistant", "")]),
    ({"messages": [{"role": None, "content": 3}, {"role": "user"}]}, "messages", [("", "3"), ("user", "")]),
    ({"messages": []}, None, None),
    ({"body": "a"}, None, None),
    ([1, 2], None, None),
]


@pytest.mark.parametrize("record,layout,turns", RECORDS)
def test_layouts(record, layout, turns):
    mark, m = C.Layouts().choose(record) if isinstance(record, dict) else (None, None)
    assert (m.name if m else None) == layout
    if m:
        assert C.turns_of(record, m) == turns


def test_fingerprints_depend_on_paths_only():
    one, two = {"b": [{"c": 1}, {"d": "x"}], "a": {}}, {"a": {}, "b": [{"d": None, "c": [[]]}]}
    assert C.field_paths(one) == {"a", "b[].c", "b[].d"} and C.field_paths(two) == {"a", "b[].c[][]", "b[].d"} - {"b[].c[][]"} | {"b[].c[]"}
    assert C.fingerprint(C.field_paths(one)) != C.fingerprint(C.field_paths(two))
    assert len(C.Layouts().by_print) == sum(2 ** len(m.optional) for m in C.MAPPINGS)


CONTROL = [C.TURN, C.TEXT, C.END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>"]
pieces = st.lists(st.sampled_from([*CONTROL, "\\", "<", "[", "s>", "/", "INST]", "|", ">", "a", "\n", "é", "\U0001f600", "<\\s>", "[\\\\INST]"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(pieces)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    kept = C.escape(text)
    assert C.unescape(kept) == text
    assert not any(c in kept for c in CONTROL)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.just("assistant"), pieces), pieces), max_size=6))
def test_turns_and_masks_come_back(turns):
    text, spans = C.formatted(turns)
    assert list(C.parsed(text)) == turns
    assert [C.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_damaged_text_is_refused():
    with pytest.raises(ValueError):
        list(C.parsed(f"x{C.TURN}user{C.TEXT}a{C.END}"))


def test_records_of_all_layouts(spark):
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(RECORDS)] + [(50, None), (51, "{broken"), (None, '"text"'), (52, "[" * 5000 + "]" * 5000)]
    df = spark.createDataFrame(rows, "id long, record string").withColumns({c: F.lit("x") for c in ("layout", "turns", "loss", "formatted", "text")})
    got = {r.id: r for r in C.format_records(df, "id").collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert got[i].layout == layout
        assert (got[i].turns and [tuple(t) for t in got[i].turns]) == turns
    assert all(got[i].turns is None and got[i].formatted is None for i in (50, 51, 52, None))
    back = {r.id: r for r in C.read_back(C.format_records(df, "id"), "id").collect()}
    assert [tuple(t) for t in back[8].turns] == RECORDS[8][2] and back[8].loss_text == "" and back[50].turns is None
    assert C.format_records(empty(spark, "id long, record string"), "id").collect() == []


def test_conversations_with_odd_rows(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "user", said), (1, 1, "assistant", said), (1, 1, "assistant", said), (2, 3, "b", None), (2, None, "a", "last"), (2, 0, None, ""),
            (None, 0, "user", "alone"), (None, 1, "assistant", "too"), (3, 0, "assistant", "x" * 300_000), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "a"),
            (5, 0, "human", "u"), (5, 1, "gpt", "a")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "alone", "t", "last", "turns")})
    for layout in ("messages", "from-value", "nested", "prompt", "instruction", "question"):
        out = C.read_back(C.format_records(C.as_records(C.gather(df), F.lit(layout)), "conv_id"), "conv_id").collect()
        got = sorted(((r.conv_id or 0, [tuple(t) for t in r.turns], len(r.loss_text)) for r in out), key=repr)
        assert got == sorted([
            (1, [("user", said), ("assistant", said), ("assistant", said)], 2 * len(said)), (2, [("", ""), ("b", ""), ("a", "last")], 0),
            (0, [("user", "alone")], 0), (0, [("assistant", "too")], 3), (3, [("assistant", "x" * 300_000)], 300_000),
            (4, [("system", "s"), ("user", "u"), ("assistant", "a")], 1), (5, [("human", "u"), ("gpt", "a")], 0)], key=repr)
    assert C.gather(empty(spark, SCHEMA)).collect() == []
