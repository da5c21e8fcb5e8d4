"""Chat formatting: exact round trips through the template, mappings, masks."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagweave.llm.chat import (
    chat_digest,
    escape,
    escape_role,
    format_chat,
    read_spans,
    read_turns,
    records_of,
    unescape,
    unescape_role,
)

MARKS = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]"]
PIECES = [*MARKS, "<", "[", "\\", "|im_end|>", "/s>", "é", "😀", "\n", "a", "<\\/s>", "[\\\\INST]"]


def test_escapes_are_reversible_and_leave_no_marks(spark):
    @settings(max_examples=3, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12), min_size=40, max_size=80))
    def check(texts):
        values = ["".join(t) for t in texts]
        df = spark.createDataFrame([(v,) for v in values], "v string")
        rows = df.select(
            "v",
            escape(F.col("v")).alias("e"),
            unescape(escape(F.col("v"))).alias("back"),
            escape_role(F.col("v")).alias("r"),
            unescape_role(escape_role(F.col("v"))).alias("role"),
        ).collect()
        for row in rows:
            assert row.back == row.v == row.role
            assert not any(mark in row.e or mark in row.r for mark in MARKS)
            assert "\n" not in row.r
        assert len({r.e for r in rows}) == len(set(values))

    check()


RECORDS = [
    (1, {"messages": [{"role": "user", "content": "hi <s>"}, {"role": "assistant", "content": "😀é"}]}),
    (2, {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}),
    (3, {"prompt": "p", "response": None}),
    (4, {"system": "s", "instruction": "", "output": "o"}),
    (5, {"unknown": 1}),
    (6, {"messages": []}),
    (7, {"messages": [{"role": None, "content": None}, {"content": 12, "role": "x\\n\ny"}]}),
]


def test_layouts_become_turns(spark):
    rows = [(i, json.dumps(r), "x") for i, r in RECORDS]
    rows += [rows[0], (1, json.dumps({"prompt": "other", "response": "r"}), "x"), (8, "{broken", "y"), (9, None, "z")]
    df = spark.createDataFrame(rows, "record_id int, record string, formatted string")
    out = format_chat(df).select(
        "*",
        read_turns(F.col("formatted")).alias("turns"),
        read_spans(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    got = sorted(
        (r.record_id, r.layout, [tuple(t) for t in r.turns] if r.turns is not None else None, r.loss)
        for r in out.collect()
    )
    assert got == [
        (1, "messages", [("user", "hi <s>"), ("assistant", "😀é")], "😀é"),
        (1, "prompt", [("user", "other"), ("assistant", "r")], "r"),
        (2, "from_value", [("user", "a"), ("assistant", "b")], "b"),
        (3, "prompt", [("user", "p"), ("assistant", "")], ""),
        (4, "instruction", [("system", "s"), ("user", ""), ("assistant", "o")], "o"),
        (5, None, None, None),
        (6, "messages", [], ""),
        (7, "messages", [("", ""), ("x\\n\ny", "12")], ""),
        (8, None, None, None),
        (9, None, None, None),
    ]


def digest(turns):
    spoken = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(spoken), len(loss), sha(loss)


def test_conversations_round_trip(spark):
    long = [(i, "user" if i % 2 else "assistant", f"t{i} </s>" * 3) for i in range(3000)]
    convs = {
        1: [(0, "user", "a"), (1, "assistant", None)],
        2: [(0, "system", ""), (1, "user", "q"), (2, "assistant", "[/INST]")],
        3: [(1, "assistant", "b"), (1, "assistant", "b"), (None, "user", "first")],
        4: [(0, "tool", "\n<|im_end|>\n"), (1, None, "x")],
        5: long,
        6: [(0, "human", "kept as it is"), (1, "assistant", "y")],
    }
    rows = [(c, t, r, x, "extra") for c, turns in convs.items() for t, r, x in turns]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, record string")
    got = {
        r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
        for r in chat_digest(format_chat(records_of(df), "conv_id", "record")).collect()
    }
    plain = {
        c: [(r or "", x or "") for t, r, x in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0))]
        for c, turns in convs.items()
    }
    assert got == {c: digest(turns) for c, turns in plain.items()}


def test_no_python_in_the_plan(spark, sf_dir):
    from tagweave.llm.queries import op9_chat_format

    plan = op9_chat_format(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("schema", ["record_id int, record string"])
def test_empty_table(spark, schema):
    assert format_chat(spark.createDataFrame([], schema)).count() == 0


def test_lists_of_unlike_elements_are_no_known_layout(spark):
    """What a mapping would lose is reported as unknown and never as empty turns."""
    records = {
        1: '{"messages":["secret text","b"]}',
        2: '{"messages":[{"role":"user","content":"hi"},"loose"]}',
        3: '{"messages":[{"role":"user","content":{"parts":["a"]}},{"role":"user","content":"b"}]}',
        4: '{"conversations":[1,2]}',
        5: '{"messages":[]}',
        6: '{"prompt":{"a":"b"},"response":"c"}',
    }
    rows = format_chat(spark.createDataFrame(list(records.items()), "record_id int, record string")).collect()
    assert {r.record_id: (r.layout, r.formatted) for r in rows} == {
        i: ("messages", "") if i == 5 else (None, None) for i in records
    }
