import hashlib
import json

import pytest
from conftest import SF

from tastebud.llm import chat, queries


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(loss), sha(loss))
    return out


HARD = ["", None, "\\", "\\\\", "</turn>", "\\</turn>", "#", "### user: x</turn>\n", "\\### Assistant: </turn> ok", "<</turn></turn>", "\n### assistant: a", "é日👍", "x" * 300_000, "<" * 2000 + "\\" * 2001]


def test_texts_and_roles_survive_the_template(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for r in ("user", "assistant", None, "a: b", "</turn>", "\\:#") for t in HARD)]
    rows += [(2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (2, None, "user", "first"), (None, 0, "user", "no id")]
    df = spark.createDataFrame(rows, "key long, turn long, role string, text string")
    turns = df.selectExpr("key", "turn", "0 AS part", "role", "text", "key AS formatted_chars")
    got = {r.key: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.format_turns(turns)).collect()}
    assert got == brute(rows)


def test_control_strings_never_appear_inside_texts(spark):
    df = spark.createDataFrame([(1, 0, 0, "user", t) for t in HARD], "key long, turn long, part int, role string, text string")
    for r in chat.format_turns(df).collect():
        assert chat.parse(r.formatted) == [("user", r.text or "")]
        assert r.loss_start == r.loss_end


LAYOUTS = [
    ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "completion": None}, [("user", "p")]),
    ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"instruction": "i", "input": "x", "output": "o"}, [("user", "i\n\nx"), ("assistant", "o")]),
    ({"instruction": "i", "input": "", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]}, [("user", "u"), ("assistant", "a")]),
    ({"id": 4, "messages": [{"role": "user", "content": None}, {"role": "assistant", "content": "a"}]}, [("user", ""), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "u"}, {"from": "gpt", "value": "a"}]}, [("user", "u"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "u"}], "system": "s"}, [("system", "s"), ("user", "u")]),
    ({"turn": 3, "role": "tool", "text": "t"}, [("tool", "t")]),
    ({"turn": 3}, [("", "")]),
    ({"unknown": [1, {"x": 2}]}, None),
]


def test_each_layout_is_found_by_its_fingerprint(spark):
    rows = [(i, 0, json.dumps(x), "c") for i, (x, _) in enumerate(LAYOUTS)] + [(90, 0, None, ""), (91, 0, "not json", ""), (92, 0, "[1]", "")]
    df = spark.createDataFrame(rows, "id long, o long, payload string, layout string")
    got = {}
    for r in sorted(chat.canonical_turns(df, "id", "o", "payload").collect(), key=lambda r: (r.key, r.part or 0)):
        got.setdefault(r.key, []).append((r.role, r.text) if r.layout else None)
    for i, (_, want) in enumerate(LAYOUTS):
        assert got[i] == (want if want is not None else [None]), i
    assert got[90] == got[91] == got[92] == [None]


def test_fingerprint_ignores_order_and_list_length():
    a = chat.fingerprint(chat.field_paths({"m": [{"r": 1, "t": 2}], "k": {"z": 1, "y": [1, 2]}}))
    assert a == chat.fingerprint(chat.field_paths({"k": {"y": [3], "z": 0}, "m": [{"t": 2}, {"r": 1, "t": None}]}))
    assert a != chat.fingerprint(chat.field_paths({"k": {"y": [3]}, "m": [{"t": 2}, {"r": 1}]}))


def test_layouts_have_distinct_fingerprints():
    names = [chat.fingerprint(x.paths) for x in chat.LAYOUTS]
    assert len(set(names)) == len(names)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, payload string")
    assert chat.read_back(chat.format_turns(chat.canonical_turns(df, "conv_id", "turn", "payload"))).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", queries.CHAT_PROBE), (-7, 1, "assistant", queries.CHAT_PROBE)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in queries.op2_chat_formatting(spark, SF).collect()}
    assert queries.CHAT_PROBE == "\\### Assistant: </turn> ok"
    assert got == brute(rows)
