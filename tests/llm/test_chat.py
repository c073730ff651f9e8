"""Layouts, an exact round trip, and digests against plain Python."""

import hashlib
import json
import random
from collections import Counter, defaultdict

from sftpipe.llm import chat

RECORDS = {
    "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    "sharegpt": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "dialog": {"dialog": [{"speaker": "bot", "text": "a"}]},
    "instruction": {"instruction": "do", "input": "this", "output": "done"},
    "prompt_response": {"system": "s", "prompt": "q", "response": "a"},
    "prompt_completion": {"prompt": "q", "completion": "a"},
    "question_answer": {"question": "q", "answer": "a"},
    "nested_qa": {"data": {"question": "q", "answer": "a"}},
}
TURNS = {
    "messages": [("user", "q"), ("assistant", "a")],
    "sharegpt": [("user", "q"), ("assistant", "a")],
    "dialog": [("assistant", "a")],
    "instruction": [("user", "do\n\nthis"), ("assistant", "done")],
    "prompt_response": [("system", "s"), ("user", "q"), ("assistant", "a")],
    "prompt_completion": [("user", "q"), ("assistant", "a")],
    "question_answer": [("user", "q"), ("assistant", "a")],
    "nested_qa": [("user", "q"), ("assistant", "a")],
}


def test_layouts_by_fingerprint_and_by_required_fields(spark):
    rows = []
    for name, record in RECORDS.items():
        rows += [(name, json.dumps(record)), (name, json.dumps({**record, "id": 7, "meta": {"lang": "en"}}))]
    found = chat.format_records(spark.createDataFrame(rows, "name string, record string"), "name", "record").collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.layout == r.name and r.error is None
        assert chat.read_back(r.output) == TURNS[r.name]
        loss = [chat.unescape(r.output[s.start : s.end]) for s in r.loss_spans]
        assert loss == [t for role, t in TURNS[r.name] if role == "assistant"]


def test_fingerprint_does_not_depend_on_order_or_list_length():
    paths = lambda x: frozenset(chat.field_paths(x))
    a = {"messages": [{"role": "u", "content": "x"}]}
    b = {"messages": [{"content": None, "role": "v"}, {"role": "u", "content": "x"}]}
    assert chat.fingerprint(paths(a)) == chat.fingerprint(paths(b)) in chat.registry()
    assert chat.fingerprint(paths({"a": 1})) != chat.fingerprint(paths({"a": "1"}))


def test_records_that_fit_nothing_are_rows_with_an_error(spark):
    bad = ["{", "[]", "3", '{"x": 1}', '{"prompt": "only"}', '{"messages": [3]}', None, ""]
    docs = spark.createDataFrame([(i, b) for i, b in enumerate(bad)], "id int, record string")
    found = chat.format_records(docs, "id", "record").collect()
    assert len(found) == len(bad) and all(r.error and r.output is None for r in found)
    empty = spark.createDataFrame([(1, '{"messages": []}')], docs.schema)
    assert chat.format_records(empty, "id", "record").first().output == ""


def test_control_strings_are_escaped_reversibly():
    draw = random.Random(6)
    pieces = [*chat.CONTROL, "\\", "<", "|", ">", "x", "[", "]", "/", "\n", "é"]
    for _ in range(5000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 7)))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text and not any(c in escaped for c in chat.CONTROL)
        turns = [("user", text), ("assistant", text), (text, ""), ("assistant", "")]
        output, spans = chat.formatted(turns)
        assert chat.read_back(output) == turns
        assert [chat.unescape(output[a:b]) for a, b in spans] == [text, ""] + [""] * (text == "assistant")


def test_turn_rows(spark):
    rows = [
        (1, 1, "assistant", "second"), (1, 0, "user", "first"), (2, 0, "user", None), (2, None, "system", "s"),
        (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (None, 0, "user", "no id"), (None, 1, None, "no role"),
        (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"), (3, 5, "assistant", "x" * 200_000),
        (3, 6, "assistant", "<|end|>\\<|turn|>🙂"),
    ]
    extra = [(*r, "k", "r", "o") for r in rows]
    df = spark.createDataFrame(extra, "conv_id bigint, turn bigint, role string, text string, `key` string, record string, output string")
    records = chat.records_of_turns(df, "conv_id", "turn", "role", "text")
    found = chat.digests(chat.format_records(records, "conv_id", "record"), "conv_id").collect()
    groups = defaultdict(list)
    for c, n, role, text in rows:
        groups[c].append((n is not None, n or 0, role or "", text or ""))
    wanted = Counter()
    for c, turns in groups.items():
        pairs = [(role, text) for *_, role, text in sorted(turns)]
        loss = "".join(t for role, t in pairs if role == "assistant")
        listed = "".join(f"{role}\n{text}\n" for role, text in pairs)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        wanted[c, len(pairs), sha(listed), len(loss), sha(loss), len(chat.formatted(pairs)[0])] += 1
    assert Counter(map(tuple, found)) == wanted
    none = chat.records_of_turns(df.limit(0), "conv_id", "turn", "role", "text")
    assert chat.digests(chat.format_records(none, "conv_id", "record"), "conv_id").collect() == []
