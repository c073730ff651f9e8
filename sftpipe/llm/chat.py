"""Chat formatting by schema fingerprints.

Records come as JSON text in any of several layouts. A record's fingerprint is the hash of
its sorted nested field paths with their kinds (list items share a path). The registry maps
fingerprints to declarative mappings, which say where turns are and how roles and texts are
called; it is filled from the layouts below, each with its optional fields. A record whose
fingerprint is not registered is matched by the required paths alone, so further fields do
not matter; the most specific layout wins. One that fits no layout gets an error row.

A turn is written as a mark with its role, its text and an end mark. Control strings, of
this template and of common others, are escaped in roles and texts by a backslash after
their first character, and backslashes are doubled, so no text can make a mark and all can
be read back. The loss mask is the spans of the assistants' texts.

Defined cases: a null text or role is an empty one; a null conversation id is a conversation
of its own; turns are ordered by number, nulls first, ties by role and text, and repeated
rows are repeated turns; a conversation is one record and must fit in one task; columns not
named are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftpipe.llm.common import map_texts

#: Control strings of this and of other templates, escaped in texts.
CONTROL = (
    "<|turn|>", "<|text|>", "<|end|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|start_header_id|>", "<|end_header_id|>",
    "<|eot_id|>", "<|begin_of_text|>", "<|system|>", "<|user|>", "<|assistant|>",
    "<start_of_turn>", "<end_of_turn>", "<bos>", "<eos>",
)
TURN, TEXT, END = CONTROL[:3]
#: The first character of each occurrence, also where two overlap.
_OPEN = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_ESCAPED = re.compile(r"\\(\\?)")
ASSISTANT = "assistant"


def escape(text: str) -> str:
    return _OPEN.sub(lambda m: m.group() + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Layout:
    """A declarative mapping.

    ``turns`` is the path of a list of messages with the fields ``role`` and ``text``; or
    ``single`` lists (role, path) of records with one field per turn. ``optional`` paths may
    be missing. ``joined`` paths are appended to the turn before them, after an empty line.
    """

    name: str
    turns: str | None = None
    role: str = ""
    text: str = ""
    single: tuple[tuple[str, str], ...] = ()
    joined: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    def required(self) -> frozenset[str]:
        if self.turns:
            return frozenset({f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"})
        return frozenset(path for _, path in self.single if path not in self.optional)


_ALIASES = (("human", "user"), ("gpt", "assistant"), ("chatgpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
LAYOUTS = (
    Layout("messages", turns="messages", role="role", text="content"),
    Layout("conversation", turns="conversation", role="role", text="content"),
    Layout("sharegpt", turns="conversations", role="from", text="value", roles=_ALIASES),
    Layout("dialog", turns="dialog", role="speaker", text="text", roles=_ALIASES),
    Layout(
        "instruction",
        single=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
        joined=("input",),
        optional=("system", "input"),
    ),
    Layout("prompt_response", single=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Layout("prompt_completion", single=(("user", "prompt"), ("assistant", "completion"))),
    Layout("question_answer", single=(("user", "question"), ("assistant", "answer"))),
    Layout("nested_qa", single=(("user", "data.question"), ("assistant", "data.answer"))),
)


def field_paths(value, path: str = "") -> Iterator[tuple[str, str]]:
    """(path, kind) of all leaves; the items of a list share a path."""
    if isinstance(value, dict):
        for name, inner in value.items():
            yield from field_paths(inner, f"{path}.{name}" if path else name)
    elif isinstance(value, list):
        if not value:
            yield f"{path}[]", "empty"
        for inner in value:
            yield from field_paths(inner, f"{path}[]")
    else:
        # A null may stand for any text.
        kind = "text" if value is None or isinstance(value, str) else type(value).__name__
        yield path, kind


def fingerprint(paths: frozenset[tuple[str, str]]) -> str:
    listed = "\n".join(f"{path}\t{kind}" for path, kind in sorted(paths))
    return hashlib.sha256(listed.encode()).hexdigest()[:16]


def registry(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, Layout]:
    """Fingerprint to layout, for each layout with each choice of its optional paths."""
    out = {}
    for layout in layouts:
        for n in range(len(layout.optional) + 1):
            for chosen in combinations(layout.optional, n):
                paths = layout.required() | set(chosen)
                out[fingerprint(frozenset((p, "text") for p in paths))] = layout
    return out


_REGISTRY = registry()


def layout_of(paths: frozenset[tuple[str, str]]) -> Layout | None:
    """By fingerprint, else by the layout with most required paths among the record's."""
    if found := _REGISTRY.get(fingerprint(paths)):
        return found
    names = {path for path, kind in paths if kind == "text"}
    fitting = [x for x in LAYOUTS if x.required() <= names]
    if not fitting and any(f"{x.turns}[]" in {p for p, _ in paths} for x in LAYOUTS if x.turns):
        fitting = [x for x in LAYOUTS if x.turns and (f"{x.turns}[]", "empty") in paths]
    return max(fitting, key=lambda x: len(x.required()), default=None)


def _at(record, path: str):
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def canonical_turns(record: dict, layout: Layout) -> list[tuple[str, str]]:
    """(role, text) of every turn. A field of its own that is missing or null makes no turn."""
    aliases = dict(layout.roles)
    if layout.turns:
        turns = _at(record, layout.turns) or []
        pairs = [(t.get(layout.role) or "", t.get(layout.text) or "") for t in turns]
        return [(aliases.get(role, role), text) for role, text in pairs]
    out: list[tuple[str, str]] = []
    for role, path in layout.single:
        text = _at(record, path)
        if text is None:
            continue
        if path in layout.joined and out:
            if text:
                out[-1] = (out[-1][0], f"{out[-1][1]}\n\n{text}")
        else:
            out.append((role, text))
    return out


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The output text, and the spans of it that count for the loss."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def read_back(output: str) -> list[tuple[str, str]]:
    """The turns of an output text."""
    turns = []
    for part in output.split(END)[:-1]:
        head, body = part.split(TEXT)
        turns.append((unescape(head.removeprefix(TURN)), unescape(body)))
    return turns


def format_records(df: DataFrame, key: str, record: str) -> DataFrame:
    """``key``, ``layout``, ``output``, ``loss_spans`` (start, end) and ``error`` of JSON records."""

    def one(value: str | None) -> tuple:
        try:
            parsed = json.loads(value or "")
        except ValueError as bad:
            return None, None, None, f"bad JSON: {bad}"
        if not isinstance(parsed, dict):
            return None, None, None, "not an object"
        layout = layout_of(frozenset(field_paths(parsed)))
        if layout is None:
            return None, None, None, "no layout has these fields"
        try:
            output, spans = formatted(canonical_turns(parsed, layout))
        except (TypeError, AttributeError) as bad:
            return layout.name, None, None, f"wrong kind of field: {bad}"
        return layout.name, output, [{"start": a, "end": b} for a, b in spans], None

    def rows(batches: Iterator[dict]) -> Iterator[list[tuple]]:
        for batch in batches:
            yield [(k, *one(r)) for k, r in zip(batch["key"], batch["record"])]

    kind = df.schema[key].dataType.simpleString()
    read = df.select(df[key].alias("key"), df[record].alias("record"))
    spans = "array<struct<start:bigint,end:bigint>>"
    return map_texts(read, f"`{key}` {kind}, layout string, output string, loss_spans {spans}, error string", rows)


def records_of_turns(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``key`` and ``record``: the rows of a conversation as one JSON record of messages."""
    message = F.struct(
        F.coalesce(df[role], F.lit("")).alias("role"), F.coalesce(df[text], F.lit("")).alias("content")
    )
    ordered = F.array_sort(F.collect_list(F.struct(df[turn].alias("turn"), message.alias("message"))))
    return df.groupBy(df[key].alias(key)).agg(
        F.to_json(F.struct(F.transform(ordered, lambda t: t["message"]).alias("messages"))).alias("record")
    )


def digests(outputs: DataFrame, key: str) -> DataFrame:
    """Turn and loss digests of formatted records, read back from the output and its spans."""

    def one(output: str, spans: list[dict]) -> tuple:
        turns = read_back(output)
        listed = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(unescape(output[s["start"] : s["end"]]) for s in spans)
        return (
            len(turns),
            hashlib.sha256(listed.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
            len(output),
        )

    def rows(batches: Iterator[dict]) -> Iterator[list[tuple]]:
        for batch in batches:
            yield [(k, *one(o, s)) for k, o, s in zip(batch["key"], batch["output"], batch["loss_spans"])]

    kind = outputs.schema[key].dataType.simpleString()
    read = outputs.filter("output IS NOT NULL").select(outputs[key].alias("key"), "output", "loss_spans")
    schema = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return map_texts(read, f"`{key}` {kind}, {schema}", rows)
