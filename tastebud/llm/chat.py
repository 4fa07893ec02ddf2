"""Chat formatting: heterogeneous records -> canonical turns -> one reversible template.

A record's *schema fingerprint* is a hash of the sorted nested paths of its non-null fields
(``messages[].role``).  It selects a declarative mapping from ``LAYOUTS``; the mapping says
which fields are which turns.  Records without a known fingerprint are returned with layout
null and no turn, not dropped.

The template writes a turn as ``### <role>: <text></turn>`` and a line feed.  Inside roles and
texts ``\\``, ``#`` and ``</turn>`` get a backslash before them (in roles ``:`` as well), so a
formatted conversation can be read back exactly.  The loss mask covers assistant texts.

Defined cases: null text or role is empty; turns of a conversation are ordered by turn (nulls
first), then role, then text, so repeated turn numbers have one order; rows without conv_id
form one conversation; empty conversations don't occur; further columns are ignored.  A
conversation of any length is folded as a stream, one turn in memory at a time.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """``turns``: (role or role path, text template) of fixed turns, or of each element of ``each``."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...]
    each: str = ""
    optional: tuple[str, ...] = ()
    roles: dict = field(default_factory=dict)


SPOKEN = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
#: ``{a.b}`` is the field's text, ``=a.b`` as a role is read from the field
LAYOUTS = (
    Layout("turn_row", ("turn",), (("=role", "{text}"),), optional=("role", "text")),
    Layout("prompt_completion", ("prompt",), (("system", "{system}"), ("user", "{prompt}"), ("assistant", "{completion}")), optional=("completion", "system")),
    Layout("prompt_response", ("prompt", "response"), (("system", "{system}"), ("user", "{prompt}"), ("assistant", "{response}")), optional=("system",)),
    Layout("instruction", ("instruction", "output"), (("system", "{system}"), ("user", "{instruction}\n\n{input}"), ("assistant", "{output}")), optional=("input", "system")),
    Layout("question_answer", ("question", "answer"), (("user", "{question}"), ("assistant", "{answer}"))),
    Layout("messages", ("messages[].role",), (("=role", "{content}"),), each="messages", optional=("messages[].content", "id")),
    Layout("conversations", ("conversations[].from",), (("=from", "{value}"),), each="conversations", optional=("conversations[].value", "id", "system"), roles=SPOKEN),
)


def field_paths(value, at: str = "") -> set[str]:
    """Nested paths of the non-null leaves; list elements share one path."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) if value else set()
    if isinstance(value, list):
        return set().union(*(field_paths(v, at + "[]") for v in value)) if value else set()
    return set() if value is None else {at}


def fingerprint(paths) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def known_fingerprints(layouts=LAYOUTS) -> dict[str, Layout]:
    """Fingerprint -> layout, with and without each optional path; the first layout wins."""
    found: dict[str, Layout] = {}
    for x in layouts:
        for n in range(len(x.optional) + 1):
            for extra in itertools.combinations(x.optional, n):
                found.setdefault(fingerprint({*x.paths, *extra}), x)
    return found


def _value(record, path: str):
    for p in path.split("."):
        record = record.get(p) if isinstance(record, dict) else None
    return record


def _fill(template: str, record) -> str:
    fields = re.findall(r"\{([^}]+)\}", template)
    present = [f for f in fields if _value(record, f) not in (None, "")]
    if len(fields) > 1 and len(present) < len(fields):  # a missing part takes its separator along
        return "\n\n".join(str(_value(record, f)) for f in present)
    return re.sub(r"\{([^}]+)\}", lambda m: "" if (v := _value(record, m[1])) is None else str(v), template)


def record_turns(record, layout: Layout) -> list[tuple[str, str]]:
    out = []
    if layout.each:
        if isinstance(record.get("system"), str):
            out.append(("system", record["system"]))
        items = record.get(layout.each) or []
    else:
        items = [record]
    for item in items:
        for role, template in layout.turns:
            fixed = not role.startswith("=")
            if fixed and role == "system" and _value(record, "system") is None:
                continue
            if fixed and len(layout.turns) > 1 and role == "assistant" and all(_value(item, f) is None for f in re.findall(r"\{([^}]+)\}", template)):
                continue
            name = role if fixed else _value(item, role[1:])
            name = "" if name is None else str(name)
            out.append((layout.roles.get(name, name), _fill(template, item)))
    return out


def _canonical(batches, layouts):
    known = known_fingerprints(layouts)
    schema = pa.schema([("key", pa.int64()), ("turn", pa.int64()), ("part", pa.int32()), ("role", pa.string()), ("text", pa.string()), ("layout", pa.string()), ("fingerprint", pa.string())])
    for batch in batches:
        rows = []
        for key, order, payload in zip(*(c.to_pylist() for c in batch.columns)):
            try:
                record = json.loads(payload) if payload is not None else None
            except ValueError:
                record = None
            print_ = fingerprint(field_paths(record)) if isinstance(record, dict) else None
            layout = known.get(print_)
            if layout is None:
                rows.append((key, order, None, None, None, None, print_))
            else:
                rows += [(key, order, i, role, text, layout.name, print_) for i, (role, text) in enumerate(record_turns(record, layout))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def canonical_turns(records: DataFrame, key_col: str, order_col: str, payload_col: str, layouts=LAYOUTS) -> DataFrame:
    """(key, turn, part, role, text, layout, fingerprint) of JSON records; see the module for unknown ones."""
    return (records.select(F.col(key_col).cast("long"), F.col(order_col).cast("long"), F.col(payload_col))
            .mapInArrow(lambda it: _canonical(it, layouts), "key long, turn long, part int, role string, text string, layout string, fingerprint string"))


# ------------------------------------------------------------------------ template

def _escape(text) -> F.Column:
    for s in ("\\", "#", "</turn>"):
        text = F.replace(text, F.lit(s), F.lit("\\" + s))
    return text


def format_turns(turns: DataFrame) -> DataFrame:
    """Adds formatted (the turn under the template) and loss_start, loss_end (code points in it; equal where masked).

    A conversation's formatted text is its turns' texts one after the other.
    """
    head = F.concat(F.lit("### "), F.replace(_escape(F.coalesce("role", F.lit(""))), F.lit(":"), F.lit("\\:")), F.lit(": "))
    body = _escape(F.coalesce("text", F.lit("")))
    out = turns.withColumns({"formatted": F.concat(head, body, F.lit("</turn>\n")), "loss_start": F.length(head)})
    return out.withColumn("loss_end", F.col("loss_start") + F.when(F.col("role") == "assistant", F.length(body)).otherwise(0))


_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)


def unescape(text: str) -> str:
    return re.sub(r"\\(</turn>|.)", r"\1", text, flags=re.S) if "\\" in text else text


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def _fold(batches):
    """Digests of each conversation, read back from its formatted turns in order."""
    schema = pa.schema([("key", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    none = object()
    current, n, turns, loss, loss_chars, chars = none, 0, None, None, 0, 0
    for batch in batches:
        rows = []
        for key, formatted, a, b in zip(*(c.to_pylist() for c in batch.columns)):
            if current is none or key != current:
                if current is not none:
                    rows.append((current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                current, n, turns, loss, loss_chars, chars = key, 0, hashlib.sha256(), hashlib.sha256(), 0, 0
            for role, text in parse(formatted):
                n += 1
                turns.update(f"{role}\n{text}\n".encode())
            under = unescape(formatted[a:b])
            loss.update(under.encode())
            loss_chars += len(under)
            chars += len(formatted)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    if current is not none:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars), schema.types)], schema=schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """(key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) per conversation, parsed from its formatted text."""
    ordered = formatted.repartition("key").sortWithinPartitions("key", "turn", "part", "role", "text")
    return ordered.select("key", "formatted", "loss_start", "loss_end").mapInArrow(
        _fold, "key long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
