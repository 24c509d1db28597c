r"""Chat formatting: records of many layouts become canonical turns, and turns become one marked text with a loss mask.

Layouts are told apart by schema fingerprints. The nested field paths of a JSON record (``messages[].role``) are
collected, sorted and hashed; the hash selects a declarative mapping (``MAPPINGS``) that says where turns, roles and texts
stand. A mapping's fingerprint is known beforehand for its required paths with each choice of its optional ones, so choosing is one
look-up; paths that no mapping names (ids, dates, scores) are left out of the hash.

The template: a turn is ``<|turn|>role<|text|>text<|end|>``. Control strings inside roles and texts (those of the template
and those that other models reserve: ``<|...|>``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``, ``<<SYS>>``, ``<</SYS>>``) get a
backslash behind their first character, one more if they already have some. That leaves no control string in a text, and taking one
backslash away gives the text back. The loss mask is the list of spans (code points of the formatted text, end exclusive)
that hold the assistant's texts.

Spark groups, shuffles and hashes; one record at a time is mapped in Python. A conversation is one record and one formatted
text, so it is held whole by the task that writes it.

Defined results: a record that is null, no JSON object or of an unknown layout has null turns and a null layout name; a null text or
role is empty; in ``gather`` turns follow their number (nulls last), then role, then text, repeated rows
stay, and rows without a conversation id belong together with no other row: each is a conversation of one turn; other
columns are dropped; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ASSISTANT = "assistant"
TURNS = "array<struct<role:string,text:string>>"


# --- layouts -------------------------------------------------------------------------


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout stand: a list (``turns``, with the paths of role and text inside one), or one
    field for each turn (``fields``: role, path), those that are absent or null left out."""

    name: str
    turns: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def paths(self) -> list[str]:
        return [f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"] if self.turns else [path for _, path in self.fields]


# Field names of public chat and instruction data sets.
MAPPINGS = (
    Mapping("messages", turns="messages", role="role", text="content"),
    Mapping("from-value", turns="conversations", role="from", text="value", roles={"human": "user", "gpt": "assistant"}),
    Mapping("nested", turns="data.dialog", role="speaker.role", text="utterance.text"),
    Mapping("prompt", fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("prompt-response", fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("question", fields=(("system", "system"), ("user", "question"), ("assistant", "answer")), optional=("system",)),
    Mapping("instruction", fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("system", "input")),
)


def field_paths(value, prefix: str = "") -> set[str]:
    """Paths of the leaves of a JSON value; an element of a list is ``[]``, an empty list or object is a leaf."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(field_paths(v, f"{prefix}[]") for v in value))
    return {prefix}


def fingerprint(paths) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode("utf-8", "replace")).hexdigest()[:16]


class Layouts:
    """The mappings by fingerprint."""

    def __init__(self, mappings=MAPPINGS):
        self.known = {p for m in mappings for p in m.paths()}
        self.by_print: dict[str, Mapping] = {}
        for m in mappings:
            need = [p for p in m.paths() if p not in m.optional]
            for k in range(len(m.optional) + 1):
                for extra in itertools.combinations(m.optional, k):
                    self.by_print.setdefault(fingerprint(need + list(extra)), m)

    def choose(self, record) -> tuple[str, Mapping | None]:
        paths = field_paths(record)
        known = fingerprint(paths & self.known)
        found = self.by_print.get(known)
        return (known, found) if found else (fingerprint(paths), None)


def _at(value, path: str):
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def turns_of(record, m: Mapping) -> list[tuple[str, str]]:
    if m.turns:
        rows = [(_text(_at(t, m.role)), _text(_at(t, m.text))) for t in _at(record, m.turns)]
    else:
        rows = [(role, _text(_at(record, path))) for role, path in m.fields if path not in m.optional or _at(record, path) is not None]
    return [(m.roles.get(role, role), text) for role, text in rows]


# --- template ------------------------------------------------------------------------

_AFTER = r"(?:/?s>|</?SYS>>|\|[a-z_]+\|>)"
_CONTROL = re.compile(rf"(<\\*(?={_AFTER})|\[\\*(?=/?INST\]))")
_ESCAPED = re.compile(rf"(<)\\(?=\\*{_AFTER})|(\[)\\(?=\\*/?INST\])")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def formatted(turns) -> tuple[str, list[tuple[int, int]]]:
    """The marked text of turns and the spans under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += head, body, END
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parsed(text: str) -> Iterator[tuple[str, str]]:
    """The turns of a marked text."""
    at = 0
    while at < len(text):
        middle, end = text.index(TEXT, at), text.index(END, at)
        if not text.startswith(TURN, at) or middle > end:
            raise ValueError(f"no turn at character {at}")
        yield unescape(text[at + len(TURN):middle]), unescape(text[middle + len(TEXT):end])
        at = end + len(END)


# --- operators -----------------------------------------------------------------------


def format_records(records: DataFrame, id_col: str, record_col: str = "record", mappings=MAPPINGS) -> DataFrame:
    """One row per record (JSON text): the id, fingerprint, layout, turns, formatted, and loss (spans under the loss mask)."""
    turn, span = pa.struct([("role", pa.string()), ("text", pa.string())]), pa.struct([("start", pa.int64()), ("end", pa.int64())])
    kinds = (pa.string(), pa.string(), pa.list_(turn), pa.string(), pa.list_(span))

    def one(layouts: Layouts, text):
        try:
            record = json.loads(text) if text is not None else None
            mark, m = layouts.choose(record) if isinstance(record, dict) else (None, None)
        except (ValueError, RecursionError):
            mark, m = None, None
        if m is None:
            return mark, None, None, None, None
        turns = turns_of(record, m)
        whole, spans = formatted(turns)
        return mark, m.name, [{"role": r, "text": t} for r, t in turns], whole, [{"start": a, "end": b} for a, b in spans]

    def run(batches):
        layouts = Layouts(mappings)
        for batch in batches:
            for at, n in _pieces(batch, "record"):
                cols = zip(*(one(layouts, t.as_py()) for t in batch.column("record").slice(at, n)))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, n), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                                 names=["id", "fingerprint", "layout", "turns", "formatted", "loss"])

    rows = records.select(F.col(id_col).alias("id"), F.col(record_col).alias("record"))
    kind = records.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fingerprint string, layout string, turns {TURNS}, formatted string, "
                                "loss array<struct<start:long,end:long>>").withColumnRenamed("id", id_col)


#: Code units of text taken together.
PIECE = 1 << 20


def _pieces(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int]]:
    """(first row, rows) of stretches of about PIECE bytes."""
    at = held = 0
    for i, x in enumerate(batch.column(column)):
        held += len(x.as_buffer()) if x.is_valid else 0
        if held >= PIECE:
            yield at, i + 1 - at
            at, held = i + 1, 0
    if at < batch.num_rows:
        yield at, batch.num_rows - at


def read_back(rows: DataFrame, id_col: str) -> DataFrame:
    """Formatted texts and loss masks read again: the id, turns as the marks in the text tell them, and loss_text (what
    stands under the mask, unescaped, nothing between)."""
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])

    def run(batches):
        for batch in batches:
            for at, n in _pieces(batch, "formatted"):
                turns, lost = [], []
                for text, loss in zip(batch.column("formatted").slice(at, n), batch.column("loss").slice(at, n)):
                    text = text.as_py()
                    turns.append(None if text is None else [{"role": r, "text": t} for r, t in parsed(text)])
                    lost.append(None if text is None else "".join(unescape(text[s["start"]:s["end"]]) for s in loss.as_py()))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, n), pa.array(turns, pa.list_(turn)), pa.array(lost, pa.string()),
                                                  batch.column("formatted").slice(at, n)], names=["id", "turns", "loss_text", "formatted"])

    kind = rows.schema[id_col].dataType.simpleString()
    return (rows.select(F.col(id_col).alias("id"), "formatted", "loss")
            .mapInArrow(run, f"id {kind}, turns {TURNS}, loss_text string, formatted string").withColumnRenamed("id", id_col))


def gather(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_col, turns) from rows by turn."""
    alone = F.when(F.col(conv_col).isNull(), F.monotonically_increasing_id())
    turn = F.struct(F.col(turn_col).isNull().alias("last"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select(F.col(conv_col).alias("id"), alone.alias("alone"), turn.alias("t"))
    turns = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["role"], t["text"]))
    return rows.groupBy("id", "alone").agg(turns.alias("turns")).select(F.col("id").alias(conv_col), "turns")


def as_records(conversations: DataFrame, layout: Column) -> DataFrame:
    """``conversations`` (id and turns) as JSON records: ``layout`` names the layout wanted for a row; where its turns don't fit
    into that one, they are stored as ``messages``."""
    roles = F.transform("turns", lambda t: t["role"])
    role = {r: F.get("turns", F.lit(i))["text"] for i, r in enumerate(("0", "1", "2"))}

    def renamed(r):
        return F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    usual = F.forall(roles, lambda r: ~r.isin("human", "gpt"))
    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    three = roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    keep = {"ignoreNullFields": "false"}
    some = F.size("turns") > 0
    record = (
        F.when((layout == "from-value") & usual & some, F.to_json(F.struct(F.transform("turns", lambda t: F.struct(
            renamed(t["role"]).alias("from"), t["text"].alias("value"))).alias("conversations")), keep))
        .when((layout == "nested") & some, F.to_json(F.struct(F.struct(F.transform("turns", lambda t: F.struct(
            F.struct(t["role"].alias("role")).alias("speaker"), F.struct(t["text"].alias("text")).alias("utterance"))).alias("dialog")).alias("data")), keep))
        .when((layout == "prompt") & pair, F.to_json(F.struct(role["0"].alias("prompt"), role["1"].alias("completion")), keep))
        .when((layout == "instruction") & three, F.to_json(F.struct(role["0"].alias("system"), role["1"].alias("instruction"), role["2"].alias("output")), keep))
        .when((layout == "question") & three, F.to_json(F.struct(role["0"].alias("system"), role["1"].alias("question"), role["2"].alias("answer")), keep))
        .otherwise(F.to_json(F.struct(F.transform("turns", lambda t: F.struct(t["role"], t["text"].alias("content"))).alias("messages")), keep)))
    return conversations.withColumn("record", record).drop("turns")
