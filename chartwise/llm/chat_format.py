"""Chat formatting by schema fingerprints (DataFrame functions only).

A record's fingerprint is a hash of the nested field paths that it fills.  It selects a declarative mapping (a SQL
expression) that turns prompt, instruction or message layouts into canonical turns (role, text).  One table may mix layouts:
the fingerprint is computed per row from the paths that are not null, and only over the paths that some mapping names, so
extra columns do not matter.  Tables with one row a turn are folded first; their layout is known by the same means.

The template writes ``<|im_start|>role\\ntext<|im_end|>\\n`` a turn.  In roles and texts every ``<|`` becomes
``<|lt|>`` and, in roles, a line end ``<|nl|>``, so no text can forge a control string, and reading back restores all.
``segments`` carries the loss mask: parts of the formatted string in order, those to learn marked.

Defined results: null roles and texts are empty; turns in order of (turn, role, text), null turns first, repeated rows are repeated
turns; a null id is a conversation of its own; a layout that no mapping knows has a null ``layout`` and no turns; an empty table gives no rows.
A conversation's result digests all of it, so one conversation is one task's aggregate; a conversation is a document, not a key.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END, LT, NL = "<|im_start|>", "<|im_end|>\n", "<|lt|>", "<|nl|>"
LEARN = "assistant"


@dataclass(frozen=True)
class Mapping:
    """A layout: the paths it fills, and its turns as a SQL expression over them."""

    name: str
    paths: tuple[str, ...]
    turns: str


def _turn(role: str, text: str) -> str:
    return f"named_struct('role', coalesce({role}, ''), 'text', coalesce({text}, ''))"


def _pairs(*parts: tuple[str, str]) -> str:
    return f"array({', '.join(_turn(repr(role), text) for role, text in parts)})"


def _messages(field: str, role: str, text: str) -> str:
    return f"transform({field}, m -> {_turn(role, text)})"


_SPOKEN = ("case lower(m.`from`) when 'human' then 'user' when 'gpt' then 'assistant' when 'bot' then 'assistant' "
           "when 'model' then 'assistant' else m.`from` end")

#: declarative mappings; the fingerprint of ``paths`` is their key
MAPPINGS = (
    Mapping("messages", ("messages[].role", "messages[].content"), _messages("messages", "m.role", "m.content")),
    Mapping("shared", ("conversations[].from", "conversations[].value"), _messages("conversations", _SPOKEN, "m.value")),
    Mapping("turns", ("turns[].role", "turns[].text"), _messages("turns", "m.role", "m.text")),
    Mapping("instruction", ("instruction", "output"), _pairs(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", ("instruction", "input", "output"),
            _pairs(("user", "concat(instruction, '\\n\\n', input)"), ("assistant", "output"))),
    Mapping("prompt_response", ("prompt", "response"), _pairs(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt_completion", ("prompt", "completion"), _pairs(("user", "prompt"), ("assistant", "completion"))),
    Mapping("system_prompt_response", ("system", "prompt", "response"),
            _pairs(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("question_answer", ("question", "answer"), _pairs(("user", "question"), ("assistant", "answer"))),
    Mapping("data_turns", ("data.turns[].role", "data.turns[].text"), _messages("data.turns", "m.role", "m.text")),
)
#: one row a turn
ROWS = ("conv_id", "turn", "role", "text")


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """The nested paths of a schema; ``[]`` marks the elements of an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _filled(path: str) -> str:
    """SQL test that a record fills ``path``; elements of an array count when the array is there."""
    return f"{path.split('[]')[0]} is not null"


def row_fingerprint(paths: list[str]) -> Column:
    """The fingerprint of the paths a row fills; equal to ``fingerprint`` of them."""
    present = F.array(*[F.when(F.expr(_filled(p)), F.lit(p)) for p in sorted(paths)])
    return F.sha2(F.array_join(F.array_compact(present), "\n"), 256)


def canonical_turns(records: DataFrame, mappings=MAPPINGS) -> DataFrame:
    """``records`` with ``layout`` (the mapping's name) and ``turns``, an array of (role, text)."""
    have = set(field_paths(records.schema))
    usable = [m for m in mappings if set(m.paths) <= have]
    names = "layout", "turns"
    kept = [F.col(c) for c in records.columns if c not in names]
    empty = F.expr("cast(null as array<struct<role:string,text:string>>)")
    if not usable:
        return records.select(*kept, F.lit(None).cast("string").alias("layout"), empty.alias("turns"))
    mark = row_fingerprint(sorted({p for m in usable for p in m.paths}))
    layout, turns = F.lit(None).cast("string"), empty
    for m in usable:
        layout = F.when(mark == fingerprint(m.paths), F.lit(m.name)).otherwise(layout)
        turns = F.when(mark == fingerprint(m.paths), F.expr(m.turns)).otherwise(turns)
    return records.select(*kept, layout.alias("layout"), turns.alias("turns"))


def fold_rows(rows: DataFrame) -> DataFrame:
    """One record a conversation from one row a turn: (conv_id, turns)."""
    turns = F.transform(F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))),
        lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return rows.select(*ROWS).groupBy("conv_id").agg(turns.alias("turns"))


def records_of(table: DataFrame) -> DataFrame:
    """``table`` as one record a conversation, folded if its paths hold those of one row a turn."""
    return fold_rows(table) if set(ROWS) <= set(field_paths(table.schema)) else table


def _escape(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit(LT))


def _restore(text: Column) -> Column:
    return F.replace(text, F.lit(LT), F.lit("<|"))


def _segment(text: Column, learn: Column) -> Column:
    return F.struct(text.alias("text"), learn.alias("learn"))


def format_chats(records: DataFrame) -> DataFrame:
    """``records`` with ``formatted`` and ``segments``, its parts in order with the loss mask."""
    no = F.lit(False)
    parts = F.flatten(F.transform(F.coalesce("turns", F.expr("cast(array() as array<struct<role:string,text:string>>)")), lambda t: F.array(
        _segment(F.concat(F.lit(START), F.replace(_escape(t["role"]), F.lit("\n"), F.lit(NL)), F.lit("\n")), no),
        _segment(_escape(t["text"]), t["role"] == LEARN),
        _segment(F.lit(END), no))))
    kept = [F.col(c) for c in records.columns if c not in ("formatted", "segments")]
    out = records.select(*kept, parts.alias("segments"))
    return out.select("*", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)            # what follows the last turn is empty

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, "\n")
        role = F.substring(piece, F.lit(len(START) + 1), cut - F.lit(len(START) + 1))
        text = F.substring(piece, cut + 1, F.length(piece))
        return F.struct(_restore(F.replace(role, F.lit(NL), F.lit("\n"))).alias("role"), _restore(text).alias("text"))

    return F.transform(pieces, turn)


def chat_digests(chats: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Counts and digests of what the formatted strings and masks hold, read back from them."""
    back = chats.select(id_col, "layout", "formatted", "segments", read_back(F.col("formatted")).alias("read"))
    learnt = F.array_join(F.transform(F.filter("segments", lambda s: s["learn"]), lambda s: _restore(s["text"])), "")
    back = back.select("*", learnt.alias("learnt"))
    lines = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        id_col, F.size("read").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
