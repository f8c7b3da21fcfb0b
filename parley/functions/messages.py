"""Chat messages: building, testing, keying and rendering.

A conversation is one column of type ``array<struct<role,content>>``. All
functions here are column expressions; the only Python hop is NFKC.

``null_policy`` says what a null field inside an example means:
``"missing"`` (default) treats it as absent, ``"literal"`` as the text "None".
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.constants import ASSISTANT, SYSTEM, USER
from parley.functions.roles import is_alias, role_of
from parley.functions.text import compact_text, is_blank, let, nfkc_array, normalize_text, strip, tidy

MESSAGE = T.StructType().add("role", T.StringType()).add("content", T.StringType())
MESSAGES = T.ArrayType(MESSAGE)

ROLE_FIELDS = ("role",)
CONTENT_FIELDS = ("content",)
SPEAKER_FIELDS = ("from", "role")
VALUE_FIELDS = ("value", "content")
# Two-column shapes in order of precedence: (user column, assistant column).
PAIR_COLUMNS = (("prompt", "response"), ("question", "answer"))
SHAPE_COLUMNS = (
    "messages",
    "conversations",
    "instruction",
    "input",
    "output",
    "prompt",
    "response",
    "question",
    "answer",
    "text",
)


def _none() -> Column:
    return F.lit(None).cast(MESSAGES)


def _or_null(messages: Column) -> Column:
    """An empty list becomes null."""
    return F.get(F.filter(F.array(messages), lambda m: F.size(m) > 0), F.lit(0))


def _as_text(col: Column, null_policy: str) -> Column:
    if null_policy not in ("missing", "literal"):
        raise ValueError(f"null_policy must be 'missing' or 'literal', not {null_policy!r}")
    text = col.cast("string")
    return F.coalesce(text, F.lit("None")) if null_policy == "literal" else text


def _first_field(item: Column, names: Sequence[str], default: str, null_policy: str) -> Column:
    """Value of the first of ``names``; a missing one falls to the next, then to ``default``."""
    if not names:
        return F.lit(default)
    if null_policy == "literal":
        return _as_text(item[names[0]], null_policy)
    return F.coalesce(*[_as_text(item[n], null_policy) for n in names], F.lit(default))


def _turns(
    items: Column,
    speakers: Sequence[str],
    values: Sequence[str],
    null_policy: str,
    build: Callable[[Column, Column], Column],
) -> Column:
    """Normalise both fields of every list item, drop items without text.

    Both lists cross to the Arrow function as plain string arrays, outside any
    lambda, in one hop.
    """
    names = F.transform(items, lambda m: _first_field(m, speakers, USER, null_policy))
    texts = F.transform(
        items, lambda m: F.when(m.isNull(), "").otherwise(_first_field(m, values, "", null_policy))
    )
    turns = F.zip_with(
        F.transform(nfkc_array(names), tidy),
        F.transform(nfkc_array(texts), tidy),
        build,
    )
    return F.filter(turns, lambda t: t["content"] != "")


def _message(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def from_messages(
    col: Column,
    null_policy: str = "missing",
    role_fields: Sequence[str] = ROLE_FIELDS,
    content_fields: Sequence[str] = CONTENT_FIELDS,
) -> Column:
    """A list of role/content structs. Unknown roles are users; empty turns go."""
    turns = _turns(col, role_fields, content_fields, null_policy, lambda n, c: _message(role_of(n), c))
    return _or_null(turns)


def from_conversations(
    col: Column,
    null_policy: str = "missing",
    speaker_fields: Sequence[str] = SPEAKER_FIELDS,
    value_fields: Sequence[str] = VALUE_FIELDS,
) -> Column:
    """A list of speaker/text structs; roles of unknown speakers follow from position."""
    turns = _turns(
        col,
        speaker_fields,
        value_fields,
        null_policy,
        lambda n, c: F.struct(n.alias("speaker"), c.alias("content")),
    )
    return _or_null(infer_roles(turns))


def infer_roles(turns: Column) -> Column:
    """Roles for ``array<struct<speaker,content>>`` of normalised, non-empty turns.

    A leading system turn stays system, a later one becomes assistant. Speakers
    outside the alias table who would be users alternate user, assistant, by
    their position after the leading system turn.
    """
    named = F.transform(
        turns,
        lambda t: F.struct(
            role_of(t["speaker"]).alias("role"),
            is_alias(t["speaker"]).alias("known"),
            t["content"].alias("content"),
        ),
    )

    def assign(all_turns: Column) -> Column:
        lead = F.coalesce(F.get(all_turns, F.lit(0))["role"] == SYSTEM, F.lit(False))

        def one(t: Column, i: Column) -> Column:
            even = (i - lead.cast("int")) % 2 == 0
            role = (
                F.when(lead & (i == 0), F.lit(SYSTEM))
                .when(t["role"] == SYSTEM, F.lit(ASSISTANT))
                .when((t["role"] == USER) & ~t["known"] & ~even, F.lit(ASSISTANT))
                .otherwise(t["role"])
            )
            return _message(role, t["content"])

        return F.transform(all_turns, one)

    return let(named, assign)


def _pair(user: Column, assistant: Column) -> Column:
    def both(p: Column) -> Column:
        filled = (p["user"] != "") & (p["assistant"] != "")
        return F.when(
            filled,
            F.array(
                _message(F.lit(USER), p["user"]), _message(F.lit(ASSISTANT), p["assistant"])
            ),
        )

    return let(F.struct(user.alias("user"), assistant.alias("assistant")), both)


def from_pair(prompt: Column, response: Column, null_policy: str = "missing") -> Column:
    """A prompt and its response; null if either is empty."""
    return _pair(
        normalize_text(_as_text(prompt, null_policy)), normalize_text(_as_text(response, null_policy))
    )


def from_qa(question: Column, answer: Column, null_policy: str = "missing") -> Column:
    """A question and its answer; null if either is empty."""
    return from_pair(question, answer, null_policy)


def from_instruction(
    instruction: Column, input: Column | None, output: Column, null_policy: str = "missing"
) -> Column:
    """Instruction, optional input on a new line, and output."""
    task = normalize_text(_as_text(instruction, null_policy))
    extra = F.lit("") if input is None else normalize_text(_as_text(input, null_policy))
    answer = normalize_text(_as_text(output, null_policy))
    user = let(
        F.struct(task.alias("task"), extra.alias("extra")),
        lambda t: F.when((t["task"] == "") | (t["extra"] == ""), t["task"]).otherwise(
            F.concat_ws("\n", t["task"], t["extra"])
        ),
    )
    return _pair(user, answer)


def from_text(text: Column) -> Column:
    """Plain text as a single user message."""
    return let(
        normalize_text(text),
        lambda content: F.when(content != "", F.array(_message(F.lit(USER), content))),
    )


def _item_fields(df: DataFrame, column: str, names: Sequence[str]) -> list[str] | None:
    """Which of ``names`` the list items of a column have; None if it is no list of structs."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return [n for n in names if n in kind.elementType.names]
    return None


def _is_list(df: DataFrame, column: str) -> bool:
    return column in df.columns and isinstance(df.schema[column].dataType, T.ArrayType)


@dataclass(frozen=True)
class _Shape:
    """One accepted input shape: when a row has it, and what it yields."""

    test: Column | None
    messages: Column
    filled: Column


def _list_shape(df: DataFrame, column: str, null_policy: str) -> _Shape:
    chat = column == "messages"
    speakers = _item_fields(df, column, ROLE_FIELDS if chat else SPEAKER_FIELDS)
    values = _item_fields(df, column, CONTENT_FIELDS if chat else VALUE_FIELDS)
    items = F.col(column)
    if speakers is None or values is None:
        return _Shape(items.isNotNull(), _none(), F.lit(False))
    build = from_messages if chat else from_conversations
    filled = F.exists(
        items,
        lambda m: m.isNotNull() & ~is_blank(_first_field(m, values, "", null_policy)),
    )
    return _Shape(items.isNotNull(), build(items, null_policy, speakers, values), filled)


def _flat_shape(df: DataFrame, null_policy: str) -> _Shape:
    have = set(df.columns)

    def filled(*names: str) -> Column:
        test = F.lit(True)
        for n in names:
            test = test & ~is_blank(_as_text(F.col(n), null_policy))
        return test

    if {"instruction", "output"} <= have:
        extra = F.col("input") if "input" in have else None
        made = from_instruction(F.col("instruction"), extra, F.col("output"), null_policy)
        return _Shape(None, made, filled("instruction", "output"))
    for user, assistant in PAIR_COLUMNS:
        if {user, assistant} <= have:
            return _Shape(
                None, from_pair(F.col(user), F.col(assistant), null_policy), filled(user, assistant)
            )
    if "text" in have and isinstance(df.schema["text"].dataType, T.StringType):
        return _Shape(None, from_text(F.col("text")), ~is_blank(F.col("text")))
    return _Shape(None, _none(), F.lit(False))


def _dispatch(df: DataFrame, null_policy: str, part: str) -> Column:
    result = getattr(_flat_shape(df, null_policy), part)
    for column in ("conversations", "messages"):
        if _is_list(df, column):
            shape = _list_shape(df, column, null_policy)
            result = F.when(shape.test, getattr(shape, part)).otherwise(result)
    return result


def to_messages(df: DataFrame, null_policy: str = "missing") -> Column:
    """Messages of each row, whatever accepted shape it has; null if it has none.

    Which columns exist is known from the schema, so at most three branches
    remain at run time: a ``messages`` list, a ``conversations`` list, and one
    flat shape (instruction, prompt/response, question/answer or text).
    """
    return _dispatch(df, null_policy, "messages")


def has_messages(df: DataFrame, null_policy: str = "missing") -> Column:
    """Whether ``to_messages`` would be non-null, decided without any Python hop."""
    return F.coalesce(_dispatch(df, null_policy, "filled"), F.lit(False))


def is_chat_pair(messages: Column) -> Column:
    """At least two messages with content, the last from the assistant, one from a user."""
    return F.coalesce(
        let(
            F.filter(messages, lambda m: F.coalesce(m["content"] != "", F.lit(False))),
            lambda kept: (F.size(kept) >= 2)
            & (F.get(kept, F.size(kept) - 1)["role"] == ASSISTANT)
            & F.exists(kept, lambda m: m["role"] == USER),
        ),
        F.lit(False),
    )


def content_key(messages: Column) -> Column:
    """SHA-1 of the role-tagged contents, blind to whitespace differences."""
    lines = F.transform(
        F.filter(messages, lambda m: m["content"] != ""),
        lambda m: F.concat(m["role"], F.lit(":"), compact_text(m["content"])),
    )
    return F.sha1(F.array_join(lines, "\n"))


def row_key(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """SHA-1 of all non-blank string columns, for rows that hold no messages."""
    names = columns if columns is not None else [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    parts = [
        F.when(strip(F.col(f"`{n}`")) != "", F.concat(F.lit(f"{n}:"), compact_text(F.col(f"`{n}`")))) for n in names
    ]
    return F.sha1(F.concat_ws("\n", *parts)) if parts else F.sha1(F.lit(""))


@dataclass(frozen=True)
class ChatTemplate:
    """How messages become one text: ``head`` and ``tail`` may hold ``{role}``."""

    head: str
    tail: str
    separator: str = ""
    stripped: bool = False
    generation_prompt: str = ""


# Chat text formats.
TEMPLATES = {
    "tagged": ChatTemplate(head="<|{role}|>\n", tail="\n", separator="\n", stripped=True),
    "chatml": ChatTemplate(
        head="<|im_start|>{role}\n",
        tail="<|im_end|>\n",
        generation_prompt="<|im_start|>assistant\n",
    ),
}


def render_chat(
    messages: Column, template: str | ChatTemplate = "tagged", add_generation_prompt: bool = False
) -> Column:
    """One text per conversation. Roles other than system and user count as assistant."""
    form = TEMPLATES[template] if isinstance(template, str) else template

    def fill(pattern: str, role: Column) -> Column:
        pieces = pattern.split("{role}")
        out = [F.lit(pieces[0])]
        for piece in pieces[1:]:
            out += [role, F.lit(piece)]
        return F.concat(*out)

    def one(m: Column) -> Column:
        role = F.when(m["role"].isin(SYSTEM, USER), m["role"]).otherwise(F.lit(ASSISTANT))
        return F.concat(fill(form.head, role), m["content"], fill(form.tail, role))

    text = F.array_join(F.transform(messages, one), form.separator)
    if add_generation_prompt and form.generation_prompt:
        text = F.concat(text, F.lit(form.generation_prompt))
    return strip(text) if form.stripped else text


def extract_reply(df: DataFrame, column: str) -> Column:
    """The reply in a generated value: last message's content, or the text itself."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.ArrayType):
        value = F.try_element_at(value, F.lit(-1))["content"]
    return F.coalesce(strip(value.cast("string")), F.lit(""))
