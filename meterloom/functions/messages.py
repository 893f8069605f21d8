"""Chat messages: rows of any schema to ``array<struct<role, content>>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from meterloom.functions.text import is_blank, normalize_text

# Field names seen in published datasets, in priority order, and the role
# spellings that occur in them.
INSTRUCTION_KEYS = ("instruction", "prompt", "question", "input_text")
INPUT_KEYS = ("input", "context")
OUTPUT_KEYS = ("output", "response", "answer", "completion", "chosen")
CONVERSATION_KEYS = ("messages", "conversations", "conversation")
ROLE_ALIASES = {
    "human": "user",
    "user": "user",
    "prompter": "user",
    "gpt": "assistant",
    "assistant": "assistant",
    "bot": "assistant",
    "system": "system",
}

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


def normalize_role(role: Column) -> Column:
    """User, assistant or system; null for anything else."""
    aliases = F.create_map(*[F.lit(x) for pair in ROLE_ALIASES.items() for x in pair])
    return F.try_element_at(aliases, F.lower(role))


def _message(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def _filled(name: str, schema: StructType) -> Column | None:
    """Whether a column holds a non-blank string or a non-empty list."""
    kind = schema[name].dataType
    if isinstance(kind, StringType):
        return ~is_blank(F.col(name))
    if isinstance(kind, ArrayType):
        return F.coalesce(F.size(F.col(name)) > 0, F.lit(False))
    return None


def first_text(schema: StructType, keys: Sequence[str]) -> Column:
    """T6 over a schema: the first filled column of ``keys``, if it is a string.

    A list that comes first blocks the string columns after it.
    """
    chosen = F.lit(None).cast("string")
    for name in reversed([k for k in keys if k in schema.fieldNames()]):
        filled = _filled(name, schema)
        if filled is None:
            continue
        is_text = isinstance(schema[name].dataType, StringType)
        value = F.col(name) if is_text else F.lit(None).cast("string")
        chosen = F.when(filled, value).otherwise(chosen)
    return chosen


def clean_turns(turns: Column, element: StructType) -> Column:
    """P5: turns with a known role and some content; null under two of them."""

    def pick(turn: Column, first: str, second: str) -> Column:
        found = [
            F.nullif(turn[name], F.lit(""))
            for name in (first, second)
            if name in element.fieldNames() and isinstance(element[name].dataType, StringType)
        ]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    renamed = F.transform(
        turns,
        lambda t: _message(
            normalize_role(pick(t, "role", "from")), pick(t, "content", "value")
        ),
    )
    kept = F.filter(renamed, lambda m: m["role"].isNotNull() & ~is_blank(m["content"]))
    whole = ~F.exists(turns, lambda t: t.isNull())
    return F.when(whole & (F.size(kept) >= 2), kept)


def to_messages(schema: StructType) -> Column:
    """Messages of a row, or null when the row is unusable.

    Conversation columns come first; a filled conversation column that is not a list
    falls through to the instruction and output columns.
    """
    nothing = F.lit(None).cast(MESSAGES_TYPE)
    instruction = first_text(schema, INSTRUCTION_KEYS)
    output = first_text(schema, OUTPUT_KEYS)
    extra = first_text(schema, INPUT_KEYS)
    user = F.concat_ws("\n\n", instruction, extra)
    pair = F.when(
        instruction.isNotNull() & output.isNotNull(),
        F.array(_message(F.lit("user"), user), _message(F.lit("assistant"), output)),
    )
    chosen = pair
    for name in reversed([k for k in CONVERSATION_KEYS if k in schema.fieldNames()]):
        filled = _filled(name, schema)
        if filled is None:
            continue
        kind = schema[name].dataType
        if isinstance(kind, StringType):
            value = pair
        elif isinstance(kind.elementType, StructType):
            value = clean_turns(F.col(name), kind.elementType)
        else:
            value = nothing
        chosen = F.when(filled, value).otherwise(chosen)
    return chosen


def render_plain(messages: Column) -> Column:
    """Contents joined by newlines."""
    return F.array_join(F.transform(messages, lambda m: m["content"]), "\n")


def chat_messages(
    instruction: Column, input_text: Column, output: Column, system: str = ""
) -> Column:
    """System turn (optional), user turn, assistant turn, from normalised columns."""
    user = F.when(input_text != "", F.concat_ws("\n\n", instruction, input_text)).otherwise(
        instruction
    )
    turns = [_message(F.lit("user"), user), _message(F.lit("assistant"), output)]
    if system:
        turns.insert(0, _message(F.lit("system"), normalize_text(F.lit(system))))
    return F.array(*turns)


def chat_record(messages: Column, source: Column) -> Column:
    """One JSON object; an empty source leaves the field out."""
    return F.to_json(
        F.struct(messages.alias("messages"), F.nullif(source, F.lit("")).alias("source"))
    )
