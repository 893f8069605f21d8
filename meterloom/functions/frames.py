"""Server-sent event frames of a chat stream."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterloom.functions.text import strip

DATA_PREFIX = "data:"
DONE_MARK = "[DONE]"

CHUNK_SCHEMA = """
    choices array<struct<
        delta: struct<role: string, content: string, reasoning: string,
                      reasoning_content: string>,
        text: string,
        finish_reason: string>>,
    usage struct<prompt_tokens: bigint, completion_tokens: bigint>
"""
DELTA_SCHEMA = "choices array<struct<delta: string>>"


def payload_of(line: Column) -> Column:
    """What follows ``data:``; null on any other line."""
    return F.when(
        line.startswith(DATA_PREFIX), strip(F.substr(line, F.lit(len(DATA_PREFIX) + 1)))
    )


def read_chunk(payload: Column) -> Column:
    """The frame as a struct; all fields are null on malformed JSON."""
    return F.from_json(payload, CHUNK_SCHEMA)


def _filled(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) != ""


def text_choices(chunk: Column) -> Column:
    """R2: choices whose delta carries text in any of the three fields."""
    return _count(
        chunk,
        lambda d: _filled(d["content"])
        | _filled(d["reasoning_content"])
        | _filled(d["reasoning"]),
    )


def content_choices(chunk: Column) -> Column:
    """What a meter that knows only ``content`` would count."""
    return _count(chunk, lambda d: _filled(d["content"]))


def thinking_choices(chunk: Column) -> Column:
    """Choices with thinking; the newer field wins when a delta has both."""
    return _count(chunk, lambda d: _filled(F.coalesce(d["reasoning"], d["reasoning_content"])))


def _count(chunk: Column, test) -> Column:
    hits = F.filter(chunk["choices"], lambda c: test(c["delta"]))
    return F.coalesce(F.when(chunk["choices"].isNotNull(), F.size(hits)), F.lit(0))


def delta_keys(payload: Column) -> Column:
    """The keys of every delta of a frame."""
    choices = F.from_json(payload, DELTA_SCHEMA)["choices"]
    keys = F.transform(
        choices, lambda c: F.map_keys(F.from_json(c["delta"], "map<string,string>"))
    )
    return F.flatten(F.filter(keys, lambda k: k.isNotNull()))
