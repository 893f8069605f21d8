"""Facts and verdicts about single requests and chat replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterloom.functions.text import is_blank

# Tags of the thinking block and the two spellings of its field, newest
# first.
OPEN_THINK = "<think>"
CLOSE_THINK = "</think>"
THINKING_FIELDS = ("reasoning", "reasoning_content")

REPLY_SCHEMA = """
    choices array<struct<
        message: struct<content: string, reasoning: string, reasoning_content: string>,
        finish_reason: string>>,
    usage struct<prompt_tokens: bigint, completion_tokens: bigint, total_tokens: bigint>,
    error string,
    unparsed string
"""


def request_outcome(status: Column, body: Column, exception: Column, tokens: Column) -> Column:
    """``struct<ok, status, error>`` of one request."""
    streamed = F.coalesce(tokens, F.lit(0)) > 0
    failed_http = status != 200
    error = (
        F.when(exception.isNotNull(), F.substring(exception, 1, 200))
        .when(failed_http, F.substring(F.coalesce(body, F.lit("")), 1, 200))
        .when(~streamed, F.lit("no tokens streamed"))
        .otherwise(F.lit(""))
    )
    ok = exception.isNull() & ~failed_http & streamed
    code = F.when(ok | (exception.isNull() & failed_http), status).otherwise(F.lit(0))
    return F.struct(
        F.coalesce(ok, F.lit(False)).alias("ok"), code.alias("status"), error.alias("error")
    )


def seconds_per_token(ttft_s: Column, total_s: Column, tokens: Column) -> Column:
    """Time per output token after the first; 0 when there is no second token."""
    return F.when(tokens > 1, (total_s - ttft_s) / (tokens - 1)).otherwise(F.lit(0.0))


def read_body(body: Column) -> Column:
    """A reply body as a struct; ``unparsed`` holds the text of a malformed one."""
    return F.from_json(body, REPLY_SCHEMA, {"columnNameOfCorruptRecord": "unparsed"})


def reply_facts(reply: Column) -> Column:
    """What one parsed reply holds."""
    choice = F.get(reply["choices"], 0)
    message = choice["message"]
    content = F.coalesce(message["content"], F.lit(""))
    filled = [(name, F.nullif(message[name], F.lit(""))) for name in THINKING_FIELDS]
    return F.struct(
        content.alias("content"),
        F.coalesce(*[value for _, value in filled], F.lit("")).alias("thinking"),
        F.coalesce(*[F.when(v.isNotNull(), F.lit(n)) for n, v in filled]).alias(
            "thinking_field"
        ),
        choice["finish_reason"].alias("finish_reason"),
        reply["usage"]["completion_tokens"].alias("completion_tokens"),
        leaks_thinking(content).alias("trace_leaked"),
    )


def leaks_thinking(content: Column) -> Column:
    return content.contains(CLOSE_THINK) | content.contains(OPEN_THINK)


def reply_verdict(reply: Column, facts: Column) -> Column:
    """``ok`` or the first thing that is wrong with the reply."""
    silent = is_blank(facts["content"])
    return (
        F.when(reply.isNull() | reply["unparsed"].isNotNull(), F.lit("unparseable"))
        .when(reply["error"].isNotNull() & reply["choices"].isNull(), F.lit("server error"))
        .when(facts["trace_leaked"], F.lit("trace leaked"))
        .when(silent & (facts["finish_reason"] == "length"), F.lit("truncated before answer"))
        .when(silent, F.lit("empty"))
        .otherwise(F.lit("ok"))
    )


def budget_used_pct(completion_tokens: Column, max_tokens: Column) -> Column:
    """Null when either side is unknown or zero."""
    return F.when(
        (completion_tokens > 0) & (max_tokens > 0), 100.0 * completion_tokens / max_tokens
    )


def comparison_facts(content: Column, reasoning: Column) -> Column:
    """Sizes of a reply kept for a deployment comparison."""
    return F.struct(
        F.length(F.coalesce(content, F.lit(""))).alias("chars"),
        F.length(F.coalesce(reasoning, F.lit(""))).alias("reasoning_tokens"),
        F.coalesce(content.contains(OPEN_THINK), F.lit(False)).alias("thinking_in_content"),
    )
