"""Token-stream accounting over recorded frames of many requests.

``frames`` holds ``request_id, seq, ts, line``: every recorded line of a response, in
order, the first one marking when the request was sent. The same facts are computed from
a live stream in :mod:`meterloom.streaming`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from meterloom.functions import frames as fr
from meterloom.functions.replies import CLOSE_THINK
from meterloom.operators.ordered import BLOCK_ROWS, measured, with_group_facts, with_neighbour
from meterloom.operators.quantiles import exact_quantiles
from meterloom.operators.serving import LEVEL
from meterloom.session import stage

MICROS = 1_000_000


def epoch_micros(df: DataFrame, ts: str = "ts") -> Column:
    """Microseconds since 1970, without going through the session time zone."""
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    return F.unix_micros(ts)


def parse_frames(frames: DataFrame) -> DataFrame:
    """R1, R2 and R4 per line: narrow facts, the payload text is not carried on."""
    return (
        frames.withColumn("_payload", fr.payload_of(F.col("line")))
        .withColumn("is_done", F.coalesce(F.col("_payload") == fr.DONE_MARK, F.lit(False)))
        .withColumn("_chunk", fr.read_chunk(F.col("_payload")))
        .select(
            *[c for c in frames.columns if c != "line"],
            epoch_micros(frames).alias("at_us"),
            "is_done",
            fr.text_choices(F.col("_chunk")).alias("text_choices"),
            fr.content_choices(F.col("_chunk")).alias("content_choices"),
            fr.thinking_choices(F.col("_chunk")).alias("thinking_choices"),
            F.col("_chunk.usage.completion_tokens").alias("usage_tokens"),
            F.get(F.col("_chunk.choices"), 0)["finish_reason"].alias("finish_reason"),
        )
    )


def before_done(parsed: DataFrame, request: str = "request_id") -> DataFrame:
    """Drop what a request sent after its ``[DONE]``."""
    done = F.when(F.col("is_done"), F.col("seq"))
    return (
        with_group_facts(parsed, [request], {"_done": ("min", done)})
        .filter(F.col("_done").isNull() | (F.col("seq") <= F.col("_done")))
        .drop("_done")
    )


def account_streams(parsed: DataFrame, by: Sequence[str] = ("request_id",)) -> DataFrame:
    """One row per request. Sums and extremes only, so copies combine early.

    ``output_tokens`` prefers the server's last non-zero count; ``usage_tokens`` stays
    null when the server gave none, and then ``counted`` is a lower bound.
    """
    has_text = F.col("text_choices") > 0
    elapsed = (F.col("_last") - F.col("_start")) / MICROS
    return (
        parsed.groupBy(*by)
        .agg(
            F.min("at_us").alias("_start"),
            F.max("at_us").alias("_last"),
            F.min(F.when(has_text, F.struct("seq", "at_us")))["at_us"].alias("_first"),
            F.sum("text_choices").alias("counted"),
            F.sum("content_choices").alias("content_chunks"),
            F.sum("thinking_choices").alias("thinking_chunks"),
            F.max(F.when(F.col("usage_tokens") > 0, F.struct("seq", "usage_tokens")))[
                "usage_tokens"
            ].alias("usage_tokens"),
            F.max(
                F.when(F.col("finish_reason").isNotNull(), F.struct("seq", "finish_reason"))
            )["finish_reason"].alias("finish_reason"),
            F.max("is_done").alias("done"),
        )
        .withColumn("ok", F.col("counted") > 0)
        .withColumn("ttft_s", (F.col("_first") - F.col("_start")) / MICROS)
        .withColumn("e2e_s", elapsed)
        .withColumn("output_tokens", F.coalesce("usage_tokens", "counted"))
        .withColumn(
            "chunks_per_s",
            F.when(
                elapsed > 0, (F.col("content_chunks") + F.col("thinking_chunks")) / elapsed
            ),
        )
        .withColumn("old_meter_blind", (F.col("content_chunks") == 0) & F.col("ok"))
        .drop("_start", "_last", "_first")
    )


def cap_usage(accounts: DataFrame, max_tokens: Column) -> DataFrame:
    """Tokens against the cap; ``at_least`` when the server reported no count."""
    known = F.col("usage_tokens").isNotNull()
    return (
        accounts.withColumn("at_least", ~known & F.col("ok"))
        .withColumn("used_tokens", F.coalesce("usage_tokens", "counted"))
        .withColumn(
            "used_pct", F.when(known, F.round(F.col("usage_tokens") * 100 / max_tokens))
        )
    )


def diagnose(
    accounts: DataFrame, raw: Column | None = None, closed: Column | None = None
) -> DataFrame:
    """Why a stream ended the way it did; ``ok`` when nothing is odd.

    ``raw`` marks unparsed streams, ``closed`` whether their thinking block was closed.
    """
    chunks = F.col("content_chunks") + F.col("thinking_chunks")
    unanswered = F.col("content_chunks") == 0
    is_raw = F.lit(False) if raw is None else raw
    is_closed = F.lit(True) if closed is None else closed
    return accounts.withColumn(
        "diagnosis",
        F.when((chunks == 0) & F.col("usage_tokens").isNotNull(), F.lit("billed but unseen"))
        .when(chunks == 0, F.lit("empty"))
        .when(
            (F.col("finish_reason") == "length") & unanswered, F.lit("cut before answer")
        )
        .when(F.col("finish_reason") == "length", F.lit("cut mid-answer"))
        .when(is_raw & ~is_closed, F.lit("thinking never closed"))
        .when(unanswered, F.lit("thinking only"))
        .otherwise(F.lit("ok")),
    )


def request_results(accounts: DataFrame, level: Sequence[str] = LEVEL) -> DataFrame:
    """Stream accounts in the shape the level summary reads."""
    return accounts.select(
        *level,
        "request_id",
        "ok",
        F.when(F.col("ok"), 200).otherwise(0).alias("status"),
        F.when(F.col("ok"), F.lit("")).otherwise(F.lit("no tokens streamed")).alias("error"),
        F.coalesce("ttft_s", F.lit(0.0)).alias("ttft_s"),
        F.col("e2e_s").alias("total_s"),
        "output_tokens",
    )


def chunk_gaps(
    parsed: DataFrame, request: str = "request_id", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Seconds between a text-bearing frame and the one before it.

    The numbers of the frames are written once, so that each line is parsed once.
    """
    has_text = parsed.filter(F.col("text_choices") > 0)
    chunks = stage(has_text.select(request, "seq", "at_us"), "chunks")
    return (
        with_neighbour(chunks, [request], "seq", "_prev", F.col("at_us"), block_rows=block_rows)
        .withColumn("gap_s", (F.col("at_us") - F.col("_prev")) / MICROS)
        .drop("_prev")
    )


def gap_percentiles(
    gaps: DataFrame,
    request: str = "request_id",
    quantiles: Sequence[float] = (0.5, 0.95),
    **options,
) -> DataFrame:
    """Gap percentiles by lower rank, without interpolation."""
    return exact_quantiles(gaps, [request], "gap_s", quantiles, rank="lower", **options)


def delta_key_census(frames: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many deltas carried each key."""
    payload = fr.payload_of(F.col("line"))
    return (
        frames.select(*by, F.explode(fr.delta_keys(payload)).alias("delta_key"))
        .groupBy(*by, "delta_key")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def split_thinking(
    chunks: DataFrame,
    request: str = "request_id",
    position: str = "seq",
    text: str = "text",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``thinking`` and ``content``, the parts of a raw chunk around ``</think>``.

    The tag may be spread over chunks of any size. It can only be completed by a chunk
    together with the seven characters before it, and those lie in at most seven chunks.
    So the two ends of a chunk, and where the tag stands inside it, are all that is
    shuffled; the one row a request that comes of it is written as a table and meets the
    chunks in a join, which is sent to them as long as it is small. Empty chunks are dropped.
    """
    reach = len(CLOSE_THINK) - 1
    filled = chunks.filter(F.coalesce(F.col(text), F.lit("")) != "")
    block = measured(chunks, position, block_rows).block(F.col(position))
    keys = [request, "_block"]

    def last_chars(value: Column) -> Column:
        return F.substring(value, F.greatest(F.length(value) - reach + 1, F.lit(1)), F.lit(reach))

    ends = filled.select(
        request,
        position,
        block.alias("_block"),
        F.substring(text, 1, reach).alias("_head"),
        last_chars(F.col(text)).alias("_tail"),
        F.instr(text, CLOSE_THINK).alias("_inside"),
    )
    # The last characters up to each chunk, from ever twice as many chunks.
    inside = Window.partitionBy(*keys).orderBy(position)
    local = ends.withColumn("_upto", F.col("_tail"))
    for chunks_back in (1, 2, 4):
        further = F.coalesce(F.lag("_upto", chunks_back).over(inside), F.lit(""))
        local = local.withColumn("_upto", last_chars(F.concat(further, "_upto")))
    local = local.withColumn("_seen", F.coalesce(F.lag("_upto").over(inside), F.lit("")))
    tails = local.groupBy(*keys).agg(F.max_by("_upto", F.col(position)).alias("_left"))
    across = Window.partitionBy(request).orderBy("_block").rowsBetween(-reach, -1)
    carried = tails.select(
        *keys, F.array_join(F.collect_list("_left").over(across), "").alias("_carried")
    )
    context = last_chars(F.concat(F.coalesce("_carried", F.lit("")), F.col("_seen")))
    spread = F.instr(F.concat("_context", "_head"), CLOSE_THINK)
    # How many characters of the chunk belong to the thinking part, the tag with it.
    cut = F.when(spread > 0, spread + reach - F.length("_context")).when(
        F.col("_inside") > 0, F.col("_inside") + reach
    )
    closed = (
        local.join(carried, keys, "left")
        .withColumn("_context", context)
        .withColumn("_cut", cut)
        .filter(F.col("_cut").isNotNull())
        .groupBy(request)
        .agg(F.min(F.struct(F.col(position).alias("at"), F.col("_cut").alias("cut"))).alias("_closed"))
        .select(request, F.col("_closed.at").alias("closed_at"), F.col("_closed.cut").alias("_cut"))
    )
    found = filled.join(stage(closed, "closed"), request, "left")
    closes = F.col(position) == F.col("closed_at")
    after = F.coalesce(F.col(position) > F.col("closed_at"), F.lit(False))
    head = F.substring(F.col(text), F.lit(1), F.col("_cut"))
    rest = F.substring(F.col(text), F.col("_cut") + 1, F.length(text))
    return (
        found.withColumn(
            "thinking", F.when(closes, head).when(after, F.lit("")).otherwise(F.col(text))
        )
        .withColumn(
            "content", F.when(closes, rest).when(after, F.col(text)).otherwise(F.lit(""))
        )
        .drop("_cut")
    )
