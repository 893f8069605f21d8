"""R1 to R6 on a live stream: many interleaved requests, one state per request.

Frames are parsed and narrowed by expressions before the shuffle, so neither JSON nor
text reaches the state. A request's state is a dozen numbers, and the frames that the
watermark has not passed.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from meterloom.operators.streams import MICROS, parse_frames
from meterloom.streaming.held import Held

OUTPUT_SCHEMA = """
    request_id string, counted bigint, content_chunks bigint, thinking_chunks bigint,
    usage_tokens bigint, finish_reason string, done boolean, ok boolean, ttft_s double,
    e2e_s double, output_tokens bigint, chunks_per_s double, old_meter_blind boolean,
    late_frames bigint
"""


class Frame(NamedTuple):
    seq: int
    at_ms: int
    at_us: int
    is_done: bool
    text: int
    content: int
    thinking: int
    usage: int | None
    finish: str | None


class Sums(NamedTuple):
    """What is known of a request; ``told`` once its row was emitted."""

    start: int
    last: int
    first: int | None = None
    counted: int = 0
    content: int = 0
    thinking: int = 0
    usage: int | None = None
    finish: str | None = None
    done: bool = False
    late: int = 0
    told: bool = False


class Accounts(Held):
    KNOWN = """start bigint, last bigint, first bigint, counted bigint, content bigint,
        thinking bigint, usage bigint, finish string, done boolean, late bigint, told boolean"""

    def __init__(self, timeout_ms: int) -> None:
        self.timeout_ms = timeout_ms

    def read(self, row: Row) -> tuple:
        return tuple(
            Frame(
                row.seq, row.at_us // 1000, row.at_us, row.is_done, row.text_choices,
                row.content_choices, row.thinking_choices, row.usage_tokens, row.finish_reason,
            )
        )

    def fold(
        self, key: tuple, known: tuple | None, ready: list[tuple], now: int
    ) -> tuple[list[Row], tuple | None, int | None]:
        sums = Sums(*known) if known else None
        for row in ready:
            sums = _absorb(sums, Frame(*row))
        if sums is None:
            return [], None, None
        ends = sums.last // 1000 + self.timeout_ms
        out = []
        if not sums.told and (sums.done or now >= ends):
            out.append(_account(key[0], sums))
            sums = sums._replace(told=True)
        # A request that was told is remembered as long as a silent one is waited for, so
        # that what comes too late does not open it again.
        if sums.told and now >= ends:
            return out, None, None
        return out, tuple(sums), ends


def _absorb(sums: Sums | None, frame: Frame) -> Sums:
    sums = sums or Sums(frame.at_us, frame.at_us)
    if sums.done or sums.told:
        return sums._replace(late=sums.late + 1)
    has_text = frame.text > 0
    return sums._replace(
        start=min(sums.start, frame.at_us),
        last=max(sums.last, frame.at_us),
        first=frame.at_us if has_text and sums.first is None else sums.first,
        counted=sums.counted + frame.text,
        content=sums.content + frame.content,
        thinking=sums.thinking + frame.thinking,
        usage=frame.usage if (frame.usage or 0) > 0 else sums.usage,
        finish=sums.finish if frame.finish is None else frame.finish,
        done=frame.is_done,
    )


def _account(request: str, sums: Sums) -> Row:
    elapsed = (sums.last - sums.start) / MICROS
    ok = sums.counted > 0
    chunks = sums.content + sums.thinking
    return Row(
        request_id=request,
        counted=sums.counted,
        content_chunks=sums.content,
        thinking_chunks=sums.thinking,
        usage_tokens=sums.usage,
        finish_reason=sums.finish,
        done=sums.done,
        ok=ok,
        ttft_s=(sums.first - sums.start) / MICROS if ok else None,
        e2e_s=elapsed,
        output_tokens=sums.counted if sums.usage is None else sums.usage,
        chunks_per_s=chunks / elapsed if elapsed > 0 else None,
        old_meter_blind=ok and sums.content == 0,
        late_frames=sums.late,
    )


def account_live(
    frames: DataFrame, *, delay: str = "30 seconds", timeout_ms: int = 600_000
) -> DataFrame:
    """R2 to R5 as a stream: one row per request.

    A request is emitted when the watermark (``delay`` behind the latest frame) has passed
    its ``[DONE]``, or ``timeout_ms`` of silence. Frames may come in any order and in any
    batches, as long as none is later than ``delay``; the rows are those of
    :func:`meterloom.operators.streams.account_streams`. ``late_frames`` counts what a
    request sent after its ``[DONE]``. ``frames`` is a streaming ``request_id, seq, ts, line``
    in which time does not fall along ``seq``. Needs
    :func:`meterloom.streaming.held.use_rocksdb`. Add
    :func:`meterloom.operators.streams.diagnose` for R6.
    """
    # Event time must be a plain timestamp; recorded times may lack a zone.
    parsed = (
        parse_frames(frames)
        .withColumn("request_id", F.col("request_id").cast("string"))
        .withColumn("ts", F.timestamp_micros("at_us"))
        .withWatermark("ts", delay)
    )
    return parsed.groupBy("request_id").transformWithState(
        Accounts(timeout_ms), OUTPUT_SCHEMA, "append", "eventTime"
    )
