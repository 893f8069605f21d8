"""The job watcher as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from meterloom.operators.logs import TERMINAL, failure_reason
from meterloom.streaming.held import Held

FEED_SCHEMA = "job string, poll bigint, status string, previous string, reason string"


class Changes(Held):
    """The last poll of a job, and the polls that the watermark has not passed."""

    KNOWN = "poll bigint, at_ms bigint, status string"

    def __init__(self, keep_ms: int, give_up_ms: int) -> None:
        self.keep_ms, self.give_up_ms = keep_ms, give_up_ms

    def read(self, row: Row) -> tuple:
        return row.poll, row.at_ms, row.status, row.reason

    def fold(
        self, key: tuple, known: tuple | None, ready: list[tuple], now: int
    ) -> tuple[list[Row], tuple | None, int | None]:
        out = []
        for poll, at_ms, status, reason in ready:
            if known and poll <= known[0]:
                continue
            previous = known[2] if known else None
            if status != previous:
                out.append(Row(job=key[0], poll=poll, status=status, previous=previous, reason=reason))
            known = (poll, at_ms, status)
        if known is None:
            return out, None, None
        ends = known[1] + (self.keep_ms if known[2] in TERMINAL else self.give_up_ms)
        return (out, None, None) if now >= ends else (out, known, ends)


def status_feed(
    polls: DataFrame,
    *,
    delay: str = "10 minutes",
    keep_ms: int = 3_600_000,
    give_up_ms: int = 7 * 86_400_000,
) -> DataFrame:
    """W8 as a stream: one row per change, with the reason of a failure.

    ``polls`` is a streaming ``job, poll, ts, status`` and perhaps ``reason``, in which time
    does not fall along ``poll``. Polls that come out of order, but not later than
    ``delay``, are put in order: the rows are those of
    :func:`meterloom.operators.logs.status_changes`. A job leaves the state ``keep_ms`` after
    its last poll if that was terminal, ``give_up_ms`` after it if not; a poll that comes
    even later starts the job anew. Needs :func:`meterloom.streaming.held.use_rocksdb`.
    """
    state = F.coalesce(F.nullif(F.col("status"), F.lit("")), F.lit("?"))
    told = F.col("reason") if "reason" in polls.columns else F.lit(None).cast("string")
    at = F.col("ts").cast("timestamp")
    known = polls.select(
        F.col("job").cast("string").alias("job"),
        F.col("poll").cast("bigint").alias("poll"),
        at.alias("ts"),
        F.unix_millis(at).alias("at_ms"),
        state.alias("status"),
        failure_reason(state, told).alias("reason"),
    ).withWatermark("ts", delay)
    return known.groupBy("job").transformWithState(
        Changes(keep_ms, give_up_ms), FEED_SCHEMA, "append", "eventTime"
    )


def watch_progress(feed: DataFrame, *by: str) -> DataFrame:
    """W10 over a feed of changes: how many jobs a watch list has, and how many have ended.

    Every change moves the two counts by what it says about its job, so sums are enough: no
    job is looked up and nothing is gathered. The feed may be a table or a stream (in
    complete or update mode).
    """

    def ended(status: str):
        return F.coalesce(F.col(status).isin(*TERMINAL), F.lit(False)).cast("bigint")

    return (
        feed.groupBy(*by)
        .agg(
            F.count_if(F.col("previous").isNull()).alias("jobs"),
            F.sum(ended("status") - ended("previous")).alias("terminal"),
        )
        .withColumn("all_terminal", F.col("jobs") == F.col("terminal"))
    )


def sighting_feed(values: DataFrame, delay: str | None = None) -> DataFrame:
    """W9 as a stream: each (job, channel, name, value) once.

    With ``delay`` the state of a value is dropped that long after it was last needed,
    and a value seen again later counts as new.
    """
    named = F.coalesce(F.col("name"), F.lit("")) != ""
    own = (F.col("channel") == "tag") & F.col("name").startswith("mlflow.")
    key = ["job", "channel", "name", "value"]
    fresh = values.filter(named & ~own)
    if delay is None:
        return fresh.dropDuplicates(key)
    return fresh.withWatermark("ts", delay).dropDuplicatesWithinWatermark(key)
