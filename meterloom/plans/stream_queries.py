"""Registered queries: token streams, in batch and as Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.operators import streams
from meterloom.plans.inputs import (
    chunk_rows,
    frame_rows,
    poll_rows,
    table,
    with_sql,
)
from meterloom.plans.registry import query
from meterloom.session import shared_folder
from meterloom.streaming.frames import account_live
from meterloom.streaming.held import use_rocksdb
from meterloom.streaming.polls import sighting_feed, status_feed, watch_progress

MAX_TOKENS = 64


def parsed(spark: SparkSession, folder: str) -> DataFrame:
    return streams.before_done(streams.parse_frames(frame_rows(spark, folder)))


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    return streams.account_streams(parsed(spark, folder))


@query(
    "parse_frames",
    with_sql("frames")
    + """ SELECT request_id, seq, is_done, has_text::BIGINT AS text_choices,
             (kind = 'content')::BIGINT AS content_choices,
             (kind = 'thinking')::BIGINT AS thinking_choices, usage_tokens, finish_reason
          FROM frames""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = parsed(spark, folder)
    counts = [
        F.col(c).cast("bigint").alias(c)
        for c in ("text_choices", "content_choices", "thinking_choices")
    ]
    return found.select(
        "request_id", "seq", "is_done", *counts, "usage_tokens", "finish_reason"
    )


_ACCOUNT_SQL = """SELECT request_id, counted, content_chunks, thinking_chunks, usage_tokens,
    finish_reason, done, counted > 0 AS ok, round(ttft_s, 6) AS ttft_s, round(e2e_s, 6) AS e2e_s,
    coalesce(usage_tokens, counted) AS output_tokens,
    CASE WHEN e2e_s > 0 THEN round((content_chunks + thinking_chunks) / e2e_s, 9) END
        AS chunks_per_s,
    content_chunks = 0 AND counted > 0 AS old_meter_blind FROM accounts"""


def _rounded(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        *[
            F.round(c, 6).alias(c)
            if c in ("ttft_s", "e2e_s")
            else F.round(c, 9).alias(c)
            if c == "chunks_per_s"
            else F.col(c)
            for c in accounts.columns
        ]
    )


@query("account_streams", with_sql("frames", "accounts") + _ACCOUNT_SQL)
def account_streams(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(accounts(spark, folder))


@query(
    "field_census",
    with_sql("frames", "accounts")
    + """ SELECT request_id, content_chunks AS old_meter,
             content_chunks + thinking_chunks AS all_fields,
             content_chunks = 0 AND content_chunks + thinking_chunks > 0 AS warn
          FROM accounts""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return accounts(spark, folder).select(
        "request_id",
        F.col("content_chunks").alias("old_meter"),
        (F.col("content_chunks") + F.col("thinking_chunks")).alias("all_fields"),
        F.col("old_meter_blind").alias("warn"),
    )


@query(
    "cap_usage",
    with_sql("frames", "accounts")
    + f""" SELECT request_id, usage_tokens IS NULL AND counted > 0 AS at_least,
             coalesce(usage_tokens, counted) AS used_tokens,
             round(usage_tokens * 100 / {MAX_TOKENS}) AS used_pct FROM accounts""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return streams.cap_usage(accounts(spark, folder), F.lit(MAX_TOKENS)).select(
        "request_id", "at_least", "used_tokens", "used_pct"
    )


@query(
    "diagnose_streams",
    with_sql("frames", "accounts")
    + """ SELECT request_id, CASE
            WHEN counted = 0 AND usage_tokens IS NOT NULL THEN 'billed but unseen'
            WHEN counted = 0 THEN 'empty'
            WHEN finish_reason = 'length' AND content_chunks = 0 THEN 'cut before answer'
            WHEN finish_reason = 'length' THEN 'cut mid-answer'
            WHEN content_chunks = 0 THEN 'thinking only' ELSE 'ok' END AS diagnosis
          FROM accounts""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return streams.diagnose(accounts(spark, folder)).select("request_id", "diagnosis")


_GAPS = """gaps AS (
    SELECT request_id, seq,
           (at_us - lag(at_us) OVER (PARTITION BY request_id ORDER BY seq)) / 1e6::DOUBLE AS gap_s
    FROM frames WHERE has_text)"""


@query(
    "chunk_gaps",
    f"{with_sql('frames')}, {_GAPS} SELECT request_id, seq, round(gap_s, 6) AS gap_s FROM gaps",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    gaps = streams.chunk_gaps(parsed(spark, folder), block_rows=4096)
    return gaps.select("request_id", "seq", F.round("gap_s", 6).alias("gap_s"))


@query(
    "gap_percentiles",
    f"""{with_sql("frames")}, {_GAPS}, sorted AS (
        SELECT request_id, list_sort(list(gap_s)) AS g, count(gap_s)::BIGINT AS n FROM gaps
        WHERE gap_s IS NOT NULL GROUP BY 1)
    SELECT request_id, q, n, round(g[floor(q * (n - 1))::BIGINT + 1], 6) AS quantile
    FROM sorted, (VALUES (0.5::DOUBLE), (0.95)) AS w(q)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    gaps = streams.chunk_gaps(parsed(spark, folder), block_rows=4096)
    found = streams.gap_percentiles(gaps)
    return found.withColumn("quantile", F.round("quantile", 6))


@query(
    "delta_key_census",
    with_sql("frames")
    + """ SELECT CASE WHEN kind = 'content' THEN 'content'
                      WHEN event_type = 'view' THEN 'reasoning' ELSE 'reasoning_content' END
                 AS delta_key, count(*)::BIGINT AS n
          FROM all_frames JOIN (SELECT event_id AS seq, event_type FROM events) USING (seq)
          WHERE kind IN ('content', 'thinking') GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return streams.delta_key_census(frame_rows(spark, folder))


@query(
    "split_thinking",
    """WITH texts AS (
        SELECT conv_id || '-' || turn AS request_id, turn,
               CASE WHEN turn % 5 = 1 THEN
                   list_concat(list_concat(string_split(text, ' ')[1:3],
                       ['</th', 'in', 'k', '>tail']), string_split(text, ' ')[4:])
               ELSE string_split(text, ' ') END AS words
        FROM conversations),
    joined AS (
        SELECT request_id, turn % 5 = 1 AS closes, array_to_string(words, '') AS whole FROM texts)
    SELECT request_id,
           md5(CASE WHEN closes THEN substr(whole, 1, strpos(whole, '</think>') + 7)
               ELSE whole END) AS thinking_md5,
           md5(CASE WHEN closes THEN substr(whole, strpos(whole, '</think>') + 8) ELSE '' END)
               AS content_md5
    FROM joined""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    split = streams.split_thinking(chunk_rows(spark, folder), block_rows=4)

    def joined(part: str) -> F.col:
        ordered = F.array_sort(F.collect_list(F.struct("seq", part)))
        return F.md5(F.array_join(F.transform(ordered, lambda r: r[part]), "")).alias(f"{part}_md5")

    return split.groupBy("request_id").agg(joined("thinking"), joined("content"))


# ----------------------------------------------------------------------- live streams


def _stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    )


# Recorded tables span weeks; a watermark this far behind drops none of their rows.
WHOLE_SPAN = "3650 days"
AFTER_ALL = "INTERVAL 7300 DAYS"


def _dealt(rows: DataFrame, name: str, **closing: Column) -> DataFrame:
    """``rows`` as a stream, dealt to several micro-batches in no order.

    A last file holds one row long after all others, with the values of ``closing``: it moves
    the watermark past them, and stays open itself.
    """
    spark = rows.sparkSession
    target = f"{shared_folder(spark)}/streams/{name}-{uuid.uuid4().hex}"
    files = max(8, spark.sparkContext.defaultParallelism)
    rows.repartition(files).write.parquet(target)
    last = rows.agg((F.max("ts") + F.expr(AFTER_ALL)).alias("ts")).select(
        *[
            F.col(f.name) if f.name == "ts" else closing.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in rows.schema
        ]
    )
    last.write.mode("append").parquet(target)
    return (
        spark.readStream.schema(rows.schema)
        .option("maxFilesPerTrigger", -(-files // 4))
        .parquet(target)
    )


def _drain(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all that is there, into a table of the shared folder."""
    spark = stream.sparkSession
    use_rocksdb(spark)
    target = f"{shared_folder(spark)}/streams/{name}-{uuid.uuid4().hex}"
    running = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{target}-checkpoint")
        .trigger(availableNow=True)
        .start(target)
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


@query("account_live", with_sql("frames", "accounts") + _ACCOUNT_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Every request, whether it was ended by its last frame or by silence."""
    frames = _dealt(frame_rows(spark, folder), "frames", request_id=F.lit("closing"), seq=F.lit(0))
    live = _drain(account_live(frames, delay=WHOLE_SPAN), "accounts")
    return _rounded(live.drop("late_frames"))


_CHANGES = """SELECT job, poll, status, previous,
             CASE WHEN status = 'Failed' THEN 'out of quota ' || poll END AS reason FROM (
            SELECT *, lag(status) OVER (PARTITION BY job ORDER BY poll) AS previous FROM polls)
          WHERE previous IS DISTINCT FROM status"""


def _status_feed(spark: SparkSession, folder: str) -> DataFrame:
    polls = _dealt(poll_rows(spark, folder, timed=True), "polls", job=F.lit("closing"), poll=F.lit(0))
    ever = 100 * 365 * 86_400_000
    feed = status_feed(polls, delay=WHOLE_SPAN, keep_ms=ever, give_up_ms=ever)
    return _drain(feed, "status")


@query("status_feed", f"{with_sql('polls')} {_CHANGES}")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _status_feed(spark, folder)


@query(
    "watch_progress",
    with_sql("polls")
    + """, last AS (
        SELECT job::BIGINT % 3 AS watch, arg_max(status, poll) AS status FROM polls GROUP BY job)
        SELECT watch, count(*)::BIGINT AS jobs,
             (count(*) FILTER (WHERE status IN ('Completed', 'Failed', 'Canceled')))::BIGINT AS terminal,
             bool_and(status IN ('Completed', 'Failed', 'Canceled')) AS all_terminal
          FROM last GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Whether all jobs of a watch list have ended, from the live feed of changes."""
    feed = _status_feed(spark, folder).withColumn("watch", F.col("job").cast("bigint") % 3)
    return watch_progress(feed, "watch")


@query(
    "sighting_feed",
    "SELECT DISTINCT user_id::VARCHAR AS job, event_type AS name, event_id % 3 AS value FROM events",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    values = _stream(spark, folder).select(
        F.col("user_id").cast("string").alias("job"),
        F.lit("metric").alias("channel"),
        F.col("event_type").alias("name"),
        (F.col("event_id") % 3).alias("value"),
    )
    return _drain(sighting_feed(values), "sightings").drop("channel")


@query(
    "stream_levels",
    with_sql("frames", "accounts")
    + """ SELECT CASE WHEN request_id::BIGINT % 2 = 0 THEN 'blue' ELSE 'green' END AS deployment,
             4 AS concurrency, count(*)::BIGINT AS requests,
             (count(*) FILTER (WHERE counted > 0))::BIGINT AS succeeded,
             coalesce(sum(coalesce(usage_tokens, counted)) FILTER (WHERE counted > 0), 0)::BIGINT
                 AS output_tokens,
             round(quantile_cont(ttft_s, 0.5) FILTER (WHERE counted > 0), 3) AS ttft_p50
          FROM accounts GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Frames to level rows: the serving report from recorded streams."""
    from meterloom.operators.serving import level_summary

    keyed = accounts(spark, folder).withColumn(
        "deployment",
        F.when(F.col("request_id").cast("bigint") % 2 == 0, "blue").otherwise("green"),
    ).withColumn("concurrency", F.lit(4))
    results = streams.request_results(keyed).withColumn("start_s", F.lit(0.0))
    return level_summary(results).select(
        "deployment",
        "concurrency",
        "requests",
        "succeeded",
        "output_tokens",
        F.round("ttft_p50", 3).alias("ttft_p50"),
    )
