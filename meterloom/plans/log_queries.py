"""Registered queries: failure causes, tails, job watching, classifications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.operators import logs
from meterloom.plans.inputs import log_rows, poll_rows, table, value_rows, with_sql
from meterloom.plans.registry import query

# Small blocks, so that the given files span several of them.
BLOCK = 1000
LOGS = with_sql("logs")


@query(
    "first_error",
    LOGS + " SELECT DISTINCT file_id, first_no, first_speaker AS speaker FROM started",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    started = logs.first_error(log_rows(spark, folder))
    return started.filter(F.col("line_no") == F.col("first_no")).select(
        "file_id", "first_no", "speaker"
    )


@query("cause_block", LOGS + " SELECT file_id, line_no, line FROM block")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return logs.cause_block(log_rows(spark, folder))


@query(
    "error_excerpt",
    LOGS
    + """, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY line_no) AS rn,
               count(*) OVER (PARTITION BY file_id) AS n FROM block),
    kept AS (
        SELECT file_id, line_no AS place, 0 AS late, line FROM ranked
        WHERE n <= 28 OR rn <= 6 OR rn > n - 22
        UNION ALL SELECT file_id, line_no, 1, '... ' || (n - 28) || ' lines omitted ...'
        FROM ranked WHERE n > 28 AND rn = 6
        UNION ALL SELECT file_id, line_no, 0, line FROM (
            SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY line_no) AS rn
            FROM started WHERE first_speaker = '') WHERE rn <= 28)
    SELECT file_id, string_agg(line || chr(10), '' ORDER BY place, late) AS excerpt
    FROM kept GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return logs.error_excerpt(log_rows(spark, folder))


@query(
    "log_tail",
    LOGS
    + """ SELECT file_id, line_no, line FROM logs
          QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY line_no DESC) <= 40""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return logs.log_tail(log_rows(spark, folder))


@query(
    "status_changes",
    with_sql("polls")
    + """ SELECT job, poll, status, previous,
             CASE WHEN status = 'Failed' THEN 'out of quota ' || poll END AS reason
          FROM (SELECT *, lag(status) OVER (PARTITION BY job ORDER BY poll) AS previous FROM polls)
          WHERE previous IS DISTINCT FROM status""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return logs.status_changes(poll_rows(spark, folder), block_rows=BLOCK)


@query(
    "first_sightings",
    """WITH seen AS (
        SELECT user_id::VARCHAR AS job, event_id AS poll,
               CASE WHEN event_id % 3 = 0 THEN 'tag' ELSE 'metric' END AS channel,
               'name' || (event_id % 5) AS name,
               CASE WHEN event_id % 4 <> 1 THEN (event_id % 13)::VARCHAR END AS value
        FROM events WHERE event_id % 6 <> 0 AND event_id % 11 <> 0)
    SELECT job, channel, name, value, min(poll) AS poll,
           CASE WHEN channel = 'metric' AND value IS NULL THEN '(logged, no value yet)'
                ELSE value END AS shown
    FROM seen GROUP BY ALL""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return logs.first_sightings(value_rows(spark, folder))


_WATCH = """last AS (
    SELECT job::BIGINT % 3 AS watch, arg_max(status, poll) AS status FROM polls GROUP BY job)"""


@query(
    "all_terminal",
    with_sql("polls")
    + f""", {_WATCH} SELECT watch, count(*)::BIGINT AS jobs,
             (count(*) FILTER (WHERE status IN ('Completed', 'Failed', 'Canceled')))::BIGINT AS terminal,
             bool_and(status IN ('Completed', 'Failed', 'Canceled')) AS all_terminal
          FROM last GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    watched = poll_rows(spark, folder).withColumn("watch", F.col("job").cast("bigint") % 3)
    return logs.all_terminal(watched, ["watch"])


@query(
    "last_status",
    with_sql("polls")
    + """ SELECT job, CASE WHEN arg_max(status, poll) = '?' THEN '' ELSE arg_max(status, poll) END
             AS status FROM polls GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return logs.last_status(poll_rows(spark, folder))


@query(
    "log_reads",
    """SELECT event_id AS read_id, CASE event_id % 6 WHEN 0 THEN 'error' WHEN 1 THEN 'withheld'
              WHEN 2 THEN 'gone' WHEN 3 THEN 'error' ELSE 'ok' END AS status,
              CASE event_id % 6 WHEN 0 THEN 'http 500: boom ' || event_id
                   WHEN 1 THEN 'Logs CAN''T be retrieved for ' || event_id
                   WHEN 2 THEN 'There are NO logs for this deployment'
                   WHEN 3 THEN 'bad request: RequestInvalid: not a valid enum value'
                   ELSE '' END AS detail,
              event_id % 6 > 3 AS is_evidence
       FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    event = F.col("event_id")
    body = (
        F.when(event % 6 == 0, F.concat(F.lit("boom "), event))
        .when(event % 6 == 1, F.concat(F.lit("\n Logs CAN'T be retrieved for "), event, F.lit(" ")))
        .when(event % 6 == 2, F.lit("There are NO logs for this deployment"))
        .when(event % 6 == 3, F.lit("RequestInvalid: not a valid enum value"))
        .when(event % 6 == 4, F.lit("served"))
        .otherwise(F.lit(""))
    )
    reads = table(spark, folder, "events").select(
        event.alias("read_id"),
        F.when(event % 6 == 0, 500).otherwise(200).alias("status_code"),
        body.alias("body"),
    )
    return logs.classify_log_reads(reads).drop("status_code", "body")


@query(
    "cluster_errors",
    """SELECT event_id AS error_id, CASE event_id % 3
              WHEN 0 THEN 'ClusterMinNodesExceedCoreQuota' WHEN 1 THEN 'InvalidPropertyValue'
              ELSE 'Unknown' END AS code,
              CASE WHEN event_id % 3 = 0 AND event_id % 2 = 0 THEN 'NC' || event_type END AS family,
              CASE WHEN event_id % 3 = 0 THEN (event_id % 40)::VARCHAR END AS quota,
              CASE WHEN event_id % 3 = 1 THEN 'Standard_' || event_type END AS sku
       FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    event, kind = F.col("event_id"), F.col("event_type")
    message = (
        F.when(
            event % 3 == 0,
            F.concat(
                F.lit("ClusterMinNodesExceedCoreQuota: "),
                F.when(event % 2 == 0, F.concat(F.lit("Standard NC"), kind, F.lit(" family"))).otherwise(
                    F.lit("all families")
                ),
                F.lit(" has a quota of "),
                event % 40,
            ),
        )
        .when(
            event % 3 == 1,
            F.concat(F.lit("InvalidPropertyValue: value Standard_"), kind, F.lit(" for property vmSize")),
        )
        .otherwise(F.concat(F.lit(" odd "), kind))
    )
    errors = table(spark, folder, "events").select(
        event.alias("error_id"), message.alias("message")
    )
    return logs.classify_cluster_errors(errors).drop("message", "detail")
