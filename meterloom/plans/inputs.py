"""The given tables in the shapes the operators read, in Spark and in SQL.

Each ``*_rows`` function has a SQL twin of the same content in ``SQL``; the twins are
written separately so that one can check the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.text import INLINE_SPACE, WORD
from meterloom.operators.corpus import from_documents

# The given documents are in Latin scripts: letters beyond ASCII stand in for the script.
LATIN_EXTENDED = r"\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}"
MIN_RATIO = 0.02
SKUS = (
    "Standard_NC4as_T4_v3",
    "Standard_NV6ads_A10_v5",
    "Standard_NC24ads_A100_v4",
    "Standard_ND96isr_H100_v5",
    "Standard_Unlisted_v1",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(index: Column, values: tuple) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents. Their texts are worth a shuffle when they come in few splits."""
    return table(spark, folder, "documents")


def instruction_rows(spark: SparkSession, folder: str) -> DataFrame:
    return from_documents(documents(spark, folder))


def request_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Recorded requests: an event each, two deployments, five levels, eight prompts.

    Blue fails at its highest level only, green at every one, so that both outcomes of a
    search for the knee occur.
    """
    event = F.col("event_id")
    sound = (F.col("user_id") % 2 == 0) & (F.col("user_id") % 5 <= 3)
    failed = (F.col("event_type") == "error") & ~sound
    # Odd divisors keep percentiles off the rounding ties on which engines disagree.
    first_token = F.col("value") / 17.0 * (1 + F.pow(F.lit(2.0), F.col("user_id") % 5) / 16.0)
    return table(spark, folder, "events").select(
        pick(F.col("user_id") % 2, ("blue", "green")).alias("deployment"),
        F.expr("shiftleft(1, cast(user_id % 5 as int))").alias("concurrency"),
        event.alias("request_no"),
        F.when(failed & (event % 3 == 1), 503).otherwise(200).alias("status"),
        F.when(failed & (event % 3 == 1), F.concat(F.lit("busy "), event % 4, F.lit("\nretry")))
        .otherwise(F.lit(""))
        .alias("body"),
        F.when(failed & (event % 3 == 0), F.lit("ReadTimeout: no reply")).alias("exception"),
        F.when(failed, F.lit(0)).otherwise(event % 130 + 1).cast("bigint").alias("output_tokens"),
        first_token.alias("ttft_s"),
        (first_token + (event % 50) / 49.0).alias("total_s"),
        (event * 0.25).alias("start_s"),
    )


def reply_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Comparison replies: prompt ``event_id``, both deployments, cap of 128 tokens."""
    event = F.col("event_id")
    events = table(spark, folder, "events")
    both = events.withColumn("deployment", F.explode(F.lit(["blue", "green"])))
    tokens = F.least(
        F.when(F.col("deployment") == "blue", event % 170).otherwise((event * 7) % 150),
        F.lit(128),
    )
    return both.select(
        event.alias("prompt_no"),
        "deployment",
        tokens.alias("completion_tokens"),
        F.when(tokens == 128, F.lit("length")).otherwise(F.lit("stop")).alias("finish_reason"),
    )


def frame_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Recorded stream lines: a request per user, a line per event."""
    events = table(spark, folder, "events")
    event, kind = F.col("event_id"), F.col("event_type")

    def delta(field: str) -> Column:
        return F.concat(
            F.lit('data: {"choices":[{"delta":{"' + field + '":"t'),
            event.cast("string"),
            F.lit('"},"finish_reason":'),
            F.when(event % 40 == 0, F.lit('"length"')).otherwise(F.lit("null")),
            F.lit("}]}"),
        )

    usage = F.concat(
        F.lit('data: {"choices":[],"usage":{"prompt_tokens":9,"completion_tokens":'),
        (event % 60).cast("string"),
        F.lit("}}"),
    )
    line = (
        F.when(event % 997 == 996, F.lit("data: [DONE]"))
        .when(kind == "view", delta("reasoning"))
        .when(kind == "signup", delta("reasoning_content"))
        .when((kind == "click") & (F.col("user_id") % 7 != 3), delta("content"))
        .when(kind == "purchase", usage)
        .when(event % 2 == 0, F.lit('data: {"choices": [oops'))
        .otherwise(F.lit(": keep-alive"))
    )
    return events.select(
        F.col("user_id").cast("string").alias("request_id"),
        event.alias("seq"),
        "ts",
        line.alias("line"),
    )


def chunk_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Raw stream chunks: a request per conversation turn, a chunk per word.

    Every fifth request closes its thinking block, with the tag spread over chunks.
    """
    turns = table(spark, folder, "conversations")
    closing = F.lit(["</th", "in", "k", ">tail"])
    words = F.split("text", " ")
    chunks = F.when(
        F.col("turn") % 5 == 1, F.concat(F.slice(words, 1, 3), closing, F.slice(words, F.lit(4), F.greatest(F.size(words) - 3, F.lit(0))))
    ).otherwise(words)
    return turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"),
        F.posexplode(chunks).alias("seq", "text"),
    )


def log_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Log lines: twenty files, a line per event; every fifth file carries no stamps."""
    event, kind = F.col("event_id"), F.col("event_type")
    said = (
        F.when((kind == "error") & (event % 7 == 0), F.concat(F.lit("ValueError: bad key "), event))
        .when(kind == "signup", F.lit("  "))
        .otherwise(F.concat(F.lit("  frame "), event, F.lit("  ")))
    )
    stamp = F.concat(
        F.lit("(Worker pid="),
        F.expr("event_id div 1500") % 4,
        F.lit(") ERROR 01-02 03:04:05 [core.py:17] "),
    )
    file = F.col("user_id") % 20
    return table(spark, folder, "events").select(
        F.concat(F.lit("file-"), file).alias("file_id"),
        event.alias("line_no"),
        F.when(file % 5 == 0, said).otherwise(F.concat(stamp, said)).alias("line"),
    )


def poll_rows(spark: SparkSession, folder: str, timed: bool = False) -> DataFrame:
    """Polled job states: a job per user, a poll per event; with ``timed`` also when it was."""
    events = table(spark, folder, "events")
    kind, event = F.col("event_type"), F.col("event_id")
    status = (
        F.when(kind.isin("view", "click"), F.lit("Running"))
        .when(kind == "purchase", F.lit("Completed"))
        .when(kind == "error", F.lit("Failed"))
        .otherwise(F.lit(""))
    )
    return events.select(
        F.col("user_id").cast("string").alias("job"),
        event.alias("poll"),
        *(["ts"] if timed else []),
        status.alias("status"),
        F.when(kind == "error", F.concat(F.lit(" out of\n\n  quota "), event, F.lit("\t"))).alias(
            "reason"
        ),
    )


def value_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Polled metric values and tags."""
    event = F.col("event_id")
    is_tag = event % 3 == 0
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("job"),
        event.alias("poll"),
        F.when(is_tag, F.lit("tag")).otherwise(F.lit("metric")).alias("channel"),
        F.when(is_tag & (event % 2 == 0), F.concat(F.lit("mlflow."), event % 5))
        .when(event % 11 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("name"), event % 5))
        .alias("name"),
        F.when(event % 4 != 1, (event % 13).cast("string")).alias("value"),
    )


def judgement_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Judge texts over the labelled documents."""
    n = (1 + F.col("doc_id") % 12).cast("string")
    text = pick_text(
        F.col("doc_id") % 7,
        F.concat(F.lit("1 to 10: rambling [[2]] then [[ "), n, F.lit(" ]]")),
        F.concat(F.lit("Score: 3, no, final SCORE "), n, F.lit("/10")),
        F.concat(F.lit("  "), n, F.lit(".5\n")),
        F.concat(F.lit("there are "), n, F.lit(" reasons")),
        F.lit("\t "),
        F.concat(F.lit("최종 점수: "), n),
        F.concat(F.lit("rating："), n, F.lit(" but [[11]]")),
    )
    return table(spark, folder, "labels").select(
        F.col("doc_id").cast("string").alias("key"),
        F.concat(F.lit("quality-"), "quality").alias("category"),
        text.alias("judgement"),
    )


def pick_text(index: Column, *choices: Column) -> Column:
    return F.get(F.array(*choices), index.cast("int"))


def harness_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Task metrics of a base run (even documents) and a tuned run (odd ones)."""
    joined = table(spark, folder, "labels").join(
        documents(spark, folder).select("doc_id", "lang", "source"), "doc_id"
    )
    share = F.round(F.avg("quality"), 6)
    name = (
        F.when(F.col("lang") == "en", F.lit("acc_norm,none"))
        .when(F.col("lang") == "fr", F.lit("exact_match,none"))
        .otherwise(F.lit("f1,none"))
    )
    return (
        joined.groupBy(
            pick(F.col("doc_id") % 2, ("base", "tuned")).alias("run"), "lang", "source"
        )
        .agg(share.alias("share"), F.count(F.lit(1)).alias("n"))
        .select(
            "run",
            F.concat_ws("/", "lang", "source").alias("task"),
            "n",
            F.map_from_arrays(
                F.array(F.lit("a_stderr,none"), name, F.lit("alias")),
                F.array(F.lit(0.5), F.col("share"), F.lit(0.25)),
            ).alias("metrics"),
        )
    )


def body_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Chat-completion bodies out of the assistant turns."""
    kind = (F.col("conv_id") + F.col("turn")) % 8
    content = (
        F.when(kind == 1, F.concat(F.lit("<think>so</think>"), "text"))
        .when(kind.isin(2, 3), F.lit("  "))
        .otherwise(F.col("text"))
    )
    message = F.struct(
        content.alias("content"),
        F.when(kind == 4, F.lit("new")).alias("reasoning"),
        F.when(kind.isin(4, 5), F.lit("older")).alias("reasoning_content"),
    )
    choice = F.struct(
        message.alias("message"),
        F.when(kind == 2, F.lit("length")).otherwise(F.lit("stop")).alias("finish_reason"),
    )
    usage = F.when(
        F.col("turn") != 3,
        F.struct(
            F.lit(11).alias("prompt_tokens"),
            (F.col("turn") * 10).alias("completion_tokens"),
            (F.col("turn") * 10 + 11).alias("total_tokens"),
        ),
    )
    body = (
        F.when(kind == 6, F.lit("<html>502</html>"))
        .when(kind == 7, F.lit('{"error":{"message":"not found"}}'))
        .otherwise(F.to_json(F.struct(F.array(choice).alias("choices"), usage.alias("usage"))))
    )
    return (
        table(spark, folder, "conversations")
        .filter(F.col("role") == "assistant")
        .select(F.concat_ws("-", "conv_id", "turn").alias("run_id"), body.alias("body"))
    )


# ---------------------------------------------------------------------------- costs


def disk_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Disks out of parts; some do not report their size."""
    key = F.col("p_partkey")
    size = F.when(key % 19 == 0, F.lit(None)).when(key % 17 == 0, 4096).otherwise(F.col("p_size") * 20)
    return table(spark, folder, "part").select(
        (key % 5).alias("subscription"),
        F.concat(F.lit("disk-"), key).alias("name"),
        F.when(key % 4 == 0, F.lit("vm")).alias("managedBy"),
        F.struct(
            F.when(key % 3 == 0, F.lit("Attached")).otherwise(F.lit("UnAttached")).alias("diskState"),
            size.alias("diskSizeGB"),
        ).alias("properties"),
        F.struct(
            F.when(key % 6 == 1, F.lit("Standard_LRS")).otherwise(F.lit("Premium_LRS")).alias("name")
        ).alias("sku"),
    )


def nic_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Network interfaces out of customers; a third lost their machine."""
    key = F.col("c_custkey")
    machine = F.when(key % 3 != 0, F.struct(F.concat(F.lit("/vm/"), key).alias("id")))
    return table(spark, folder, "customer").select(
        (key % 5).alias("subscription"),
        F.concat(F.lit("Nic-"), key).alias("name"),
        F.struct(machine.alias("virtualMachine")).alias("properties"),
    )


def ip_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Public addresses out of orders: loose, attached, or pointing at nothing."""
    key, owner = F.col("o_orderkey"), F.col("o_custkey")
    target = F.when(key % 11 == 0, owner + 10_000_000).otherwise(owner)
    config = F.when(
        key % 4 != 0,
        F.struct(
            F.concat(F.lit("/sub/x/networkInterfaces/NIC-"), target, F.lit("/ipConfigurations/c")).alias("id")
        ),
    )
    return table(spark, folder, "orders").select(
        (owner % 5).alias("subscription"),
        F.concat(F.lit("ip-"), key).alias("name"),
        F.struct(config.alias("ipConfiguration")).alias("properties"),
        F.struct(pick(key % 4, ("Standard", "Basic", "Global", "Odd")).alias("name")).alias("sku"),
    )


def scan_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Listing outcomes: one failed interface listing, one failed orphan scan."""
    nations = table(spark, folder, "nation")
    account = F.col("n_nationkey").cast("bigint")
    sections = F.lit(["network interfaces", "orphaned disks/IPs (resource group)", "jobs"])
    return nations.select(
        account.alias("subscription"), F.explode(sections).alias("section")
    ).select(
        "subscription",
        "section",
        F.when(F.col("section") == "network interfaces", F.col("subscription") != 3)
        .when(F.col("section") == "jobs", F.lit(True))
        .otherwise(~F.col("subscription").isin(4, 6))
        .alias("ok"),
        F.lit("").alias("detail"),
    )


def cluster_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Compute clusters out of suppliers and customers."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        (key % 5).alias("subscription"),
        F.concat(F.lit("cluster-"), key).alias("name"),
        F.when(key % 10 == 9, F.lit("aks")).otherwise(F.lit("amlcompute")).alias("type"),
        F.when(key % 4 != 3, (key % 4).cast("int")).alias("min_instances"),
        pick(key % 5, SKUS).alias("size"),
        F.when(key % 2 == 0, F.lit("LowPriority")).alias("tier"),
    )


def job_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Jobs out of orders; some records could not be read."""
    key = F.col("o_orderkey")
    states = ("Running", "Queued", "Completed", "Failed", "Starting")
    return table(spark, folder, "orders").select(
        (key % 5).alias("subscription"),
        F.when(~((key % 5 == 2) & (key % 101 == 7)), F.concat(F.lit("job-"), key)).alias("name"),
        pick(F.expr("o_orderkey div 5") % 5, states).alias("status"),
    )


def endpoint_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Endpoints out of orders; some go by a name that no deployment knows."""
    key = F.col("o_orderkey")
    name = F.when(key % 23 == 0, F.concat(F.lit("gone-"), key)).otherwise(key.cast("string"))
    return table(spark, folder, "orders").select(
        (key % 5).alias("subscription"), name.alias("endpoint")
    )


def deployment_rows(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("l_orderkey")
    return table(spark, folder, "lineitem").select(
        (key % 5).alias("subscription"),
        key.cast("string").alias("endpoint"),
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey").alias("deployment"),
        pick(F.col("l_partkey") % 5, SKUS).alias("instance_type"),
        F.when(F.col("l_suppkey") % 9 != 0, (F.col("l_quantity") % 4).cast("bigint")).alias(
            "instance_count"
        ),
    )


def endpoint_scan_rows(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        (key % 5).alias("subscription"),
        F.concat(F.lit("deployments of "), key).alias("section"),
        (key % 6 != 0).alias("ok"),
    )


# ------------------------------------------------------------------------ SQL twins


def sql_replace(text: str, pattern: str, by: str = "''") -> str:
    return f"regexp_replace({text}, '{pattern}', {by}, 'g')"


def sql_layout(text: str) -> str:
    text = sql_replace(text, r"\r\n?", "chr(10)")
    text = sql_replace(text, f"[{INLINE_SPACE}]+", "' '")
    text = sql_replace(text, r"\n{3,}", "chr(10) || chr(10)")
    text = sql_replace(text, r"(?m)^ +| +$")
    return sql_replace(text, r"\A\n+|\n+\z")


def sql_normalize(text: str) -> str:
    return sql_layout(f"nfc_normalize(coalesce({text}, ''))")


def sql_canonical(text: str) -> str:
    return sql_replace(f"lower(nfc_normalize(coalesce({text}, '')))", f"[^{WORD}]+")


_BREAK = "strpos(text, chr(10))"
_SKU_SQL = "[" + ", ".join(f"'{s}'" for s in SKUS) + "]"

SQL = {
    "rows_": f"""rows_ AS (
        SELECT doc_id AS row_id, source, '' AS input,
               CASE WHEN {_BREAK} > 0 THEN substr(text, 1, {_BREAK} - 1) ELSE text END
                   AS instruction,
               CASE WHEN {_BREAK} > 0 THEN substr(text, {_BREAK} + 1) ELSE '' END AS output
        FROM documents)""",
    "requests": """requests AS (
        SELECT CASE WHEN user_id % 2 = 0 THEN 'blue' ELSE 'green' END AS deployment,
               (1 << (user_id % 5)::INTEGER)::INTEGER AS concurrency,
               event_id AS request_no,
               NOT failed AS ok,
               CASE WHEN NOT failed THEN 200
                    WHEN event_id % 3 = 1 THEN 503 ELSE 0 END AS status,
               CASE WHEN NOT failed THEN ''
                    WHEN event_id % 3 = 0 THEN 'ReadTimeout: no reply'
                    WHEN event_id % 3 = 1 THEN 'busy ' || (event_id % 4) || chr(10) || 'retry'
                    ELSE 'no tokens streamed' END AS error,
               CASE WHEN failed THEN 0 ELSE event_id % 130 + 1 END
                   AS output_tokens,
               value / 17.0::DOUBLE * (1 + (1 << (user_id % 5)::INTEGER) / 16.0::DOUBLE)
                   AS ttft_s,
               value / 17.0::DOUBLE * (1 + (1 << (user_id % 5)::INTEGER) / 16.0::DOUBLE)
                   + (event_id % 50) / 49.0::DOUBLE AS total_s,
               event_id * 0.25::DOUBLE AS start_s
        FROM (SELECT *, event_type = 'error' AND NOT (user_id % 2 = 0 AND user_id % 5 <= 3) AS failed
              FROM events))""",
    "levels": """measured AS (
        SELECT *, CASE WHEN output_tokens > 1
                       THEN (total_s - ttft_s) / (output_tokens - 1) ELSE 0 END AS tpot_s
        FROM requests),
    grouped AS (
        SELECT deployment, concurrency,
               count(*)::BIGINT AS requests,
               (count(*) FILTER (WHERE ok))::BIGINT AS succeeded,
               (count(*) FILTER (WHERE NOT ok))::BIGINT AS failed,
               max(start_s + total_s) - min(start_s) AS wall,
               quantile_cont(ttft_s, [0.5, 0.95, 0.99]) FILTER (WHERE ok) AS ttft,
               quantile_cont(tpot_s, [0.5, 0.95]) FILTER (WHERE ok AND output_tokens > 1)
                   AS tpot,
               quantile_cont(total_s, [0.5, 0.95, 0.99]) FILTER (WHERE ok) AS e2e,
               coalesce(sum(output_tokens) FILTER (WHERE ok), 0)::BIGINT AS output_tokens
        FROM measured GROUP BY ALL),
    levels AS (
        SELECT deployment, concurrency, requests, succeeded, failed,
               round(wall, 3) AS wall_s,
               coalesce(round(ttft[1], 4), 0) AS ttft_p50,
               coalesce(round(ttft[2], 4), 0) AS ttft_p95,
               coalesce(round(ttft[3], 4), 0) AS ttft_p99,
               coalesce(round(tpot[1], 4), 0) AS tpot_p50,
               coalesce(round(tpot[2], 4), 0) AS tpot_p95,
               coalesce(round(e2e[1], 4), 0) AS e2e_p50,
               coalesce(round(e2e[2], 4), 0) AS e2e_p95,
               coalesce(round(e2e[3], 4), 0) AS e2e_p99,
               output_tokens,
               CASE WHEN wall > 0 THEN round(output_tokens / wall, 2) ELSE 0 END
                   AS output_tok_per_s,
               CASE WHEN wall > 0 THEN round(succeeded / wall, 3) ELSE 0 END
                   AS requests_per_s,
               requests >= concurrency AS label_holds
        FROM grouped)""",
    "replies": """replies AS (
        SELECT event_id AS prompt_no, deployment,
               least(CASE WHEN deployment = 'blue' THEN event_id % 170
                          ELSE (event_id * 7) % 150 END, 128) AS completion_tokens,
               CASE WHEN least(CASE WHEN deployment = 'blue' THEN event_id % 170
                          ELSE (event_id * 7) % 150 END, 128) = 128
                    THEN 'length' ELSE 'stop' END AS finish_reason
        FROM events, (VALUES ('blue'), ('green')) AS d(deployment))""",
    "frames": """all_frames AS (
        SELECT user_id::VARCHAR AS request_id, event_id AS seq, epoch_us(ts) AS at_us,
               event_id % 997 = 996 AS is_done,
               CASE WHEN event_id % 997 = 996 THEN ''
                    WHEN event_type IN ('view', 'signup') THEN 'thinking'
                    WHEN event_type = 'click' AND user_id % 7 <> 3 THEN 'content'
                    WHEN event_type = 'purchase' THEN 'usage' ELSE '' END AS kind
        FROM events),
    frames AS (
        SELECT f.*, kind IN ('thinking', 'content') AS has_text,
               CASE WHEN kind = 'usage' THEN seq % 60 END AS usage_tokens,
               CASE WHEN kind IN ('thinking', 'content') AND seq % 40 = 0 THEN 'length' END
                   AS finish_reason
        FROM all_frames f
        LEFT JOIN (SELECT request_id, min(seq) AS done_seq FROM all_frames
                   WHERE is_done GROUP BY 1) d USING (request_id)
        WHERE done_seq IS NULL OR seq <= done_seq)""",
    "accounts": """accounts AS (
        SELECT request_id,
               (count(*) FILTER (WHERE has_text))::BIGINT AS counted,
               (count(*) FILTER (WHERE kind = 'content'))::BIGINT AS content_chunks,
               (count(*) FILTER (WHERE kind = 'thinking'))::BIGINT AS thinking_chunks,
               arg_max(usage_tokens, seq) FILTER (WHERE usage_tokens > 0) AS usage_tokens,
               arg_max(finish_reason, seq) FILTER (WHERE finish_reason IS NOT NULL)
                   AS finish_reason,
               bool_or(is_done) AS done,
               (arg_min(at_us, seq) FILTER (WHERE has_text) - min(at_us)) / 1e6::DOUBLE
                   AS ttft_s,
               (max(at_us) - min(at_us)) / 1e6::DOUBLE AS e2e_s
        FROM frames GROUP BY 1)""",
    "logs": """lines AS (
        SELECT 'file-' || (user_id % 20) AS file_id, event_id AS line_no,
               CASE WHEN user_id % 20 % 5 = 0 THEN ''
                    ELSE '(Worker pid=' || (event_id // 1500 % 4) || ')' END AS speaker,
               CASE WHEN event_type = 'error' AND event_id % 7 = 0
                        THEN 'ValueError: bad key ' || event_id
                    WHEN event_type = 'signup' THEN '  '
                    ELSE '  frame ' || event_id || '  ' END AS said
        FROM events),
    logs AS (
        SELECT file_id, line_no, speaker, said,
               CASE WHEN speaker = '' THEN said
                    ELSE speaker || ' ERROR 01-02 03:04:05 [core.py:17] ' || said END AS line
        FROM lines),
    started AS (
        SELECT l.*, first_no, first_speaker FROM logs l
        JOIN (SELECT file_id, min(line_no) AS first_no, arg_min(speaker, line_no)
                     AS first_speaker
              FROM logs WHERE speaker <> '' OR contains(said, 'ValueError')
              GROUP BY 1) USING (file_id)
        WHERE line_no >= first_no),
    block AS (
        SELECT s.file_id, s.line_no, rtrim(s.said) AS line FROM started s
        LEFT JOIN (SELECT file_id, min(line_no) AS stop FROM started
                   WHERE speaker <> first_speaker GROUP BY 1) USING (file_id)
        WHERE first_speaker <> '' AND (stop IS NULL OR line_no < stop)
          AND rtrim(s.said) <> '')""",
    "polls": """polls AS (
        SELECT user_id::VARCHAR AS job, event_id AS poll,
               CASE WHEN event_type IN ('view', 'click') THEN 'Running'
                    WHEN event_type = 'purchase' THEN 'Completed'
                    WHEN event_type = 'error' THEN 'Failed' ELSE '?' END AS status
        FROM events)""",
    "judgements": """judgements AS (
        SELECT doc_id::VARCHAR AS key, 'quality-' || quality AS category,
               1 + doc_id % 12 AS n, doc_id % 7 AS kind,
               CASE doc_id % 7
                    WHEN 0 THEN '1 to 10: rambling [[2]] then [[ ' || (1 + doc_id % 12) || ' ]]'
                    WHEN 1 THEN 'Score: 3, no, final SCORE ' || (1 + doc_id % 12) || '/10'
                    WHEN 2 THEN '  ' || (1 + doc_id % 12) || '.5' || chr(10)
                    WHEN 3 THEN 'there are ' || (1 + doc_id % 12) || ' reasons'
                    WHEN 4 THEN chr(9) || ' '
                    WHEN 5 THEN '최종 점수: ' || (1 + doc_id % 12)
                    ELSE 'rating：' || (1 + doc_id % 12) || ' but [[11]]' END AS judgement
        FROM labels),
    stated AS (
        SELECT *, CASE kind WHEN 0 THEN n WHEN 1 THEN n WHEN 2 THEN n + 0.5 WHEN 5 THEN n
                       WHEN 6 THEN 11 END::DOUBLE AS value
        FROM judgements),
    scored AS (
        SELECT key, category, judgement,
               CASE WHEN value BETWEEN 1 AND 10 THEN value END AS score,
               CASE WHEN kind = 4 THEN 'empty judge response'
                    WHEN value IS NULL THEN 'no score found in judge response: '''
                         || judgement[:120] || ''''
                    WHEN value NOT BETWEEN 1 AND 10 THEN 'score ' || value
                         || ' outside 1..10 in judge response: ''' || judgement[:120] || ''''
                    ELSE '' END AS error
        FROM stated)""",
    "harness": """harness AS (
        SELECT CASE WHEN doc_id % 2 = 0 THEN 'base' ELSE 'tuned' END AS run,
               lang || '/' || source AS task, count(*)::BIGINT AS n,
               round(avg(quality), 6) AS share
        FROM labels JOIN documents USING (doc_id) GROUP BY 1, 2, lang, source),
    compared AS (
        SELECT task, b.score AS base, t.score AS tuned, round(t.score - b.score, 4) AS delta,
               CASE WHEN b.score <> 0
                    THEN round(round(t.score - b.score, 4) / b.score * 100, 2) END AS delta_pct
        FROM (SELECT task, round(share, 4) AS score FROM harness WHERE run = 'base') b
        FULL JOIN (SELECT task, round(share, 4) AS score FROM harness WHERE run = 'tuned') t
        USING (task))""",
    "bodies": """bodies AS (
        SELECT conv_id || '-' || turn AS run_id, turn, (conv_id + turn) % 8 AS kind,
               CASE WHEN (conv_id + turn) % 8 = 1 THEN '<think>so</think>' || text
                    WHEN (conv_id + turn) % 8 IN (2, 3) THEN '  '
                    WHEN (conv_id + turn) % 8 IN (6, 7) THEN ''
                    ELSE text END AS content,
               CASE WHEN turn <> 3 AND (conv_id + turn) % 8 < 6 THEN turn * 10 END
                   AS completion_tokens
        FROM conversations WHERE role = 'assistant')""",
    "disks": """disks AS (
        SELECT p_partkey % 5 AS subscription, 'disk-' || p_partkey AS name,
               p_partkey % 4 = 0 AS claimed, p_partkey % 3 <> 0 AS loose,
               CASE WHEN p_partkey % 19 = 0 THEN NULL WHEN p_partkey % 17 = 0 THEN 4096
                    ELSE p_size * 20 END AS gb,
               CASE WHEN p_partkey % 6 = 1 THEN 'Standard_LRS' ELSE 'Premium_LRS' END AS sku
        FROM part),
    tiers(tier_gb, usd) AS (VALUES (4, 0.81::DOUBLE), (8, 1.62), (16, 3.24), (32, 5.2795),
        (64, 10.207), (128, 19.71), (256, 38.012142), (512, 73.22), (1024, 135.17)),
    priced_disks AS (
        SELECT d.*, CASE WHEN starts_with(lower(sku), 'premium') THEN usd END AS monthly_usd
        FROM disks d LEFT JOIN (SELECT gb, arg_min(usd, tier_gb) AS usd
             FROM (SELECT DISTINCT gb FROM disks) JOIN tiers ON gb <= tier_gb GROUP BY gb)
        USING (gb))""",
    "ips": """nics AS (
        SELECT c_custkey % 5 AS subscription, 'nic-' || c_custkey AS nic,
               c_custkey % 3 <> 0 AS live FROM customer),
    ips AS (
        SELECT o_custkey % 5 AS subscription, 'ip-' || o_orderkey AS name,
               CASE WHEN o_orderkey % 4 <> 0 THEN 'nic-' ||
                    (CASE WHEN o_orderkey % 11 = 0 THEN o_custkey + 10000000
                          ELSE o_custkey END) END AS nic,
               ['Standard', 'Basic', 'Global', 'Odd'][o_orderkey % 4 + 1] AS sku,
               ([0.005, 0.0036, 0.01, NULL]::DOUBLE[])[o_orderkey % 4 + 1] * 730 AS monthly_usd
        FROM orders),
    orphan_ips AS (
        SELECT * FROM ips i WHERE nic IS NULL OR (subscription <> 3 AND NOT EXISTS (
            SELECT 1 FROM nics n WHERE live AND n.nic = i.nic
            AND n.subscription = i.subscription)))""",
    "scans": """scans AS (
        SELECT n_nationkey::BIGINT AS subscription, section,
               CASE section WHEN 'network interfaces' THEN n_nationkey <> 3
                            WHEN 'jobs' THEN true ELSE n_nationkey NOT IN (4, 6) END AS ok
        FROM nation, (VALUES ('network interfaces'),
             ('orphaned disks/IPs (resource group)'), ('jobs')) s(section))""",
    "rates": """rates(sku, hourly) AS (VALUES ('Standard_NC4as_T4_v3', 0.647::DOUBLE),
        ('Standard_NV6ads_A10_v5', 0.613), ('Standard_NC24ads_A100_v4', 4.959),
        ('Standard_ND96isr_H100_v5', 132.732))""",
    "clusters": f"""clusters AS (
        SELECT c_custkey % 5 AS subscription, 'cluster-' || c_custkey AS name,
               CASE WHEN c_custkey % 4 <> 3 THEN c_custkey % 4 END AS min_instances,
               {_SKU_SQL}[c_custkey % 5 + 1] AS sku,
               CASE WHEN c_custkey % 2 = 0 THEN 'lowpriority' ELSE 'dedicated' END AS tier
        FROM customer WHERE c_custkey % 10 <> 9)""",
    "jobs": """jobs AS (
        SELECT o_orderkey % 5 AS subscription,
               CASE WHEN NOT (o_orderkey % 5 = 2 AND o_orderkey % 101 = 7)
                    THEN 'job-' || o_orderkey END AS name,
               ['Running', 'Queued', 'Completed', 'Failed', 'Starting'][
                   o_orderkey // 5 % 5 + 1] AS status
        FROM orders)""",
    "endpoints": f"""deployments AS (
        SELECT l_orderkey % 5 AS subscription, l_orderkey::VARCHAR AS endpoint,
               l_linenumber || '-' || l_partkey || '-' || l_suppkey AS deployment,
               {_SKU_SQL}[l_partkey % 5 + 1] AS sku,
               CASE WHEN l_suppkey % 9 <> 0 THEN (l_quantity % 4)::BIGINT END AS instances
        FROM lineitem),
    endpoint_items AS (
        SELECT d.subscription, 'online-deployment' AS kind,
               endpoint || '/' || deployment AS name, sku,
               coalesce(instances, 0) AS instances, true AS bills_when_idle,
               instances IS NULL AS cost_unknown
        FROM deployments d
        UNION ALL
        SELECT o_orderkey % 5, 'online-endpoint',
               CASE WHEN o_orderkey % 23 = 0 THEN 'gone-' ELSE '' END || o_orderkey, '', 0, false,
               o_orderkey % 6 = 0 OR o_orderkey % 23 = 0
        FROM orders WHERE o_orderkey % 23 = 0
           OR o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))""",
}


def with_sql(*names: str) -> str:
    """A WITH clause of the named twins."""
    return "WITH " + ",\n    ".join(SQL[name] for name in names)
