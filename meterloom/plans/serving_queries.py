"""Registered queries: load tests, replies and flat reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions import replies as R
from meterloom.operators import reports, serving
from meterloom.operators.costs import hourly_rate
from meterloom.operators.quantiles import exact_quantiles
from meterloom.plans.inputs import (
    body_rows,
    log_rows,
    reply_rows,
    request_rows,
    table,
    with_sql,
)
from meterloom.plans.registry import query
from meterloom.session import stage

SLO_S = 12.0
GPU_SKU = "Standard_NC24ads_A100_v4"
DEPLOYMENTS = ("blue", "green")
LEVELS = with_sql("requests", "levels")
_METRICS = [m for m in serving.LEVEL_METRICS]


def requests(spark: SparkSession, folder: str) -> DataFrame:
    return serving.classify_requests(request_rows(spark, folder))


def levels(spark: SparkSession, folder: str) -> DataFrame:
    return serving.level_summary(requests(spark, folder))


@query(
    "request_outcomes",
    with_sql("requests", "levels")
    + """ SELECT request_no, ok, status::BIGINT AS status, error, round(tpot_s, 6) AS tpot_s
          FROM measured""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return requests(spark, folder).select(
        "request_no",
        "ok",
        F.col("status").cast("bigint").alias("status"),
        "error",
        F.round("tpot_s", 6).alias("tpot_s"),
    )


@query("assign_prompts", "SELECT event_id AS request_no, event_id % 8 AS prompt_no FROM events")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return serving.assign_prompts(request_rows(spark, folder), 8).select(
        "request_no", "prompt_no"
    )


@query("level_summary", LEVELS + " SELECT * FROM levels")
def level_summary(spark: SparkSession, folder: str) -> DataFrame:
    return levels(spark, folder)


@query(
    "error_histogram",
    with_sql("requests")
    + """ SELECT deployment, concurrency, split_part(error, chr(10), 1) AS error,
             count(*)::BIGINT AS n FROM requests WHERE NOT ok GROUP BY ALL""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return serving.error_histogram(requests(spark, folder))


# One percentile query over groups too large for the builtin: the limit is lowered so that
# the given tables take the bucketed way.
@query(
    "exact_percentiles",
    """SELECT event_type, q, n, round(quantile, 6) AS quantile FROM (
           SELECT event_type, count(*)::BIGINT AS n,
                  unnest([0.0, 0.5, 0.95, 0.99, 1.0]::DOUBLE[]) AS q,
                  unnest(quantile_cont(value, [0.0, 0.5, 0.95, 0.99, 1.0])) AS quantile
           FROM events GROUP BY 1)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_quantiles(
        table(spark, folder, "events"),
        ["event_type"],
        "value",
        (0.0, 0.5, 0.95, 0.99, 1.0),
    )
    return found.withColumn("quantile", F.round("quantile", 6))


_PASSES = "FILTER (WHERE succeeded > 0 AND failed = 0 AND ttft_p95 <= 12.0)"
_KNEE = f"""knees AS (
    SELECT deployment, max(concurrency) {_PASSES} AS knee_concurrency,
           arg_max(output_tok_per_s, concurrency) {_PASSES} AS knee_tok_per_s,
           arg_max(requests_per_s, concurrency) {_PASSES} AS knee_requests_per_s
    FROM levels GROUP BY 1)"""


def knees(spark: SparkSession, folder: str) -> DataFrame:
    return serving.find_knee(levels(spark, folder), SLO_S)


@query("find_knee", LEVELS + ", " + _KNEE + " SELECT * FROM knees")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return knees(spark, folder)


@query(
    "sweep_totals",
    LEVELS
    + """ SELECT deployment, max(output_tok_per_s) AS peak_output_tok_per_s,
             sum(failed)::BIGINT AS failed_total, count(*)::BIGINT AS n_levels
          FROM levels GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return serving.sweep_totals(levels(spark, folder))


@query(
    "tokens_per_request",
    LEVELS
    + """ SELECT deployment, concurrency,
             round(output_tokens / greatest(succeeded, 1), 4) AS tokens_per_request FROM levels""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return serving.tokens_per_request(levels(spark, folder)).select(
        "deployment", "concurrency", F.round("tokens_per_request", 4).alias("tokens_per_request")
    )


def _chart_sql() -> str:
    cells = []
    for name in DEPLOYMENTS:
        for shown, value in (
            ("ttft_p50", "ttft_p50"),
            ("ttft_p95", "ttft_p95"),
            ("tpot_p50", "tpot_p50"),
            ("output_tok_per_s", "output_tok_per_s"),
            ("requests_per_s_x100", "round(requests_per_s * 100, 4)"),
            ("tokens_per_request", "round(output_tokens / greatest(succeeded, 1), 4)"),
        ):
            cells.append(f"max(CASE WHEN deployment = '{name}' THEN {value} END) AS {name}_{shown}")
    return (
        f"{LEVELS} SELECT concurrency, {', '.join(cells)}, 12.0::DOUBLE AS ttft_slo_s, "
        "128::BIGINT AS max_tokens FROM levels GROUP BY 1"
    )


@query("chart_feed", _chart_sql())
def _(spark: SparkSession, folder: str) -> DataFrame:
    feed = serving.chart_feed(levels(spark, folder), DEPLOYMENTS, SLO_S, 128)
    for name in DEPLOYMENTS:
        for shown in ("requests_per_s_x100", "tokens_per_request"):
            feed = feed.withColumn(f"{name}_{shown}", F.round(f"{name}_{shown}", 4))
    return feed


@query(
    "deployment_totals",
    with_sql("replies")
    + """ SELECT deployment, count(*)::BIGINT AS replies,
             sum(completion_tokens)::BIGINT AS total_tokens,
             round(avg(completion_tokens), 4) AS mean_tokens,
             (count(*) FILTER (WHERE finish_reason = 'length'))::BIGINT AS cut,
             bool_or(finish_reason = 'length') AS any_cut FROM replies GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    totals = serving.deployment_totals(reply_rows(spark, folder))
    return totals.withColumn("mean_tokens", F.round("mean_tokens", 4))


@query(
    "capped_share",
    with_sql("replies")
    + """ SELECT (count(*) FILTER (WHERE finish_reason = 'length'))::BIGINT AS capped,
             count(*)::BIGINT AS replies,
             round(count(*) FILTER (WHERE finish_reason = 'length') / count(*), 6) AS capped_share
          FROM replies""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    share = serving.capped_share(reply_rows(spark, folder))
    return share.withColumn("capped_share", F.round("capped_share", 6))


_PAIRS = """pairs AS (
    SELECT prompt_no,
           max(completion_tokens) FILTER (WHERE deployment = 'blue') AS left_tokens,
           max(finish_reason) FILTER (WHERE deployment = 'blue') AS left_finish,
           max(completion_tokens) FILTER (WHERE deployment = 'green') AS right_tokens,
           max(finish_reason) FILTER (WHERE deployment = 'green') AS right_finish
    FROM replies GROUP BY 1)"""


@query(
    "side_by_side",
    with_sql("replies") + f", {_PAIRS} SELECT *, left_tokens - right_tokens AS token_diff FROM pairs",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return serving.side_by_side(reply_rows(spark, folder), *DEPLOYMENTS)


@query(
    "weighted_gap",
    with_sql("replies")
    + f""", {_PAIRS}, sent AS (
        SELECT user_id AS prompt_no, count(*)::BIGINT AS weight FROM events GROUP BY 1)
    SELECT prompt_no, weight, (left_tokens - right_tokens) AS token_diff,
           weight * (left_tokens - right_tokens) AS weighted_diff
    FROM pairs JOIN sent USING (prompt_no)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    pairs = serving.side_by_side(reply_rows(spark, folder), *DEPLOYMENTS)
    sent = table(spark, folder, "events").select(F.col("user_id").alias("prompt_no"))
    return serving.weighted_gap(pairs, sent).select(
        "prompt_no", "weight", "token_diff", "weighted_diff"
    )


@query(
    "usd_per_million_tokens",
    LEVELS
    + """ SELECT deployment, concurrency,
             CASE WHEN output_tok_per_s > 0
                  THEN round(4.959::DOUBLE / (output_tok_per_s * 3600) * 1e6, 4) END AS usd
          FROM levels""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    usd = serving.usd_per_million_tokens(
        F.col("output_tok_per_s"), hourly_rate(F.lit(GPU_SKU))
    )
    return levels(spark, folder).select(
        "deployment", "concurrency", F.round(usd, 4).alias("usd")
    )


@query(
    "level_metrics",
    LEVELS
    + f""" SELECT deployment, 'bench.c' || concurrency || '.' || field AS name, metric
          FROM (SELECT deployment, concurrency, unnest({_METRICS}) AS field,
                unnest([{", ".join(m + "::DOUBLE" for m in _METRICS)}]) AS metric FROM levels)
          WHERE metric IS NOT NULL""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return reports.level_metrics(levels(spark, folder))


def shown_errors(errors: Column) -> Column:
    """Error counts in the order of their names."""
    named = F.transform(
        F.array_sort(F.map_entries(errors)), lambda e: F.concat_ws("=", e["key"], e["value"])
    )
    return F.array_join(named, ";")


def sweeps(spark: SparkSession, folder: str) -> DataFrame:
    """Finished sweep documents, with what each sweep was asked to do."""
    asked = requests(spark, folder)
    found = stage(serving.level_summary(asked), "levels")
    settings = found.select("deployment").distinct().select(
        "deployment",
        F.concat(F.lit("model-"), "deployment").alias("model"),
        F.when(F.col("deployment") == "green", F.lit("http://green")).otherwise("").alias("base_url"),
        F.lit(128).alias("max_tokens"),
        F.create_map(F.lit("enable_thinking"), F.col("deployment") == "blue").alias("chat_template_kwargs"),
        F.lit(SLO_S).alias("ttft_slo_s"),
    )
    return reports.sweep_reports(
        found,
        serving.error_histogram(asked),
        serving.find_knee(found, SLO_S).select("deployment", "knee_concurrency"),
        serving.sweep_totals(found).select("deployment", "peak_output_tok_per_s"),
        settings,
    )


@query(
    "flatten_sweeps",
    LEVELS
    + f""", {_KNEE},
    errors AS (
        SELECT deployment, concurrency, string_agg(error || '=' || n, ';' ORDER BY error) AS kinds
        FROM (SELECT deployment, concurrency, split_part(error, chr(10), 1) AS error, count(*) AS n
              FROM requests WHERE NOT ok GROUP BY ALL) GROUP BY ALL),
    flat AS (
        SELECT deployment, 'bench.c' || concurrency || '.' || field AS name, metric,
               NULL AS tag
        FROM (SELECT deployment, concurrency, unnest({_METRICS}) AS field,
              unnest([{", ".join(m + "::DOUBLE" for m in _METRICS)}]) AS metric FROM levels)
        UNION ALL SELECT deployment, 'bench.c' || concurrency || '.errors', NULL,
               kinds FROM errors
        UNION ALL SELECT deployment, 'bench.model', NULL, 'model-' || deployment FROM knees
        UNION ALL SELECT 'green', 'bench.base_url', NULL, 'http://green'
        UNION ALL SELECT deployment, 'bench.max_tokens', 128, NULL FROM knees
        UNION ALL SELECT deployment, 'bench.ttft_slo_s', 12, NULL FROM knees
        UNION ALL SELECT deployment, 'bench.peak_output_tok_per_s', max(output_tok_per_s), NULL
               FROM levels GROUP BY 1
        UNION ALL SELECT deployment, 'bench.levels', count(*), NULL FROM levels GROUP BY 1
        UNION ALL SELECT deployment, 'bench.failed_total', sum(failed), NULL FROM levels GROUP BY 1
        UNION ALL SELECT deployment, CASE WHEN knee_concurrency IS NULL
               THEN 'bench.knee_concurrency_none' ELSE 'bench.knee_concurrency' END,
               knee_concurrency, CASE WHEN knee_concurrency IS NULL
               THEN 'no level met the p95 TTFT SLO' END FROM knees)
    SELECT deployment, name, metric::DOUBLE AS metric, tag FROM flat""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    flat = reports.flatten_sweeps(sweeps(spark, folder), ["deployment"])
    said = shown_errors(F.from_json("tag", "map<string,bigint>"))
    return flat.withColumn(
        "tag", F.when(F.col("name").endswith(".errors"), said).otherwise(F.col("tag"))
    )


# --------------------------------------------------------------------------- replies


@query(
    "reply_verdict",
    with_sql("bodies")
    + """ SELECT run_id,
        CASE kind WHEN 6 THEN 'unparseable' WHEN 7 THEN 'server error' WHEN 1 THEN 'trace leaked'
             WHEN 2 THEN 'truncated before answer' WHEN 3 THEN 'empty' ELSE 'ok' END AS verdict,
        CASE WHEN kind = 4 THEN 'reasoning' WHEN kind = 5 THEN 'reasoning_content' END
            AS thinking_field,
        CASE WHEN kind = 4 THEN 'new' WHEN kind = 5 THEN 'older' ELSE '' END AS thinking,
        length(content)::BIGINT AS content_chars, completion_tokens,
        CASE WHEN completion_tokens > 0 THEN round(completion_tokens * 100.0 / 400, 4)::DOUBLE END
            AS used_pct
    FROM bodies""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    read = body_rows(spark, folder).withColumn("reply", R.read_body(F.col("body")))
    known = read.withColumn("facts", R.reply_facts(F.col("reply")))
    used = R.budget_used_pct(F.col("facts.completion_tokens"), F.lit(400))
    return known.select(
        "run_id",
        R.reply_verdict(F.col("reply"), F.col("facts")).alias("verdict"),
        "facts.thinking_field",
        "facts.thinking",
        F.length("facts.content").cast("bigint").alias("content_chars"),
        "facts.completion_tokens",
        F.round(used, 4).alias("used_pct"),
    )


@query(
    "comparison_facts",
    """SELECT conv_id, turn, length(text)::BIGINT AS chars,
              CASE WHEN turn % 2 = 1 THEN length(role) ELSE 0 END::BIGINT AS reasoning_tokens,
              turn % 3 = 0 AS thinking_in_content
       FROM (SELECT conv_id, turn, role,
                    CASE WHEN turn % 3 = 0 THEN '<think>' || text ELSE text END AS text
             FROM conversations)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    turn = F.col("turn")
    content = F.when(turn % 3 == 0, F.concat(F.lit("<think>"), "text")).otherwise(F.col("text"))
    facts = R.comparison_facts(content, F.when(turn % 2 == 1, F.col("role")))
    return (
        table(spark, folder, "conversations")
        .select("conv_id", "turn", facts.alias("f"))
        .select(
            "conv_id",
            "turn",
            F.col("f.chars").cast("bigint").alias("chars"),
            F.col("f.reasoning_tokens").cast("bigint").alias("reasoning_tokens"),
            "f.thinking_in_content",
        )
    )


@query(
    "flatten_replies",
    with_sql("bodies")
    + """ SELECT run_id, 'bench.smoke.' || name AS name, metric::DOUBLE AS metric, tag_md5 FROM (
        SELECT run_id, 'prompt_tokens' AS name, 11 AS metric, NULL AS tag_md5 FROM bodies
               WHERE kind < 6 AND turn <> 3
        UNION ALL SELECT run_id, 'completion_tokens', completion_tokens, NULL FROM bodies
               WHERE completion_tokens IS NOT NULL
        UNION ALL SELECT run_id, 'total_tokens', completion_tokens + 11, NULL FROM bodies
               WHERE completion_tokens IS NOT NULL
        UNION ALL SELECT run_id, 'reply', NULL, md5(content) FROM bodies WHERE content <> '')""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    flat = reports.flatten_replies(body_rows(spark, folder))
    return flat.select("run_id", "name", "metric", F.md5("tag").alias("tag_md5"))


_SPLIT = """SELECT o_orderkey AS run_id, 'run.o_custkey' AS name, o_custkey::DOUBLE AS metric
            FROM orders
            UNION ALL SELECT o_orderkey, 'run.o_totalprice', o_totalprice FROM orders"""


def _order_report(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        "o_custkey",
        "o_totalprice",
        (F.col("o_orderkey") % 2 == 0).alias("even"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
    )


def order_metrics_and_tags(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return reports.split_metrics_and_tags(_order_report(spark, folder), prefix="run.")


@query("report_metrics", _SPLIT)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return order_metrics_and_tags(spark, folder)[0]


@query(
    "report_tags",
    """SELECT o_orderkey AS run_id, 'run.even' AS name,
              CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END AS tag FROM orders
       UNION ALL SELECT o_orderkey, 'run.o_orderstatus', o_orderstatus FROM orders
              WHERE o_orderkey % 3 <> 0""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return order_metrics_and_tags(spark, folder)[1]


@query(
    "build_report",
    with_sql("bodies", "logs")
    + """, runs AS (
        SELECT DISTINCT file_id AS run_id, CASE WHEN substr(file_id, 6)::INTEGER % 3 = 0
               THEN 'swept' ELSE 'server_exited' END AS status FROM logs
        UNION ALL SELECT run_id, '' FROM bodies)
    , ranked AS (
        SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY line_no) AS rn,
               count(*) OVER (PARTITION BY file_id) AS n FROM block),
    kept AS (
        SELECT file_id, line_no AS place, 0 AS late, line FROM ranked WHERE n <= 28 OR rn <= 6 OR rn > n - 22
        UNION ALL SELECT file_id, line_no, 1, '... ' || (n - 28) || ' lines omitted ...'
        FROM ranked WHERE n > 28 AND rn = 6
        UNION ALL SELECT file_id, line_no, 0, line FROM (
            SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY line_no) AS rn
            FROM started WHERE first_speaker = '') WHERE rn <= 28),
    tails AS (
        SELECT file_id, line_no AS place, 0 AS late, line FROM logs
        QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY line_no DESC) <= 40),
    said AS (
        SELECT name, file_id, regexp_replace(string_agg(line || chr(10), '' ORDER BY place, late),
            '^\\s+|\\s+$', '', 'g') AS tag
        FROM (SELECT 'bench.vllm_cause' AS name, * FROM kept
              UNION ALL SELECT 'bench.vllm_tail', * FROM tails) GROUP BY ALL)
    SELECT run_id, 'bench.status' AS name, NULL::DOUBLE AS metric, status AS tag FROM runs
        WHERE status <> ''
    UNION ALL SELECT run_id, 'bench.smoke.prompt_tokens', 11, NULL FROM bodies
        WHERE kind < 6 AND turn <> 3
    UNION ALL SELECT run_id, 'bench.smoke.completion_tokens', completion_tokens, NULL FROM bodies
        WHERE completion_tokens IS NOT NULL
    UNION ALL SELECT run_id, 'bench.smoke.total_tokens', completion_tokens + 11, NULL FROM bodies
        WHERE completion_tokens IS NOT NULL
    UNION ALL SELECT run_id, 'bench.smoke.reply', NULL, content FROM bodies WHERE content <> ''
    UNION ALL SELECT run_id, name, NULL, tag FROM runs JOIN said ON file_id = run_id
        WHERE status = 'server_exited' AND tag <> ''""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    lines = log_rows(spark, folder)
    replies = body_rows(spark, folder)
    number = F.substring("run_id", 6, 10).cast("int")
    runs = (
        lines.select(F.col("file_id").alias("run_id"))
        .distinct()
        .withColumn("status", F.when(number % 3 == 0, "swept").otherwise("server_exited"))
        .unionByName(replies.select("run_id", F.lit("").alias("status")))
    )
    return reports.build_report(runs, replies=replies, log_lines=lines)
