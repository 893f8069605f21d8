"""Load-test analytics: levels, knee, deployment comparison, cost per token."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.functions.replies import request_outcome, seconds_per_token
from meterloom.functions.text import SPACE
from meterloom.operators.quantiles import exact_quantiles

LEVEL = ("deployment", "concurrency")
# The percentiles a level reports.
LEVEL_QUANTILES = {
    "ttft": (0.50, 0.95, 0.99),
    "tpot": (0.50, 0.95),
    "e2e": (0.50, 0.95, 0.99),
}
# The numeric fields of a level that are reported as metrics.
LEVEL_METRICS = (
    "requests",
    "succeeded",
    "failed",
    "wall_s",
    "ttft_p50",
    "ttft_p95",
    "ttft_p99",
    "tpot_p50",
    "tpot_p95",
    "e2e_p50",
    "e2e_p95",
    "e2e_p99",
    "output_tokens",
    "output_tok_per_s",
    "requests_per_s",
)


def classify_requests(raw: DataFrame) -> DataFrame:
    """P12 and P13 over recorded requests with ``status, body, exception, output_tokens``."""
    outcome = request_outcome(
        F.col("status"), F.col("body"), F.col("exception"), F.col("output_tokens")
    )
    return (
        raw.withColumn("_outcome", outcome)
        .withColumn("ok", F.col("_outcome.ok"))
        .withColumn("status", F.col("_outcome.status"))
        .withColumn("error", F.col("_outcome.error"))
        .drop("_outcome", "body", "exception")
        .withColumn(
            "tpot_s",
            seconds_per_token(F.col("ttft_s"), F.col("total_s"), F.col("output_tokens")),
        )
    )


def assign_prompts(requests: DataFrame, n_prompts: int) -> DataFrame:
    """The prompt a round robin sent with each request."""
    return requests.withColumn("prompt_no", F.pmod(F.col("request_no"), F.lit(n_prompts)))


def error_key() -> Column:
    """A10: first line of the error, 80 characters, else the HTTP status."""
    line = F.substring(F.substring_index(F.coalesce("error", F.lit("")), "\n", 1), 1, 80)
    return F.coalesce(
        F.nullif(line, F.lit("")), F.concat(F.lit("http "), F.col("status").cast("string"))
    )


def error_histogram(requests: DataFrame, level: Sequence[str] = LEVEL) -> DataFrame:
    """A10: failed requests per level and error."""
    return (
        requests.filter(~F.col("ok"))
        .groupBy(*level, error_key().alias("error"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def level_percentiles(
    requests: DataFrame, level: Sequence[str] = LEVEL
) -> DataFrame:
    """TTFT, TPOT and end-to-end percentiles per level, rounded to four places.

    Only requests that succeeded count, and TPOT only where a second token exists.
    """
    ok = F.col("ok")
    tpot = seconds_per_token(F.col("ttft_s"), F.col("total_s"), F.col("output_tokens"))
    measured = requests.filter(ok).select(
        *level,
        F.col("ttft_s").alias("ttft"),
        F.when(F.col("output_tokens") > 1, tpot).alias("tpot"),
        F.col("total_s").alias("e2e"),
    )
    long = measured.unpivot(list(level), list(LEVEL_QUANTILES), "measure", "seconds")
    wanted = sorted({q for qs in LEVEL_QUANTILES.values() for q in qs})
    found = exact_quantiles(
        long, [*level, "measure"], "seconds", wanted
    )

    def cell(measure: str, q: float) -> Column:
        hit = (F.col("measure") == measure) & (F.col("q") == q)
        name = f"{measure}_p{round(q * 100)}"
        return F.round(F.max(F.when(hit, F.col("quantile"))), 4).alias(name)

    return found.groupBy(*level).agg(
        *[cell(measure, q) for measure, qs in LEVEL_QUANTILES.items() for q in qs]
    )


def level_summary(
    requests: DataFrame, level: Sequence[str] = LEVEL
) -> DataFrame:
    """One row per level.

    ``requests`` holds ``ok, ttft_s, total_s, output_tokens, start_s``. Wall time runs
    from the first start to the last end. A level without any success reports 0.0
    percentiles, as an empty sample does. ``label_holds`` is false when fewer requests
    were sent than the level's concurrency, which then was never reached.
    """
    ok = F.col("ok")
    end = F.col("start_s") + F.col("total_s")
    totals = requests.groupBy(*level).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(~ok).alias("failed"),
        (F.max(end) - F.min("start_s")).alias("_wall"),
        F.coalesce(F.sum(F.when(ok, F.col("output_tokens"))), F.lit(0)).alias("output_tokens"),
    )
    percentiles = level_percentiles(requests, level)
    names = [c for c in percentiles.columns if c not in level]
    wall = F.col("_wall")

    def per_second(column: str, digits: int) -> Column:
        return F.when(wall > 0, F.round(F.col(column) / wall, digits)).otherwise(F.lit(0.0))

    return (
        totals.join(percentiles, list(level), "left")
        .fillna(0.0, names)
        .withColumn("wall_s", F.round(wall, 3))
        .withColumn("output_tok_per_s", per_second("output_tokens", 2))
        .withColumn("requests_per_s", per_second("succeeded", 3))
        .withColumn("label_holds", F.col("requests") >= F.col("concurrency"))
        .select(*level, *LEVEL_METRICS, "label_holds")
    )


def find_knee(
    levels: DataFrame, ttft_slo_s: float, by: Sequence[str] = ("deployment",)
) -> DataFrame:
    """The highest level that succeeded throughout within the SLO.

    Every deployment gets a row; a null knee says that no level met the SLO.
    """
    passes = (
        (F.col("succeeded") > 0) & (F.col("failed") == 0) & (F.col("ttft_p95") <= ttft_slo_s)
    )
    best = F.max(
        F.when(passes, F.struct("concurrency", "output_tok_per_s", "requests_per_s"))
    )
    return (
        levels.groupBy(*by)
        .agg(best.alias("_best"))
        .select(
            *by,
            F.col("_best.concurrency").alias("knee_concurrency"),
            F.col("_best.output_tok_per_s").alias("knee_tok_per_s"),
            F.col("_best.requests_per_s").alias("knee_requests_per_s"),
        )
    )


def sweep_totals(levels: DataFrame, by: Sequence[str] = ("deployment",)) -> DataFrame:
    """Peak throughput and failures of a sweep."""
    return levels.groupBy(*by).agg(
        F.coalesce(F.max("output_tok_per_s"), F.lit(0.0)).alias("peak_output_tok_per_s"),
        F.sum("failed").alias("failed_total"),
        F.count(F.lit(1)).alias("n_levels"),
    )


def tokens_per_request(levels: DataFrame) -> DataFrame:
    """Output tokens per request that succeeded."""
    return levels.withColumn(
        "tokens_per_request", F.col("output_tokens") / F.greatest(F.col("succeeded"), F.lit(1))
    )


def chart_feed(
    levels: DataFrame,
    deployments: Sequence[str],
    ttft_slo_s: float | None = None,
    max_tokens: int | None = None,
) -> DataFrame:
    """One row per concurrency, the curves of each deployment side by side.

    Deployments are named by the caller, so no pass is spent on finding them.
    """
    curves = tokens_per_request(levels).withColumn(
        "requests_per_s_x100", F.col("requests_per_s") * 100
    )
    shown = (
        "ttft_p50",
        "ttft_p95",
        "tpot_p50",
        "output_tok_per_s",
        "requests_per_s_x100",
        "tokens_per_request",
    )
    return (
        curves.groupBy("concurrency")
        .pivot("deployment", list(deployments))
        .agg(*[F.max(name).alias(name) for name in shown])
        .withColumn("ttft_slo_s", F.lit(ttft_slo_s).cast("double"))
        .withColumn("max_tokens", F.lit(max_tokens).cast("bigint"))
        .orderBy("concurrency")
    )


def side_by_side(replies: DataFrame, left: str, right: str) -> DataFrame:
    """Two deployments per prompt position, by one aggregate instead of a self-join.

    ``replies`` holds one reply per ``deployment`` and ``prompt_no``.
    """

    def of(deployment: str, name: str) -> Column:
        return F.max(F.when(F.col("deployment") == deployment, F.col(name)))

    return (
        replies.filter(F.col("deployment").isin(left, right))
        .groupBy("prompt_no")
        .agg(
            of(left, "completion_tokens").alias("left_tokens"),
            of(left, "finish_reason").alias("left_finish"),
            of(right, "completion_tokens").alias("right_tokens"),
            of(right, "finish_reason").alias("right_finish"),
        )
        .withColumn("token_diff", F.col("left_tokens") - F.col("right_tokens"))
    )


def deployment_totals(replies: DataFrame, by: Sequence[str] = ("deployment",)) -> DataFrame:
    """Tokens, mean tokens and replies cut at the cap, per deployment.

    A cut reply's count is a floor, so ``any_cut`` warns against reading the totals as
    lengths.
    """
    cut = F.coalesce(F.col("finish_reason") == "length", F.lit(False))
    return replies.groupBy(*by).agg(
        F.count(F.lit(1)).alias("replies"),
        F.sum("completion_tokens").alias("total_tokens"),
        F.avg("completion_tokens").alias("mean_tokens"),
        F.count_if(cut).alias("cut"),
        (F.count_if(cut) > 0).alias("any_cut"),
    )


def capped_share(replies: DataFrame) -> DataFrame:
    """How many of all replies ended at the cap."""
    cut = F.coalesce(F.col("finish_reason") == "length", F.lit(False))
    return replies.agg(
        F.count_if(cut).alias("capped"),
        F.count(F.lit(1)).alias("replies"),
        F.try_divide(F.count_if(cut), F.count(F.lit(1))).alias("capped_share"),
    )


def weighted_gap(pairs: DataFrame, requests: DataFrame) -> DataFrame:
    """The token gap of a sweep, split by prompt.

    ``requests`` holds the ``prompt_no`` each request was given; the weight of a prompt is
    how often it was sent.
    """
    sent = requests.groupBy("prompt_no").agg(F.count(F.lit(1)).alias("weight"))
    return pairs.join(sent, "prompt_no").withColumn(
        "weighted_diff", F.col("weight") * F.col("token_diff")
    )


def usd_per_million_tokens(tok_per_s: Column, hourly_usd: Column) -> Column:
    """Null when the rate is unknown or nothing was produced."""
    return F.when(tok_per_s > 0, hourly_usd / (tok_per_s * 3600) * 1_000_000)


def content_head(content: Column, chars: int = 160) -> Column:
    """The start of a reply on one line."""
    return F.substring(F.trim(F.regexp_replace(content, f"[{SPACE}]+", " ")), 1, chars)
