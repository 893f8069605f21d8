"""From recorded stream lines to published serving metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.operators import reports, serving, streams
from meterloom.session import stage


@dataclass(frozen=True)
class SweepResult:
    levels: DataFrame
    errors: DataFrame
    knees: DataFrame
    totals: DataFrame
    documents: DataFrame


def accounts_of(frames: DataFrame, requests: DataFrame) -> DataFrame:
    """Request results of recorded frames.

    ``requests`` holds ``request_id, deployment, concurrency, start_s``. A request without
    a single frame failed.
    """
    parsed = streams.before_done(stage(streams.parse_frames(frames), "frames"))
    accounts = streams.account_streams(parsed)
    joined = requests.join(accounts, "request_id", "left").withColumn(
        "ok", F.coalesce("ok", F.lit(False))
    )
    results = streams.request_results(joined.fillna({"e2e_s": 0.0, "output_tokens": 0}))
    return results.join(requests.select("request_id", "start_s"), "request_id")


def summarise_sweep(results: DataFrame, ttft_slo_s: float) -> SweepResult:
    """Levels, knee, totals and the nested report of every deployment."""
    levels = stage(serving.level_summary(results), "levels")
    errors = serving.error_histogram(results)
    knees = serving.find_knee(levels, ttft_slo_s)
    totals = serving.sweep_totals(levels)
    documents = reports.sweep_reports(
        levels,
        errors,
        knees.select("deployment", "knee_concurrency"),
        totals.select("deployment", "peak_output_tok_per_s"),
    )
    return SweepResult(levels, errors, knees, totals, documents)


def flat_report(
    result: SweepResult, *, model: Column, base_url: Column, max_tokens: int, ttft_slo_s: float
) -> DataFrame:
    """The metrics and tags of every deployment's sweep."""
    described: Sequence[tuple[str, Column]] = (
        ("model", model),
        ("base_url", base_url),
        ("max_tokens", F.lit(max_tokens)),
        ("ttft_slo_s", F.lit(ttft_slo_s)),
    )
    documents = result.documents
    for name, value in described:
        documents = documents.withColumn(name, value)
    return reports.flatten_sweeps(documents, ["deployment"])
