"""From stored harness output, or from questions, to evaluation reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from meterloom.operators import evaluation
from meterloom.session import stage
from meterloom.sources.sinks import write_judgements


def compare_runs(
    base: DataFrame, tuned: DataFrame, keys: Sequence[str] = ("task",)
) -> DataFrame:
    """Headline scores of both runs, side by side."""
    return evaluation.compare_scores(
        evaluation.headline_scores(base, keys), evaluation.headline_scores(tuned, keys), keys
    )


def judge_questions(
    questions: DataFrame,
    *,
    answer: evaluation.Respond,
    judge: evaluation.Respond,
    out: str | None = None,
    max_score: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """Per-question results and their means.

    The results are staged before anything reads them: a second pass would ask again.
    """
    results = stage(
        evaluation.run_judged_eval(questions, answer=answer, judge=judge, max_score=max_score),
        "judged",
    )
    if out:
        write_judgements(results, out)
    return results, evaluation.judge_means(results)
