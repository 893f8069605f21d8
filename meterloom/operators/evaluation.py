"""Judge results, harness results, and base-versus-tuned comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.functions.judging import DEFAULT_MAX_SCORE, judge_prompt, parse_score

# The headline metrics of an evaluation task, in priority order.
HEADLINE_METRICS = (
    "acc_norm,none",
    "acc,none",
    "exact_match,none",
    "prompt_level_strict_acc,none",
    "inst_level_strict_acc,none",
)
STDERR_SUFFIX = "_stderr,none"
UNCATEGORISED = "uncategorised"
# 97.5th percentile of the normal distribution, as the reference numbers use it.
Z_95 = 1.96

Respond = Callable[[Sequence[str]], Sequence[object]]


def score_judgements(
    judgements: DataFrame, max_score: int = DEFAULT_MAX_SCORE, text: str = "judgement"
) -> DataFrame:
    """Add ``score`` (null when unusable) and ``error``."""
    return (
        judgements.withColumn("_parsed", parse_score(F.col(text), max_score))
        .withColumn("score", F.col("_parsed.score"))
        .withColumn("error", F.col("_parsed.error"))
        .drop("_parsed")
    )


def judge_means(results: DataFrame) -> DataFrame:
    """Mean score per category and overall, failures counted, not averaged.

    ``is_overall`` marks the grand row, so a category may be called anything. The overall
    mean is over questions, and 0.0 when nothing was scored.
    """
    total, scored = F.sum("_sum"), F.sum("n_scored")
    by_category = results.groupBy("category").agg(
        F.sum("score").alias("_sum"),
        F.count("score").alias("n_scored"),
        F.count_if(F.col("score").isNull()).alias("n_failed"),
    )
    # From the category sums, not from the questions again. Unlike grouping sets, a plain
    # aggregate has a row for no questions at all.
    overall = by_category.agg(
        F.lit(True).alias("is_overall"),
        F.lit("overall").alias("category"),
        F.coalesce(F.try_divide(total, scored), F.lit(0.0)).alias("mean_score"),
        F.coalesce(scored, F.lit(0)).alias("n_scored"),
        F.coalesce(F.sum("n_failed"), F.lit(0)).alias("n_failed"),
    )
    categories = by_category.select(
        F.lit(False).alias("is_overall"),
        "category",
        F.try_divide("_sum", "n_scored").alias("mean_score"),
        "n_scored",
        "n_failed",
    )
    return categories.unionByName(overall).orderBy("is_overall", "category")


def answer_with(
    rows: DataFrame, respond: Respond, prompt: str, reply: str, error: str, failure: str
) -> DataFrame:
    """Add ``reply`` and ``error`` columns by calling ``respond`` inside the tasks.

    ``respond`` takes the prompts of one Arrow batch and returns a text or an exception
    for each. A row whose ``error`` is already set is not asked.

    A call that raises is made again with each half of its prompts, so that what can be
    answered is, and one bad prompt among n is found in about 2 log2(n) more calls. Of a
    call that returns too few answers, those it gave are kept: they are in order, and only
    the prompts after them are asked again, until a call returns none. Surplus answers are
    dropped. The run never ends for what a client does.
    """
    schema = rows.withColumn(reply, F.lit("")).withColumn(error, F.lit("")).schema

    def ask(prompts: list[str]) -> list[object]:
        done: list[object] = []
        while len(done) < len(prompts):
            left = prompts[len(done) :]
            try:
                found = list(respond(left))[: len(left)]
            except Exception as exc:  # noqa: BLE001 - becomes the rows' error text
                if len(left) == 1:
                    return [*done, exc]
                half = len(left) // 2
                return [*done, *ask(left[:half]), *ask(left[half:])]
            if not found:
                return [*done, *[RuntimeError("no answer was returned")] * len(left)]
            done += found
        return done

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors = (
                batch[error].fillna("").tolist() if error in batch else [""] * len(batch)
            )
            open_rows = [i for i, e in enumerate(errors) if not e]
            replies = [""] * len(batch)
            if open_rows:
                prompts = batch[prompt].tolist()
                found = ask([prompts[i] for i in open_rows])
                for i, answer in zip(open_rows, found, strict=True):
                    if isinstance(answer, BaseException):
                        errors[i] = f"{failure}: {answer}"
                    else:
                        replies[i] = "" if answer is None else str(answer)
            yield batch.assign(**{reply: replies, error: errors})[schema.fieldNames()]

    return rows.mapInPandas(run, schema)


def run_judged_eval(
    questions: DataFrame,
    *,
    answer: Respond,
    judge: Respond,
    max_score: int = DEFAULT_MAX_SCORE,
) -> DataFrame:
    """answers, judgements and scores for every question.

    ``questions`` holds ``question`` and optionally ``id, key, category, reference,
    position``. The clients are passed in; failures become rows with a null score and an
    error text, and never end the run.
    """
    present = questions.columns

    def given(name: str) -> Column:
        return F.col(name).cast("string") if name in present else F.lit(None).cast("string")

    asked = questions.select(
        F.coalesce(given("id"), given("key"), given("position")).alias("key"),
        F.coalesce(given("category"), F.lit(UNCATEGORISED)).alias("category"),
        "question",
        F.coalesce(given("reference"), F.lit("")).alias("reference"),
    )
    answered = answer_with(asked, answer, "question", "answer", "error", "generation failed")
    prompted = answered.withColumn(
        "_prompt",
        judge_prompt(F.col("question"), F.col("answer"), F.col("reference"), max_score),
    )
    judged = answer_with(
        prompted, judge, "_prompt", "judgement", "error", "judging failed"
    ).withColumn("_parsed", parse_score(F.col("judgement"), max_score))
    open_row = F.col("error") == ""
    unusable = open_row & (F.col("_parsed.error") != "")
    return judged.select(
        "key",
        "category",
        F.when(open_row, F.col("_parsed.score")).alias("score"),
        "answer",
        "judgement",
        F.when(unusable, F.concat(F.lit("judging failed: "), F.col("_parsed.error")))
        .otherwise(F.col("error"))
        .alias("error"),
    )


def headline_scores(harness: DataFrame, keys: Sequence[str] = ("task",)) -> DataFrame:
    """One score per task from its ``metrics`` map, rounded to four places.

    Falls back to the first metric that is not a standard error. Tasks without any
    number are left out.
    """
    named = [F.try_element_at("metrics", F.lit(name)) for name in HEADLINE_METRICS]
    others = F.filter(
        F.map_entries("metrics"),
        lambda e: e["value"].isNotNull()
        & ~e["key"].endswith(STDERR_SUFFIX)
        & (e["key"] != "alias"),
    )
    score = F.round(F.coalesce(*named, F.get(others, 0)["value"]), 4)
    return harness.select(*keys, score.alias("score")).filter(F.col("score").isNotNull())


def compare_scores(
    base: DataFrame, tuned: DataFrame, keys: Sequence[str] = ("task",)
) -> DataFrame:
    """Base and tuned side by side over the union of their tasks."""
    joined = base.select(*keys, F.col("score").alias("base")).join(
        tuned.select(*keys, F.col("score").alias("tuned")), list(keys), "full_outer"
    )
    return (
        joined.withColumn("delta", F.round(F.col("tuned") - F.col("base"), 4))
        .withColumn(
            "delta_pct",
            F.when(F.col("base") != 0, F.round(F.col("delta") / F.col("base") * 100, 2)),
        )
        .orderBy(*keys)
    )


def with_confidence(compared: DataFrame, n: Column) -> DataFrame:
    """Standard error of the base score over ``n`` questions, and its 95 % half-width.

    ``outside`` tells whether the delta is larger than the half-width; null if unknown.
    """
    p = F.col("base")
    error = F.when((n > 0) & p.between(0, 1), F.sqrt(p * (1 - p) / n))
    return (
        compared.withColumn("std_error", error)
        .withColumn("half_width_95", F.col("std_error") * Z_95)
        .withColumn("outside", F.abs("delta") > F.col("half_width_95"))
    )
