from __future__ import annotations

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from meterloom.functions.judging import judge_prompt
from meterloom.operators import evaluation
from meterloom.plans.evaluation_job import judge_questions

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def scored(spark, text, max_score=10):
    df = spark.createDataFrame([(text,)], "judgement string")
    row = evaluation.score_judgements(df, max_score).first()
    return row.score, row.error


@pytest.mark.parametrize(
    ("text", "score"),
    [
        ("8", 8), ("점수: 7", 7), ("Score: 9", 9), ("이유가 있습니다. [[6]]", 6), ("Score: 8/10", 8),
        ("점수: 7.5", 7.5), ("1점에서 10점까지, 점수: 10 만점 기준. 최종 점수: 6", 6),
        ("3개의 예시와 2개의 근거. [[4]]", 4), (" 9\n", 9), ("[[ 5 ]]", 5), ("RATING : 3", 3),
    ],
)
def test_scores(spark, text, score):
    assert scored(spark, text) == (score, "")


@pytest.mark.parametrize(
    "text", ["점수: 100", "점수: 0", "좋은 답변입니다", "", "  ", None, "there are 7 items",
             "[[11]] 점수: 5"],
)
def test_unusable(spark, text):
    score, error = scored(spark, text)
    assert score is None and error


def test_smaller_scale(spark):
    assert scored(spark, "점수: 4", 5) == (4, "")
    assert scored(spark, "점수: 9", 5)[0] is None


def test_an_empty_reference_leaves_its_block_out(spark):
    df = spark.createDataFrame([("q", "a", ""), ("q", "a", "r")], "q string, a string, r string")
    prompts = [
        r[0] for r in df.select(judge_prompt(F.col("q"), F.col("a"), F.col("r"), 5)).collect()
    ]
    assert "참고 답안" not in prompts[0]
    assert "[참고 답안]\nr\n\n먼저" in prompts[1]
    assert "5점 사이" in prompts[0]


def means(spark, rows):
    df = spark.createDataFrame(rows, "category string, score double")
    found = evaluation.judge_means(df).collect()
    return {r.category: r.mean_score for r in found if not r.is_overall}, [
        r for r in found if r.is_overall
    ][0]


def test_the_overall_mean_is_over_questions(spark):
    by_category, overall = means(spark, [("a", 10.0), ("a", 10.0), ("b", 1.0), ("b", None)])
    assert by_category == {"a": 10.0, "b": 1.0}
    assert (overall.mean_score, overall.n_scored, overall.n_failed) == (7.0, 3, 1)


def test_nothing_scored_is_zero_overall(spark):
    _, overall = means(spark, [])
    assert (overall.mean_score, overall.n_scored, overall.n_failed) == (0.0, 0, 0)


def test_a_category_may_be_called_overall(spark):
    by_category, overall = means(spark, [("overall", 2.0), ("x", 4.0)])
    assert by_category == {"overall": 2.0, "x": 4.0}
    assert overall.mean_score == 3.0


def _answer(prompts):
    if "boom" in prompts:
        raise RuntimeError("server gone")
    return [f"답 {p}" for p in prompts]


def _judge(prompts):
    return ["음... 모르겠다" if "답 shrug" in p else "[[8]]" for p in prompts]


def test_one_bad_question_does_not_end_the_run(spark, tmp_path):
    questions = spark.createDataFrame(
        [("1", "c", "ok"), (None, None, "boom"), ("3", "c", "shrug")],
        "id string, category string, question string",
    ).withColumn("position", F.lit(1))
    results, overall = judge_questions(
        questions, answer=_answer, judge=_judge, out=str(tmp_path / "out")
    )
    rows = {r.answer: r for r in results.collect()}
    assert rows["답 ok"].score == 8.0 and rows["답 ok"].error == ""
    assert rows[""].error == "generation failed: server gone"
    assert (rows[""].key, rows[""].category) == ("1", "uncategorised")
    assert rows["답 shrug"].error.startswith("judging failed: no score found")
    assert overall.filter("is_overall").first().n_failed == 2
    written = spark.read.text(str(tmp_path / "out")).collect()
    assert sum('"score":null' in r.value for r in written) == 2


def test_headline_metric_priority(spark):
    df = spark.createDataFrame(
        [
            ("t1", {"acc,none": 0.5, "acc_norm,none": 0.61237}),
            ("t2", {"alias": 1.0, "f1_stderr,none": 0.1, "f1,none": 0.4}),
            ("t3", {"x_stderr,none": 0.1}),
        ],
        "task string, metrics map<string,double>",
    )
    found = {r.task: r.score for r in evaluation.headline_scores(df).collect()}
    assert found == {"t1": 0.6124, "t2": 0.4}


def test_deltas(spark):
    base = spark.createDataFrame([("a", 0.4), ("b", 0.0), ("c", 0.3)], "task string, score double")
    tuned = spark.createDataFrame([("a", 0.44), ("b", 0.1), ("d", 0.2)], "task string, score double")
    found = {r.task: (r.delta, r.delta_pct) for r in evaluation.compare_scores(base, tuned).collect()}
    assert found == {"a": (0.04, 10.0), "b": (0.1, None), "c": (None, None), "d": (None, None)}


def test_confidence_of_the_published_delta(spark):
    compared = spark.createDataFrame([("t", 0.8, 0.96, 0.16)], "task string, base double, tuned double, delta double")
    row = evaluation.with_confidence(compared, F.lit(25)).first()
    assert row.std_error == pytest.approx(0.08)
    assert row.half_width_95 == pytest.approx(0.157, abs=1e-3)
    assert row.outside


def test_one_bad_question_among_many_is_found_by_halving(spark, tmp_path):
    """What can be answered is answered, and the calls grow with the logarithm."""
    log = str(tmp_path / "calls")

    def answer(prompts):
        with open(log, "a") as out:
            out.write("x")
        if any(p == "q611" for p in prompts):
            raise ValueError("cannot")
        return [f"a {p}" for p in prompts]

    asked = spark.createDataFrame([(f"q{i}",) for i in range(1000)], "question string").coalesce(1)
    found = evaluation.answer_with(asked, answer, "question", "reply", "error", "failed").collect()
    assert {r.question for r in found if r.error} == {"q611"}
    assert all(r.reply == f"a {r.question}" for r in found if not r.error)
    assert len(open(log).read()) <= 2 * 10 + 2


def test_a_short_list_of_answers_costs_rows_not_the_run(spark):
    def some(prompts):
        return [f"a {p}" for p in prompts[:3]]

    def none(prompts):
        return []

    def surplus(prompts):
        return [f"a {p}" for p in prompts] + ["more"]

    asked = spark.createDataFrame([(f"q{i}",) for i in range(10)], "question string").coalesce(1)
    for respond, wanted in ((some, 10), (none, 0), (surplus, 10)):
        found = evaluation.answer_with(asked, respond, "question", "reply", "error", "failed").collect()
        assert sum(r.reply == f"a {r.question}" for r in found) == wanted
        assert sum(r.error == "failed: no answer was returned" for r in found) == 10 - wanted
