"""Registered queries: judge scores and base-versus-tuned comparison."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.judging import judge_prompt
from meterloom.operators import evaluation, reports
from meterloom.plans.inputs import harness_rows, judgement_rows, table, with_sql
from meterloom.plans.registry import query
from meterloom.session import shared_folder
from meterloom.sources import sinks


@query(
    "judge_prompt",
    """SELECT conv_id, turn, md5('당신은 한국어 답변의 품질을 평가하는 심사위원입니다.' || chr(10)
        || '정확성, 논리성, 한국어 표현의 자연스러움을 함께 고려하여 평가하세요.' || chr(10) || chr(10)
        || '[질문]' || chr(10) || text || chr(10) || chr(10)
        || '[답변]' || chr(10) || role || chr(10) || chr(10)
        || CASE WHEN turn % 2 = 0 THEN '[참고 답안]' || chr(10) || conv_id || chr(10) || chr(10)
           ELSE '' END
        || '먼저 평가 근거를 2~3문장으로 쓰고, 마지막 줄에 1점부터 10점 사이의' || chr(10)
        || '점수를 반드시 [[점수]] 형식으로 출력하세요. 예: [[7]]') AS prompt_md5
    FROM conversations""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    reference = F.when(F.col("turn") % 2 == 0, F.col("conv_id").cast("string"))
    prompt = judge_prompt(F.col("text"), F.col("role"), reference)
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", F.md5(prompt).alias("prompt_md5")
    )


@query("judge_scores", with_sql("judgements") + " SELECT key, category, score, error FROM scored")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.score_judgements(judgement_rows(spark, folder)).drop("judgement")


@query(
    "judge_means",
    with_sql("judgements")
    + """ SELECT grouping(category) = 1 AS is_overall, coalesce(category, 'overall') AS category,
           round(avg(score), 4) AS mean_score, count(score)::BIGINT AS n_scored,
           (count(*) - count(score))::BIGINT AS n_failed
       FROM scored GROUP BY GROUPING SETS ((category), ())""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    scored = evaluation.score_judgements(judgement_rows(spark, folder))
    return evaluation.judge_means(scored).withColumn("mean_score", F.round("mean_score", 4))


def _answer(prompts):
    """A stand-in client: the longest word, or a failure."""
    return [
        RuntimeError("no capacity") if len(p) % 9 == 0 else max(p.split(), key=len, default="")
        for p in prompts
    ]


def _judge(prompts):
    """A stand-in judge: a score that depends on the answer it is shown."""
    answers = [re.search(r"\[답변\]\n(.*?)\n\n", p, re.DOTALL).group(1) for p in prompts]
    return [f"길이 {len(a)} [[{len(a) % 12}]]" for a in answers]


@query(
    "judged_run",
    r"""WITH words AS (
        SELECT conv_id, turn, text, length(text) % 9 = 0 AS broken,
               list_max([length(x) FOR x IN regexp_split_to_array(text, '\s+')]) AS longest
        FROM conversations WHERE role = 'user')
    SELECT conv_id || '-' || turn AS key, 'turn-' || turn AS category,
           CASE WHEN NOT broken AND longest % 12 BETWEEN 1 AND 10 THEN longest % 12 END::DOUBLE
               AS score,
           CASE WHEN broken THEN 'generation failed: no capacity'
                WHEN longest % 12 NOT BETWEEN 1 AND 10 THEN 'judging failed: score '
                     || (longest % 12)::DOUBLE || ' outside 1..10 in judge response: '''
                     || '길이 ' || longest || ' [[' || longest % 12 || ']]''' ELSE '' END AS error
    FROM words""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    questions = (
        table(spark, folder, "conversations")
        .filter(F.col("role") == "user")
        .select(
            F.concat_ws("-", "conv_id", "turn").alias("id"),
            F.concat(F.lit("turn-"), "turn").alias("category"),
            F.col("text").alias("question"),
        )
    )
    results = evaluation.run_judged_eval(questions, answer=_answer, judge=_judge)
    return results.select("key", "category", "score", "error")


@query("headline_scores", with_sql("harness") + " SELECT run, task, round(share, 4) AS score FROM harness")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.headline_scores(harness_rows(spark, folder), ["run", "task"])


def compared(spark: SparkSession, folder: str) -> DataFrame:
    scores = evaluation.headline_scores(harness_rows(spark, folder), ["run", "task"])
    return evaluation.compare_scores(
        scores.filter(F.col("run") == "base"), scores.filter(F.col("run") == "tuned")
    )


@query("eval_delta", with_sql("harness") + " SELECT * FROM compared")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return compared(spark, folder)


@query(
    "eval_confidence",
    with_sql("harness")
    + """ SELECT task, round(sqrt(base * (1 - base) / n), 4) AS std_error,
           round(1.96 * sqrt(base * (1 - base) / n), 4) AS half_width_95,
           abs(delta) > 1.96 * sqrt(base * (1 - base) / n) AS outside
       FROM compared LEFT JOIN (SELECT task, n FROM harness WHERE run = 'base') USING (task)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    sizes = harness_rows(spark, folder).filter(F.col("run") == "base").select("task", "n")
    joined = compared(spark, folder).join(sizes, "task", "left")
    return evaluation.with_confidence(joined, F.col("n")).select(
        "task",
        F.round("std_error", 4).alias("std_error"),
        F.round("half_width_95", 4).alias("half_width_95"),
        "outside",
    )


@query(
    "eval_metrics",
    with_sql("harness")
    + """ SELECT 'eval.' || replace(task, '/', '_') || '.' || field AS name, metric
       FROM (SELECT task, unnest(['base', 'tuned', 'delta']) AS field,
                    unnest([base, tuned, delta]) AS metric FROM compared)
       WHERE metric IS NOT NULL""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    flat = reports.flatten_comparison(compared(spark, folder), keys=[])
    return flat.select("name", "metric")


@query(
    "eval_documents",
    with_sql("harness")
    + """ SELECT split_part(task, '/', 1) AS run_id, 'tuned-' || split_part(task, '/', 1) AS adapter,
           task, base, tuned, delta, delta_pct, base AS base_score, tuned AS tuned_score
       FROM compared""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """K4: evaluation documents, written and read back whole."""
    rows = compared(spark, folder).withColumn("run_id", F.substring_index("task", "/", 1))
    runs = rows.select("run_id").distinct().withColumn(
        "adapter", F.concat(F.lit("tuned-"), "run_id")
    )
    documents = reports.evaluation_reports(runs, rows)
    path = f"{shared_folder(spark)}/roundtrip/evaluations-{uuid.uuid4().hex}"
    sinks.write_documents(documents, path)
    scores = "map<string, double>"
    row = "struct<task: string, base: double, tuned: double, delta: double, delta_pct: double>"
    read = spark.read.schema(
        f"run_id string, adapter string, base {scores}, tuned {scores}, comparison array<{row}>"
    ).json(path)
    return read.select(
        "run_id", "adapter", F.col("base").alias("_b"), F.col("tuned").alias("_t"), F.inline("comparison")
    ).select(
        "run_id",
        "adapter",
        "task",
        "base",
        "tuned",
        "delta",
        "delta_pct",
        F.try_element_at("_b", F.col("task")).alias("base_score"),
        F.try_element_at("_t", F.col("task")).alias("tuned_score"),
    )


@query(
    "identity_tags",
    """SELECT conv_id, 'eval.' || name AS name, tag FROM (
        SELECT conv_id, unnest(['model', 'adapter', 'benchmarks']) AS name,
               unnest(['m' || conv_id % 3, CASE WHEN conv_id % 2 = 0 THEN 'a' ELSE 'None' END,
                       string_agg(role, ',' ORDER BY turn)]) AS tag
        FROM conversations GROUP BY conv_id)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    runs = turns.groupBy("conv_id").agg(
        F.concat(F.lit("m"), F.col("conv_id") % 3).alias("model"),
        F.when(F.col("conv_id") % 2 == 0, F.lit("a")).alias("adapter"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda t: t["role"]
        ).alias("benchmarks"),
    )
    return reports.identity_tags(runs, ["conv_id"]).select("conv_id", "name", "tag")
