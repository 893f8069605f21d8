"""Readers: corpora, questions, reports, logs, registries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterloom.operators.ordered import with_position
from meterloom.session import stage

INSTRUCTION_FIELDS = ("instruction", "input", "output")

QUESTION_SCHEMA = (
    "id string, key string, category string, question string, reference string"
)
LEVEL_SCHEMA = """struct<
    concurrency: int, requests: bigint, succeeded: bigint, failed: bigint, wall_s: double,
    ttft_p50: double, ttft_p95: double, ttft_p99: double, tpot_p50: double, tpot_p95: double,
    e2e_p50: double, e2e_p95: double, e2e_p99: double, output_tokens: bigint,
    output_tok_per_s: double, requests_per_s: double, errors: map<string, bigint>>"""
SWEEP_SCHEMA = f"""
    base_url string, model string, max_tokens int,
    chat_template_kwargs map<string, boolean>, ttft_slo_s double,
    levels array<{LEVEL_SCHEMA}>, knee_concurrency int, peak_output_tok_per_s double
"""
COMPARISON_SCHEMA = """
    max_tokens int, temperature double, chat_template_kwargs map<string, boolean>,
    prompts array<string>,
    deployments map<string, array<struct<
        finish_reason: string, completion_tokens: bigint, prompt_tokens: bigint,
        chars: bigint, reasoning_tokens: bigint, thinking_in_content: boolean,
        content: string>>>
"""


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table, or a parquet folder when given a path."""
    return spark.read.parquet(table) if "/" in table else spark.read.table(table)


def as_instructions(raw: DataFrame, source: str) -> DataFrame:
    """The instruction columns as strings, nulls as empty, with their provenance."""
    columns = [
        F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
        if name in raw.columns
        else F.lit("").alias(name)
        for name in INSTRUCTION_FIELDS
    ]
    return raw.select(*columns, F.lit(source).alias("source"))


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Sources by column name; an error when none is configured."""
    if not frames:
        raise ValueError("no source configured")
    return reduce(lambda a, b: a.unionByName(b), frames)


def read_sources(
    spark: SparkSession, paths: Mapping[str, str], file_format: str = "parquet"
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every source that can be opened, and ``source, ok, detail`` for all of them."""
    found: dict[str, DataFrame] = {}
    status = []
    for source, path in paths.items():
        try:
            found[source] = spark.read.format(file_format).load(path)
            status.append((source, True, ""))
        except PySparkException as exc:
            status.append((source, False, str(exc)))
    return found, spark.createDataFrame(status, "source string, ok boolean, detail string")


def read_instructions(
    spark: SparkSession, paths: Mapping[str, str], file_format: str = "json"
) -> tuple[DataFrame, DataFrame]:
    """All readable sources as instruction rows, and the read status."""
    found, status = read_sources(spark, paths, file_format)
    return union_sources([as_instructions(df, name) for name, df in found.items()]), status


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """Judge questions; blank lines are skipped, ``position`` counts the others."""
    return with_position(spark.read.schema(QUESTION_SCHEMA).json(path))


def read_reports(
    spark: SparkSession, path: str, schema: str = SWEEP_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """JSON reports labelled by file name, and ``run_id, reason`` for unreadable ones.

    A path without any file gives no reports and one reason.
    """
    corrupt = "_corrupt"
    try:
        files = spark.read.text(path, wholetext=True)
    except PySparkException as exc:
        absent = [(path, str(exc))]
        return (
            spark.createDataFrame([], f"run_id string, {schema}"),
            spark.createDataFrame(absent, "run_id string, reason string"),
        )
    read = F.from_json(
        "value", f"{schema}, {corrupt} string", {"columnNameOfCorruptRecord": corrupt}
    )
    raw = files.select(
        F.regexp_extract("_metadata.file_path", r"([^/]+?)(?:\.json)?\z", 1).alias("run_id"),
        read.alias("_r"),
    ).select("run_id", "_r.*")
    good = raw.filter(F.col(corrupt).isNull()).drop(corrupt)
    bad = raw.filter(F.col(corrupt).isNotNull()).select(
        "run_id", F.lit("not a readable report").alias("reason")
    )
    return good, bad


def comparison_replies(reports: DataFrame) -> DataFrame:
    """One row per reply of a deployment comparison, aligned by prompt position."""
    return (
        reports.select("run_id", "max_tokens", F.explode("deployments").alias("deployment", "_r"))
        .select("run_id", "max_tokens", "deployment", F.posexplode("_r").alias("prompt_no", "_r"))
        .select("run_id", "max_tokens", "deployment", "prompt_no", "_r.*")
    )


def sweep_levels(reports: DataFrame) -> DataFrame:
    """One row per level of a sweep report."""
    return reports.select(
        F.col("run_id").alias("deployment"), F.explode("levels").alias("_l")
    ).select("deployment", "_l.*")


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """``file_id, line_no, line`` with line numbers from 1; bad bytes are replaced.

    Files are read split by split, so a file of any size is spread over tasks. A line knows
    its place in its split; the line counts of the splits, put in order, are written as a
    table small enough to be sent to the readers, so no line is moved.
    """
    split = ["file_id", "_start"]
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_id"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
        F.make_valid_utf8("value").alias("line"),
    )
    before = Window.partitionBy("file_id").orderBy("_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        raw.groupBy(*split)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    return raw.join(stage(offsets, "splits"), split).select(
        "file_id",
        (F.col("_offset") + F.col("_id") - F.col("_first") + 1).alias("line_no"),
        "line",
    )


def registry_tables(spark: SparkSession, config: Mapping) -> tuple[DataFrame, DataFrame]:
    """``(mixes, datasets)`` from a parsed registry file."""
    mixes = [
        (name, entry.get("description"), list(entry.get("datasets", [])))
        for name, entry in config.get("mixes", {}).items()
    ]
    datasets = [
        tuple(entry.get(k) for k in ("key", "dataset_id", "license", "commercial_use", "kind"))
        for entry in config.get("datasets", [])
    ]
    return (
        spark.createDataFrame(mixes, "mix string, description string, datasets array<string>"),
        spark.createDataFrame(
            datasets,
            "key string, dataset_id string, license string, commercial_use boolean, kind string",
        ),
    )


def benchmark_tables(spark: SparkSession, config: Mapping) -> tuple[DataFrame, DataFrame]:
    """``(suites, benchmarks)`` from a parsed registry file."""
    suites = [(name, list(entry)) for name, entry in config.get("suites", {}).items()]
    fields = ("key", "dataset_id", "license", "eval_only", "metric", "harness_task")
    benchmarks = [
        (*[entry.get(k) for k in fields], bool(entry.get("judge_required", False)))
        for entry in config.get("benchmarks", [])
    ]
    return (
        spark.createDataFrame(suites, "suite string, benchmarks array<string>"),
        spark.createDataFrame(
            benchmarks,
            "key string, dataset_id string, license string, eval_only boolean, "
            "metric string, harness_task string, judge_required boolean",
        ),
    )


REGISTRY_SCHEMA = """
    datasets array<struct<key: string, dataset_id: string, license: string,
                          commercial_use: boolean, kind: string>>,
    mixes map<string, struct<description: string, datasets: array<string>>>,
    benchmarks array<struct<key: string, dataset_id: string, license: string, eval_only: boolean,
                            metric: string, harness_task: string, judge_required: boolean>>,
    suites map<string, array<string>>
"""


def read_registry(
    spark: SparkSession, path: str
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``(mixes, datasets, suites, benchmarks)`` of the registry files under a path.

    A file holds one registry as JSON; any of its four sections may be absent. An entry that
    does not say whether a judge is required needs none.
    """
    files = spark.read.schema(REGISTRY_SCHEMA).json(path, multiLine=True)
    mixes = files.select(F.explode("mixes").alias("mix", "_m")).select("mix", "_m.*")
    benchmarks = files.select(F.inline("benchmarks"))
    return (
        mixes.withColumn("datasets", F.coalesce("datasets", F.array().cast("array<string>"))),
        files.select(F.inline("datasets")),
        files.select(F.explode("suites").alias("suite", "benchmarks")),
        benchmarks.withColumn("judge_required", F.coalesce("judge_required", F.lit(False))),
    )
