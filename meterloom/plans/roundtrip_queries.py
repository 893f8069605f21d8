"""Registered queries: what the sinks write, read back, and what the readers read.

The files lie in a new folder of the shared one; writing them is what is being queried.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.functions.messages import render_plain
from meterloom.operators import corpus, evaluation, mixes
from meterloom.plans import corpus_queries, serving_queries
from meterloom.plans.inputs import instruction_rows, judgement_rows, table
from meterloom.plans.registry import ORACLES, query
from meterloom.session import shared_folder
from meterloom.sources import readers, sinks


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/roundtrip/{name}-{uuid.uuid4().hex}"


@query("written_chat_records", f"SELECT messages, source FROM ({ORACLES['chat_records']})")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """K1: the chat records as lines of JSON."""
    path = _path(spark, "chat")
    rows = corpus_queries.unique_rows(spark, folder, "instruction_n", "input", "output_n")
    sinks.write_chat_records(corpus.chat_records(rows), path)
    lines = spark.read.schema(
        "messages array<struct<role:string,content:string>>, source string"
    ).json(path)
    quoted = F.transform("messages", lambda m: F.to_json(F.array(m["role"], m["content"])))
    return lines.select(
        F.concat(F.lit("["), F.array_join(quoted, ","), F.lit("]")).alias("messages"), "source"
    )


@query(
    "written_rejected",
    corpus_queries.SCORED
    + " SELECT row_id, source, list_sort(reasons) AS reasons FROM scored WHERE len(reasons) > 0",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """K2: rejected rows with their reasons."""
    path = _path(spark, "rejected")
    rejected = corpus.rejected(corpus_queries.scored_rows(spark, folder))
    sinks.write_rejected(rejected.select("row_id", "source", "reasons"), path)
    found = spark.read.schema("row_id bigint, source string, reasons array<string>").json(path)
    return found.withColumn("reasons", F.sort_array("reasons"))


@query("written_judgements", ORACLES["judge_scores"])
def _(spark: SparkSession, folder: str) -> DataFrame:
    """K3: one judgement a line, unknown scores included."""
    path = _path(spark, "judgements")
    scored = evaluation.score_judgements(judgement_rows(spark, folder))
    sinks.write_judgements(scored.withColumn("answer", F.lit("")), path)
    kinds = {f.name: f.dataType for f in scored.schema}
    wanted = ["key", "category", "score", "error"]
    return spark.read.schema(T.StructType([T.StructField(n, kinds[n]) for n in wanted])).json(path)


def _published(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """An order report published twice, the first time with other values and other names."""
    path = _path(spark, "published")
    metrics, tags = serving_queries.order_metrics_and_tags(spark, folder)
    flat = metrics.withColumn("tag", F.lit(None).cast("string")).unionByName(
        tags.withColumn("metric", F.lit(None).cast("double"))
    )
    stale = flat.withColumn("name", F.concat("name", F.lit(".old"))).withColumn("metric", -F.col("metric"))
    for version in (stale, flat):
        sinks.publish(version, path)
    return sinks.published(spark, path)


@query("published_metrics", ORACLES["report_metrics"])
def _(spark: SparkSession, folder: str) -> DataFrame:
    """K6: the metrics of a report that was published again."""
    return _published(spark, folder)[0]


@query("published_tags", ORACLES["report_tags"])
def _(spark: SparkSession, folder: str) -> DataFrame:
    """K6: its tags."""
    return _published(spark, folder)[1]


@query(
    "sweep_documents",
    serving_queries.LEVELS
    + f""", {serving_queries._KNEE}, errors AS (
        SELECT deployment, concurrency, string_agg(error || '=' || n, ';' ORDER BY error) AS errors
        FROM (SELECT deployment, concurrency, split_part(error, chr(10), 1) AS error, count(*) AS n
              FROM requests WHERE NOT ok GROUP BY ALL) GROUP BY ALL)
    SELECT deployment, 'model-' || deployment AS model,
           CASE WHEN deployment = 'green' THEN 'http://green' ELSE '' END AS base_url,
           128 AS max_tokens, deployment = 'blue' AS thinking, 12.0::DOUBLE AS ttft_slo_s,
           knee_concurrency, max(output_tok_per_s) OVER (PARTITION BY deployment) AS peak_output_tok_per_s,
           concurrency, {", ".join(serving_queries._METRICS)}, coalesce(errors, '') AS errors
    FROM levels JOIN knees USING (deployment) LEFT JOIN errors USING (deployment, concurrency)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """K5: finished sweep documents, written and read back."""
    path = _path(spark, "sweeps")
    sinks.write_documents(serving_queries.sweeps(spark, folder), path)
    read = spark.read.schema(f"deployment string, {readers.SWEEP_SCHEMA}").json(path)
    levels = read.withColumn("l", F.explode("levels"))
    return levels.select(
        "deployment",
        "model",
        "base_url",
        "max_tokens",
        F.col("chat_template_kwargs.enable_thinking").alias("thinking"),
        "ttft_slo_s",
        "knee_concurrency",
        "peak_output_tok_per_s",
        "l.concurrency",
        *[f"l.{m}" for m in serving_queries._METRICS],
        serving_queries.shown_errors(F.col("l.errors")).alias("errors"),
    )


@query(
    "read_reports",
    serving_queries.LEVELS
    + """ SELECT 'model-' || deployment AS report, count(*)::BIGINT AS levels, '' AS reason
          FROM levels GROUP BY deployment
          UNION ALL SELECT 'broken', 0, 'not a readable report' FROM (
              SELECT DISTINCT event_type FROM events)
          UNION ALL SELECT 'absent', 0, 'absent'""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Sound reports, one broken report for each kind of event, and a folder without any."""
    path = _path(spark, "reports")
    documents = serving_queries.sweeps(spark, folder)
    whole = documents.select("deployment", F.to_json(F.struct(*documents.columns)).alias("value"))
    cut = table(spark, folder, "events").select(
        F.col("event_type").alias("deployment"), F.lit('{"levels": [').alias("value")
    )
    rows = whole.unionByName(cut.distinct())
    rows.repartition("deployment").write.partitionBy("deployment").text(path)
    good, bad = readers.read_reports(spark, f"{path}/*/*.txt")
    none, absent = readers.read_reports(spark, f"{path}/nowhere/*.txt")
    return (
        good.unionByName(none)
        .select(F.col("model").alias("report"), F.size("levels").cast("bigint").alias("levels"), F.lit("").alias("reason"))
        .unionByName(bad.select(F.lit("broken").alias("report"), F.lit(0).cast("bigint").alias("levels"), "reason"))
        .unionByName(
            absent.select(F.lit("absent").alias("report"), F.lit(0).cast("bigint").alias("levels"), F.lit("absent").alias("reason"))
        )
    )


@query(
    "read_questions",
    """SELECT 'q' || conv_id || '-' || turn AS id, text AS question, (count(*) OVER ())::BIGINT AS numbered
       FROM conversations WHERE role = 'user'""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Every question from lines of JSON, and how many their positions count without a gap."""
    path = _path(spark, "questions")
    asked = table(spark, folder, "conversations").filter("role = 'user'")
    name = readers.QUESTION_SCHEMA.split(",")[0].split()[0].strip(" `:")
    fields = [p.split()[0].strip(" `:") for p in readers.QUESTION_SCHEMA.split(",")]
    text = "question" if "question" in fields else fields[-1]
    asked.select(
        F.concat(F.lit("q"), "conv_id", F.lit("-"), "turn").alias(name), F.col("text").alias(text)
    ).write.json(path)
    found = readers.read_questions(spark, path)
    # Positions from 0 without a gap or a repeat: as many as the largest says.
    numbered = found.agg(
        F.when(F.count_distinct("position") == F.max("position") + 1, F.max("position") + 1).alias("numbered")
    )
    return found.select(F.col(name).alias("id"), F.col(text).alias("question")).crossJoin(F.broadcast(numbered))


@query(
    "read_logs",
    """SELECT event_type AS kind, count(*)::BIGINT AS lines, count(*)::BIGINT AS numbered,
              sum(length(props))::BIGINT AS characters,
              bit_xor(hash_of) AS content FROM (
           SELECT *, ('0x' || substr(md5(props), 1, 12))::BIGINT AS hash_of FROM events)
       GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Log files of each kind of event, as many as tasks wrote them, numbered from 1."""
    path = _path(spark, "logs")
    events = table(spark, folder, "events").select("event_type", F.col("props").alias("value"))
    events.repartition(spark.sparkContext.defaultParallelism).write.partitionBy("event_type").text(path)
    content = F.conv(F.substring(F.md5("line"), 1, 12), 16, 10).cast("bigint")
    files = readers.read_logs(spark, f"{path}/*/*.txt").groupBy("file_id").agg(
        F.count(F.lit(1)).alias("lines"),
        # Numbers without a gap or a repeat: as many different ones as the largest says.
        F.when(
            (F.min("line_no") == 1) & (F.count_distinct("line_no") == F.max("line_no")), F.max("line_no")
        ).alias("numbered"),
        F.sum(F.length("line")).alias("characters"),
        F.bit_xor(content).alias("content"),
    )
    return files.groupBy(F.regexp_extract("file_id", "event_type=([^/]+)/", 1).alias("kind")).agg(
        F.sum("lines").alias("lines"),
        F.sum("numbered").alias("numbered"),
        F.sum("characters").cast("bigint").alias("characters"),
        F.bit_xor("content").alias("content"),
    )


@query(
    "read_sources",
    """SELECT * FROM (SELECT lang AS source, true AS ok, count(*)::BIGINT AS rows FROM documents
       GROUP BY lang) UNION ALL SELECT 'absent', false, 0""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A source for each language there is, and one that is not there."""
    path = _path(spark, "sources")
    texts = table(spark, folder, "documents").select("lang", F.col("text").alias("instruction"))
    texts.write.partitionBy("lang").json(path)
    names = [r.lang for r in texts.select("lang").distinct().collect()]  # a source each
    found, status = readers.read_sources(
        spark, {n: f"{path}/lang={n}" for n in names} | {"absent": f"{path}/lang=absent"}, "json"
    )
    rows = readers.union_sources([readers.as_instructions(df, n) for n, df in found.items()])
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    return status.join(counts, "source", "left").select(
        "source", "ok", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows")
    )


@query(
    "registry_read",
    """WITH pairs AS (SELECT DISTINCT source, lang FROM documents)
       SELECT 'dataset' AS section, lang || '/' || source AS name,
              concat_ws('|', lang || '-' || source, 'mit', lang IN ('en', 'de'), 'text') AS entry FROM pairs
       UNION ALL SELECT 'mix', lang || '-all', 'all of ' || lang || '|'
              || string_agg(lang || '/' || source, ',' ORDER BY source) FROM pairs GROUP BY lang
       UNION ALL SELECT 'suite', lang || '-suite', string_agg('b-' || lang || source, ',' ORDER BY source)
              FROM pairs GROUP BY lang
       UNION ALL SELECT 'benchmark', 'b-' || lang || source,
              concat_ws('|', lang || '-' || source, 'cc', true, 'acc', 'task_' || source, source = 'src1') FROM pairs""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A registry file for each language, written and read: all four of its tables."""
    path = _path(spark, "registry")
    lang, source = F.col("lang"), F.col("source")
    key, bench, name = F.concat(lang, F.lit("/"), source), F.concat(F.lit("b-"), lang, source), F.concat(lang, F.lit("-"), source)
    pairs = table(spark, folder, "documents").select("source", "lang").distinct()
    entry = F.struct(
        source,
        F.struct(
            key.alias("key"), name.alias("dataset_id"), F.lit("mit").alias("license"),
            lang.isin("en", "de").alias("commercial_use"), F.lit("text").alias("kind"),
        ).alias("dataset"),
        F.struct(
            bench.alias("key"), name.alias("dataset_id"), F.lit("cc").alias("license"), F.lit(True).alias("eval_only"),
            F.lit("acc").alias("metric"), F.concat(F.lit("task_"), source).alias("harness_task"),
            # Left out where no judge is needed.
            F.when(source == "src1", F.lit(True)).alias("judge_required"),
        ).alias("benchmark"),
    )
    # A registry has an entry for each source of a language.
    entries = pairs.groupBy("lang").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    keys = F.transform("e", lambda e: e["dataset"]["key"])
    entries.select(
        "lang",
        F.transform("e", lambda e: e["dataset"]).alias("datasets"),
        F.create_map(
            F.concat(lang, F.lit("-all")),
            F.struct(F.concat(F.lit("all of "), lang).alias("description"), keys.alias("datasets")),
        ).alias("mixes"),
        F.transform("e", lambda e: e["benchmark"]).alias("benchmarks"),
        F.create_map(F.concat(lang, F.lit("-suite")), F.transform("e", lambda e: e["benchmark"]["key"])).alias("suites"),
    ).write.partitionBy("lang").json(path)
    mixes_, datasets, suites, benchmarks = readers.read_registry(spark, path)

    def rows(section: str, found: DataFrame, name: str, *columns: Column) -> DataFrame:
        said = F.concat_ws("|", *[c.cast("string") for c in columns])
        return found.select(F.lit(section).alias("section"), F.col(name).alias("name"), said.alias("entry"))

    return (
        rows("dataset", datasets, "key", *[F.col(c) for c in ("dataset_id", "license", "commercial_use", "kind")])
        .unionByName(rows("mix", mixes_, "mix", F.col("description"), F.array_join("datasets", ",")))
        .unionByName(rows("suite", suites, "suite", F.array_join("benchmarks", ",")))
        .unionByName(
            rows("benchmark", benchmarks, "key", *[
                F.col(c) for c in ("dataset_id", "license", "eval_only", "metric", "harness_task", "judge_required")
            ])
        )
    )


@query(
    "render_hook",
    ORACLES["render_rows"].replace(
        "md5(instruction || chr(10) || output)",
        "md5((length(instruction) + length(output) + 1) || ':' || instruction || chr(10) || output)",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """texts rendered by a vectorised function of the caller."""

    @F.arrow_udf("string")
    def with_length(texts: pa.Array) -> pa.Array:
        return pc.binary_join_element_wise(pc.utf8_length(texts).cast(texts.type), texts, ":")

    def render(messages: Column) -> Column:
        return with_length(render_plain(messages))

    rendered = mixes.render_rows(instruction_rows(spark, folder), render, keep=["row_id"])
    plain = F.length(F.substring_index("text", ":", 1)) + 1
    return rendered.filter(
        (F.length("text") - plain).between(mixes.DEFAULT_MIN_CHARS, mixes.DEFAULT_MAX_CHARS)
    ).select("row_id", F.md5("text").alias("text_md5"))
