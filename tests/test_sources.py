from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from meterloom.operators import reports, serving
from meterloom.plans.catalog import QUERIES
from meterloom.plans.serving_job import accounts_of, flat_report, summarise_sweep
from meterloom.session import stage
from meterloom.sources import readers, sinks

LEVEL = {
    "concurrency": 4, "requests": 8, "succeeded": 7, "failed": 1, "wall_s": 1.5,
    "ttft_p50": 0.1, "ttft_p95": 0.2, "ttft_p99": 0.3, "tpot_p50": 0.01, "tpot_p95": 0.02,
    "e2e_p50": 1.0, "e2e_p95": 1.2, "e2e_p99": 1.3, "output_tokens": 70,
    "output_tok_per_s": 46.67, "requests_per_s": 4.667, "errors": {"timeout": 1},
}
SWEEP = {
    "base_url": "http://x/v1", "model": "m", "max_tokens": 128, "chat_template_kwargs": None,
    "ttft_slo_s": 1.0, "levels": [LEVEL], "knee_concurrency": None, "peak_output_tok_per_s": 46.67,
}


def test_log_lines_are_numbered_per_file_across_splits(spark, tmp_path):
    texts = {"a.log": [f"line {i} " + "x" * 40 for i in range(3000)], "b.log": ["only"], "c.log": []}
    for name, lines in texts.items():
        (tmp_path / name).write_text("".join(line + "\n" for line in lines))
    (tmp_path / "d.log").write_bytes(b"bad \xff byte\r\nnext\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = readers.read_logs(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 1
        rows = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = {}
    for r in rows:
        found.setdefault(r.file_id.rsplit("/", 1)[1], {})[r.line_no] = r.line
    assert [found["a.log"][i + 1] for i in range(3000)] == texts["a.log"]
    assert found["b.log"] == {1: "only"}
    assert found["d.log"] == {1: "bad � byte", 2: "next"}


def test_reports_that_cannot_be_read_are_told_apart(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps(SWEEP, indent=2))
    (tmp_path / "bad.json").write_text("{ not json")
    good, bad = readers.read_reports(spark, str(tmp_path))
    assert [r.run_id for r in good.select("run_id").collect()] == ["good"]
    assert [tuple(r) for r in bad.collect()] == [("bad", "not a readable report")]
    none, why = readers.read_reports(spark, str(tmp_path / "missing"))
    assert none.count() == 0 and why.count() == 1


def test_a_sweep_report_flattens(spark, tmp_path):
    (tmp_path / "run.json").write_text(json.dumps(SWEEP))
    good, _ = readers.read_reports(spark, str(tmp_path))
    flat = {r.name: r.metric if r.tag is None else r.tag for r in reports.flatten_sweeps(good).collect()}
    assert flat["bench.c4.ttft_p95"] == 0.2
    assert flat["bench.c4.errors"] == '{"timeout":1}'
    assert flat["bench.knee_concurrency_none"] == reports.NO_KNEE
    assert "bench.knee_concurrency" not in flat and "bench.c4.concurrency" not in flat
    assert (flat["bench.levels"], flat["bench.failed_total"], flat["bench.model"]) == (1.0, 1.0, "m")
    flat = reports.flatten_sweeps(good)
    out = str(tmp_path / "out")
    sinks.publish(flat, out)
    other = flat.withColumn("run_id", F.lit("other"))
    sinks.publish(other, out)
    # Published again, without its tags: nothing of what it said before is left.
    sinks.publish(flat.filter("tag is null").withColumn("metric", F.col("metric") + 1), out)
    metrics, tags = sinks.published(spark, out)
    assert {r.run_id: r.metric for r in metrics.filter("name = 'bench.max_tokens'").collect()} == {"run": 129.0, "other": 128.0}
    assert metrics.count() == 2 * flat.filter("metric is not null").count()
    assert {r.run_id for r in tags.collect()} == {"other"}


def test_a_batch_that_broke_off_is_not_seen(spark, tmp_path):
    flat = spark.createDataFrame([("a", "m", 1.0, None), ("a", "t", None, "x")], "run_id string, name string, metric double, tag string")
    out = str(tmp_path / "out")
    sinks.publish(flat, out)
    flat.select("run_id", "name", F.lit(9.0).alias("metric")).write.parquet(f"{out}/metrics/batch=zzz")
    metrics, tags = sinks.published(spark, out)
    assert [r.metric for r in metrics.collect()] == [1.0] and tags.count() == 1


def test_deployment_comparisons_line_up_by_prompt(spark, tmp_path):
    reply = {"finish_reason": "stop", "completion_tokens": 5, "prompt_tokens": 1, "chars": 2,
             "reasoning_tokens": 0, "thinking_in_content": False, "content": "x"}
    report = {"max_tokens": 8, "temperature": 0.0, "prompts": ["p", "q"],
              "deployments": {"blue": [reply, {**reply, "completion_tokens": 8}], "green": [reply, reply]}}
    (tmp_path / "cmp.json").write_text(json.dumps(report))
    good, _ = readers.read_reports(spark, str(tmp_path), readers.COMPARISON_SCHEMA)
    pairs = serving.side_by_side(readers.comparison_replies(good), "blue", "green")
    assert [(r.prompt_no, r.token_diff) for r in pairs.orderBy("prompt_no").collect()] == [(0, 0), (1, 3)]


def test_questions_skip_blank_lines(spark, tmp_path):
    path = tmp_path / "q.jsonl"
    path.write_text('{"id": 7, "question": "a"}\n\n{"category": "c", "question": "b", "reference": "r"}\n')
    rows = readers.read_questions(spark, str(path)).orderBy("position").collect()
    assert [(r.id, r.category, r.question, r.reference, r.position) for r in rows] == [
        ("7", None, "a", None, 0), (None, "c", "b", "r", 1)
    ]


def test_unreadable_sources_are_reported_and_the_rest_goes_on(spark, tmp_path):
    spark.createDataFrame([("q", None)], "instruction string, output string").write.json(str(tmp_path / "s1"))
    rows, status = readers.read_instructions(spark, {"s1": str(tmp_path / "s1"), "gone": str(tmp_path / "s2")})
    assert [tuple(r) for r in rows.collect()] == [("q", "", "", "s1")]
    assert {r.source: r.ok for r in status.collect()} == {"s1": True, "gone": False}
    with pytest.raises(ValueError):
        readers.union_sources([])


def test_tables_and_paths(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert readers.read_table(spark, str(tmp_path / "t")).count() == 3
    spark.range(4).createOrReplaceTempView("four")
    assert readers.read_table(spark, "four").count() == 4


def test_benchmark_registry(spark):
    config = {"suites": {"s": ["k"]}, "benchmarks": [{"key": "k", "dataset_id": "x/k", "eval_only": True}]}
    suites, benchmarks = readers.benchmark_tables(spark, config)
    assert suites.first().benchmarks == ["k"]
    assert (benchmarks.first().dataset_id, benchmarks.first().judge_required) == ("x/k", False)


def test_staged_tables_cut_the_plan(spark):
    staged = stage(spark.range(5).withColumn("x", F.col("id") + 1), "t")
    assert staged.count() == 5
    assert "Range" not in staged._jdf.queryExecution().optimizedPlan().toString()


def test_documents_keep_unknowns_visible(spark, tmp_path):
    sinks.write_documents(spark.createDataFrame([("a", None)], "k string, v double"), str(tmp_path / "d"))
    assert spark.read.text(str(tmp_path / "d")).first().value == '{"k":"a","v":null}'


def test_frames_to_flat_report(spark):
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    lines = [": sent", 'data: {"choices":[{"delta":{"content":"a"}}]}', 'data: {"choices":[{"delta":{"content":"b"}}]}', "data: [DONE]"]
    frames = [
        (f"r{n}", i, start + timedelta(seconds=n + i * 0.5), line)
        for n in range(4)
        for i, line in enumerate(lines)
    ]
    requests = [(f"r{n}", "blue", 2, float(n)) for n in range(5)]
    results = accounts_of(
        spark.createDataFrame(frames, "request_id string, seq long, ts timestamp, line string"),
        spark.createDataFrame(requests, "request_id string, deployment string, concurrency int, start_s double"),
    )
    sweep = summarise_sweep(results, ttft_slo_s=1.0)
    level = sweep.levels.first()
    # The fifth request left no frame at all: it failed.
    assert (level.requests, level.succeeded, level.failed, level.ttft_p50) == (5, 4, 1, 0.5)
    flat = flat_report(sweep, model=F.lit("m"), base_url=F.lit(""), max_tokens=8, ttft_slo_s=1.0)
    found = {r.name: r.metric if r.tag is None else r.tag for r in flat.collect()}
    assert found["bench.c2.errors"] == '{"no tokens streamed":1}'
    assert found["bench.knee_concurrency_none"] == reports.NO_KNEE
    assert "bench.base_url" not in found


def test_the_questions_query_returns_every_question(spark, tmp_path):
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "c"), (2, 0, "user", "c"), (3, 2, "user", None)]
    spark.createDataFrame(turns, "conv_id bigint, turn int, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet")
    )
    found = QUERIES["read_questions"](spark, str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=str) == [
        ("q1-0", "a", 4), ("q2-0", "c", 4), ("q2-0", "c", 4), ("q3-2", None, 4)
    ]


def test_the_rendering_function_of_a_caller_stays_on_arrow_arrays(spark, tmp_path):
    asked = ["é" * i + "x" * 20 for i in range(5)]
    texts = [(i, f"{q}\nso ü", "en", "s", 0) for i, q in enumerate(asked)] + [(9, None, "en", "s", 0)]
    spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    found = QUERIES["render_hook"](spark, str(tmp_path))
    assert "], 200" not in found._jdf.queryExecution().toString()  # strings of pandas
    wanted = {i: hashlib.md5(f"{len(t)}:{t}".encode()).hexdigest() for i, t, *_ in texts if t}
    assert {r.row_id: r.text_md5 for r in found.collect()} == wanted
