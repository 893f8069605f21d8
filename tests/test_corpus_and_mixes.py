from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from meterloom.functions.messages import to_messages
from meterloom.operators import checks, corpus, mixes
from meterloom.plans.corpus_job import prepare_corpus, write_corpus
from meterloom.sources.readers import registry_tables

ROWS = "row_id long, instruction string, input string, output string, source string"
GOOD = "한국어로 쓴 충분히 긴 답변"


def test_the_job_end_to_end(spark, tmp_path):
    raw = spark.createDataFrame(
        [
            (5, "질문", None, GOOD + " 하나", "s"),
            (3, "질문", "다른 입력", GOOD + " 하나.", "t"),
            (4, "질문", " 입력\n", GOOD + " 둘", ""),
            (6, "", "", "x", "t"),
        ],
        ROWS,
    )
    done = prepare_corpus(raw, system="도우미")
    write_corpus(done, str(tmp_path / "out"), str(tmp_path / "rejected"))
    records = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    # Rows 3 and 5 differ only in their input and in punctuation: the lower id survives.
    assert sorted(records, key=str) == sorted(
        [
            {
                "messages": [
                    {"role": "system", "content": "도우미"},
                    {"role": "user", "content": "질문\n\n다른 입력"},
                    {"role": "assistant", "content": GOOD + " 하나."},
                ],
                "source": "t",
            },
            {
                "messages": [
                    {"role": "system", "content": "도우미"},
                    {"role": "user", "content": "질문\n\n입력"},
                    {"role": "assistant", "content": GOOD + " 둘"},
                ]
            },
        ],
        key=str,
    )
    rejected = spark.read.json(str(tmp_path / "rejected")).collect()
    assert [(r.row_id, r.reasons) for r in rejected] == [(6, ["empty_instruction", "output_too_short"])]
    funnel = {r.source: (r.loaded, r.rejected, r.kept, r["unique"], r.duplicates) for r in done.funnel.collect()}
    assert funnel == {"s": (1, 0, 1, 0, 1), "t": (2, 1, 1, 1, 0), "": (1, 0, 1, 1, 0)}
    assert {r.reason: r.n for r in done.histogram.collect()} == {"empty_instruction": 1, "output_too_short": 1}


def test_the_result_does_not_depend_on_partitioning(spark):
    rows = [(i, f"질문 {i % 40}", "", f"{GOOD} {i % 40}", f"s{i % 3}") for i in range(300)]
    base = spark.createDataFrame(rows, ROWS)
    for parts in (1, 7):
        scored = corpus.score(base.repartition(parts))
        kept = corpus.dedup_exact(corpus.accepted(scored))
        assert sorted(r.row_id for r in kept.select("row_id").collect()) == list(range(40))


def test_scoring_runs_once_under_later_filters(spark):
    scored = corpus.score(spark.createDataFrame([(1, "a", "", "b", "s")], ROWS))
    plan = corpus.accepted(scored)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("output_echoes_instruction") == 1


def test_row_caps_agree(spark):
    rows = spark.range(100).withColumnRenamed("id", "row_id")
    assert corpus.cap_rows(rows, 0).count() == 100
    small = corpus.cap_rows(rows, 30)
    large = mixes.take_first(rows, 30, ["row_id"], F.expr("row_id div 8L"))
    assert sorted(small.collect()) == sorted(large.collect())


def messages(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    found = df.select(to_messages(df.schema).alias("m")).collect()
    return [None if r.m is None else [(t.role, t.content) for t in r.m] for r in found]


def test_conversations_come_first(spark):
    schema = "messages array<struct<role:string,content:string>>, instruction string, output string"
    rows = [
        ([("USER", "q"), ("narrator", "x"), ("bot", "a"), ("user", "  ")], "i", "o"),
        ([("user", "q")], "i", "o"),
        ([("user", "q"), None, ("bot", "a")], "i", "o"),
        ([], "i", "o"),
        (None, "i", None),
    ]
    assert messages(spark, rows, schema) == [
        [("user", "q"), ("assistant", "a")],
        None,
        None,
        [("user", "i"), ("assistant", "o")],
        None,
    ]


def test_sharegpt_spelling_and_fall_through(spark):
    schema = "conversation string, conversations array<struct<`from`:string,value:string>>, question string, context string, answer string"
    rows = [
        (None, [("human", "q"), ("gpt", "a")], None, None, None),
        ("text", [("human", "q"), ("gpt", "a")], "q2", "c", "a2"),
        ("text", None, "q2", "c", "a2"),
    ]
    # `conversations` outranks `conversation`; a string there falls through to the pair.
    assert messages(spark, rows, schema) == [
        [("user", "q"), ("assistant", "a")],
        [("user", "q"), ("assistant", "a")],
        [("user", "q2\n\nc"), ("assistant", "a2")],
    ]


def test_a_list_under_a_text_key_blocks_later_ones(spark):
    schema = "prompt array<string>, question string, answer string"
    assert messages(spark, [(["p"], "q", "a"), ([], "q", "a")], schema) == [
        None,
        [("user", "q"), ("assistant", "a")],
    ]


CONFIG = {
    "mixes": {
        "m": {"datasets": ["free", "nc", "unsaid"]},
        "bad": {"datasets": ["free", "ghost"]},
        "nc": {"datasets": ["nc", "unsaid"]},
    },
    "datasets": [
        {"key": "free", "dataset_id": "x/free", "license": "mit", "commercial_use": True},
        {"key": "nc", "dataset_id": "x/nc", "license": "cc-by-nc-4.0", "commercial_use": False},
        {"key": "unsaid", "dataset_id": "x/unsaid"},
    ],
}


def test_license_gate(spark):
    mix_table, datasets = registry_tables(spark, CONFIG)
    keys = lambda *a, **k: sorted(r.key for r in mixes.resolve_mix(mix_table, datasets, *a, **k).collect())
    assert keys("m") == ["free"]
    assert keys("m", allow_noncommercial=True) == ["free", "nc", "unsaid"]
    for name, error in (("ghost", KeyError), ("bad", KeyError), ("nc", ValueError)):
        with pytest.raises(error):
            mixes.resolve_mix(mix_table, datasets, name)


def test_samples_must_reach_every_source():
    assert mixes.per_source_share(10, 3) == 3
    with pytest.raises(ValueError):
        mixes.per_source_share(2, 3)
    with pytest.raises(RuntimeError):
        mixes.concat_parts([])


def test_the_seeded_order_ignores_partitioning(spark):
    rows = spark.range(200).withColumnRenamed("id", "row_id")
    first = [r.row_id for r in mixes.seeded_shuffle(rows.repartition(9)).collect()]
    assert first == [r.row_id for r in mixes.seeded_shuffle(rows.coalesce(1)).collect()]
    assert first != sorted(first)
    taken = sorted(r.row_id for r in mixes.take_shuffled(rows, 50).collect())
    assert taken == sorted(first[:50])


def test_overlong_conversations_are_dropped_before_they_are_gathered(spark):
    turns = [("long", i, "user", "x" * 50) for i in range(100)]
    turns += [("ok", 1, "gpt", "answer"), ("ok", 0, "human", "question"), ("ok", 2, "narrator", "z")]
    turns += [("single", 0, "user", "a long enough text")]
    df = spark.createDataFrame(turns, "conv_id string, turn long, role string, text string")
    found = mixes.assemble_turns(df, max_chars=500).collect()
    assert [(r.conv_id, r.text, r.n_chars) for r in found] == [("ok", "question\nanswer", 15)]


def test_checks(spark):
    ids = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    assert [tuple(r) for r in checks.duplicate_keys(ids, ["id"]).collect()] == [(2, 2)]
    other = spark.createDataFrame([(2,), (9,)], "bench long")
    assert [r.id for r in checks.shared_ids(ids, "id", other, "bench").collect()] == [2]
    assert sorted(str(r.id) for r in checks.without_shared(ids, "id", other, "bench").collect()) == ["1", "None"]
    assert [r.id for r in checks.dangling(ids, "id", other, "bench").collect()] == [1]


def test_license_drift(spark):
    declared = spark.createDataFrame(
        [("a", "x/a", "MIT"), ("b", "x/b", "mit"), ("c", "x/c", "mit"), ("d", "x/d", "unknown"), ("e", "x/e", "mit")],
        "key string, dataset_id string, license string",
    )
    observed = spark.createDataFrame(
        [("x/a", "mit"), ("x/b", "gpl"), ("x/c", "unspecified"), ("x/d", "mit")],
        "dataset_id string, license string",
    )
    found = {r.key: r.status for r in checks.license_drift(declared, observed).collect()}
    assert found == {"a": "ok", "b": "drift", "c": "unknown", "d": "unknown", "e": "missing"}
