from __future__ import annotations

import pytest

from meterloom.operators import logs

LINES = "file_id string, line_no long, line string"

STAMP = "(Planner pid=4021) ERROR 11-30 23:05:41 [orchard.py:77] "
SHORT = [
    "INFO 11-30 opening the pantry",
    "INFO 11-30 nine shelves counted",
    "(Picker_3) ERROR  the ladder is too short",
    "(Picker_3) LadderError: rung seven not supported by this wall. Take",
    "(Picker_3) the long ladder from the barn instead.",
    "(Picker_3) second rung",
    "(Cook pid=9) Traceback (most recent call last):",
    "(Cook pid=9) KitchenError: no apples came. Ask",
]
TRACE = (
    [STAMP + "Planner gave up on the harvest.", STAMP + "Traceback (most recent call last):"]
    + [f'{STAMP}  File "orchard/row_{i}.py", line {i}' for i in range(30)]
    + [STAMP, STAMP + "BasketError: Unsupported basket shape: hexagon"]
    + ["(Cook pid=9) KitchenError: the planner knows more."]
)
PLAIN = ["INFO calm", "GateError: stuck"] + [f"  hinge {i}" for i in range(40)]


def numbered(**files):
    return [(name, i + 1, line) for name, lines in files.items() for i, line in enumerate(lines)]


@pytest.fixture(scope="module")
def excerpts(spark):
    rows = numbered(short=SHORT, trace=TRACE, plain=PLAIN, fine=["INFO ready", "INFO serving"])
    df = spark.createDataFrame(rows, LINES).repartition(3)
    found = logs.error_excerpt(df).collect()
    return {r.file_id: r.excerpt for r in found}


def test_the_excerpt_starts_at_the_cause_and_ends_with_its_speaker(excerpts):
    assert excerpts["short"].split("\n") == [
        "ERROR  the ladder is too short",
        "LadderError: rung seven not supported by this wall. Take",
        "the long ladder from the barn instead.",
        "second rung",
        "",
    ]


def test_a_long_trace_keeps_both_ends(excerpts):
    lines = excerpts["trace"].rstrip("\n").split("\n")
    assert len(lines) == 29
    assert lines[0] == "Planner gave up on the harvest."
    assert lines[6] == "... 5 lines omitted ..."
    assert lines[-1] == "BasketError: Unsupported basket shape: hexagon"
    assert "Planner pid" not in excerpts["trace"] and "Cook" not in excerpts["trace"]


def test_an_unstamped_error_keeps_a_plain_window(excerpts):
    assert excerpts["plain"] == "".join(line + "\n" for line in PLAIN[1:29])


def test_a_log_without_errors_yields_nothing(excerpts):
    assert "fine" not in excerpts


def test_tail(spark):
    df = spark.createDataFrame(numbered(a=[f"l{i}" for i in range(50)], b=["x"]), LINES)
    texts = {r.file_id: r.excerpt for r in logs.tail_text(df, 40).collect()}
    assert texts == {"a": "".join(f"l{i}\n" for i in range(10, 50)), "b": "x\n"}


def test_status_changes(spark):
    rows = [("a", 1, "Queued", None), ("a", 2, "Queued", None), ("a", 3, None, None),
            ("a", 4, "Failed", " no\n\n quota\t" + "x" * 500), ("b", 2, "Failed", " ")]
    df = spark.createDataFrame(rows, "job string, poll long, status string, reason string")
    found = {(r.job, r.poll): (r.status, r.reason) for r in logs.status_changes(df).collect()}
    assert found == {
        ("a", 1): ("Queued", None), ("a", 3): ("?", None),
        ("a", 4): ("Failed", ("no quota " + "x" * 500)[:400]), ("b", 2): ("Failed", None),
    }


def test_first_sightings(spark):
    rows = [
        ("a", 1, "metric", "loss", None), ("a", 2, "metric", "loss", "1"),
        ("a", 3, "metric", "loss", "1"), ("a", 4, "tag", "mlflow.user", "u"),
        ("a", 5, "tag", "status", "ok"), ("a", 6, "metric", "", "1"),
    ]
    df = spark.createDataFrame(rows, "job string, poll long, channel string, name string, value string")
    found = {(r.name, r.shown): r.poll for r in logs.first_sightings(df).collect()}
    assert found == {("loss", logs.NO_VALUE_YET): 1, ("loss", "1"): 2, ("status", "ok"): 5}


def test_all_terminal(spark):
    schema = "job string, poll long, status string"
    rows = [("a", 1, "Running"), ("a", 2, "Completed"), ("b", 1, "Failed")]
    assert logs.all_terminal(spark.createDataFrame(rows, schema)).first().all_terminal
    rows += [("c", 1, "Running")]
    found = logs.all_terminal(spark.createDataFrame(rows, schema)).first()
    assert (found.jobs, found.terminal, found.all_terminal) == (3, 2, False)


@pytest.mark.parametrize(
    ("status", "body", "expected", "evidence"),
    [
        (200, "Logs can't be retrieved while creating", "withheld", False),
        (200, "There are no logs for this deployment at the moment.", "gone", False),
        (200, "'x' is not a valid enum value", "error", False),
        (200, "", "ok", True),
        (403, "no logs for this deployment", "error", False),
        (None, None, "error", False),
    ],
)
def test_log_reads(spark, status, body, expected, evidence):
    df = spark.createDataFrame([(status, body)], "status_code int, body string")
    found = logs.classify_log_reads(df).first()
    assert (found.status, found.is_evidence) == (expected, evidence)


def test_cluster_errors(spark):
    messages = [
        "(ClusterMinNodesExceedCoreQuota) Standard NCADSA100v4 family ... a quota of 24 cores",
        "ClusterMinNodesExceedCoreQuota",
        "InvalidPropertyValue: The value Standard_X for property vmSize",
        "  else  ",
    ]
    df = spark.createDataFrame([(m,) for m in messages], "message string")
    found = [(r.code, r.family, r.quota, r.sku) for r in logs.classify_cluster_errors(df).collect()]
    assert found == [
        ("ClusterMinNodesExceedCoreQuota", "NCADSA100v4", "24", None),
        ("ClusterMinNodesExceedCoreQuota", None, None, None),
        ("InvalidPropertyValue", None, None, "Standard_X"),
        ("Unknown", None, None, None),
    ]
