"""Frames in batch, and the same frames as a stream."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterloom.operators import logs, streams
from meterloom.streaming.frames import account_live
from meterloom.streaming.held import Held, use_rocksdb
from meterloom.streaming.polls import status_feed, watch_progress

FRAMES = "request_id string, seq long, ts timestamp, line string"
START = datetime(2024, 1, 1)


def frame(*deltas, finish=None, usage=None):
    chunk = {"choices": [{"delta": d, "finish_reason": finish} for d in deltas]}
    if usage is not None:
        chunk["usage"] = {"completion_tokens": usage}
    return "data: " + json.dumps(chunk)


def recorded(request, lines, at=0.0, step=0.1):
    return [
        (request, i, START + timedelta(seconds=at + i * step), line)
        for i, line in enumerate(lines)
    ]


OPEN, DONE = ": sent", "data: [DONE]"
CASES = {
    "reasoning": [OPEN, frame({"role": "assistant"}), frame({"reasoning": "a"}), frame({"reasoning": "b"}), DONE],
    "switching": [OPEN, frame({"reasoning": "a"}), frame({"reasoning_content": "b"}), frame({"content": "c"}), DONE],
    "billed": [OPEN, frame({"content": "a"}), frame(usage=7), frame(usage=0), DONE, frame({"content": "late"})],
    "nothing": [OPEN, frame({"role": "assistant"}), frame({"content": ""}), DONE],
    "unseen": [OPEN, frame({"novel": "x"}), frame(usage=3), DONE],
    "noise": [OPEN, "event: x", "data: {broken", frame({"content": "a"}), "", DONE],
    "cut": [OPEN, frame({"reasoning": "a"}, finish="length"), DONE],
    "cut late": [OPEN, frame({"reasoning": "a"}), frame({"content": "a"}, finish="length"), DONE],
    "two choices": [OPEN, frame({"content": "a"}, {"content": "b"}), DONE],
    "open": [OPEN, frame({"content": "a"})],
}
EXPECTED = {
    "reasoning": (2, 2, True, "thinking only"),
    "switching": (3, 3, True, "ok"),
    "billed": (1, 7, True, "ok"),
    "nothing": (0, 0, False, "empty"),
    "unseen": (0, 3, False, "billed but unseen"),
    "noise": (1, 1, True, "ok"),
    "cut": (1, 1, True, "cut before answer"),
    "cut late": (2, 2, True, "cut mid-answer"),
    "two choices": (2, 2, True, "ok"),
    "open": (1, 1, True, "ok"),
}


@pytest.fixture(scope="module")
def lines():
    made = [row for name, texts in CASES.items() for row in recorded(name, texts)]
    return random.Random(5).sample(made, len(made))


def test_batch(spark, lines):
    parsed = streams.before_done(streams.parse_frames(spark.createDataFrame(lines, FRAMES)))
    found = streams.diagnose(streams.account_streams(parsed)).collect()
    assert {r.request_id: (r.counted, r.output_tokens, r.ok, r.diagnosis) for r in found} == EXPECTED
    facts = {r.request_id: r for r in found}
    assert facts["reasoning"].ttft_s == pytest.approx(0.2)
    assert facts["reasoning"].e2e_s == pytest.approx(0.4)
    assert facts["nothing"].ttft_s is None
    assert facts["reasoning"].old_meter_blind and not facts["switching"].old_meter_blind
    assert facts["switching"].usage_tokens is None and facts["billed"].usage_tokens == 7
    assert not facts["open"].done


def test_cap_usage(spark, lines):
    parsed = streams.before_done(streams.parse_frames(spark.createDataFrame(lines, FRAMES)))
    used = streams.cap_usage(streams.account_streams(parsed), F.lit(10))
    facts = {r.request_id: (r.at_least, r.used_tokens, r.used_pct) for r in used.collect()}
    assert facts["billed"] == (False, 7, 70.0)
    assert facts["switching"] == (True, 3, None)


def drain(spark, folder, batches, schema, build):
    """Run a stream over the batches, one file and one micro-batch each; also the rows of state left."""
    use_rocksdb(spark)
    source, out = folder / "in", folder / "out"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
    stream = build(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source)))
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", str(folder / "state"))
        .trigger(availableNow=True)
        .start(str(out))
    )
    query.awaitTermination()
    left = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    return spark.read.schema(stream.schema).parquet(str(out)), left[-1]


CLOSING = [("closing", 0, START + timedelta(days=2), OPEN)]


@pytest.mark.parametrize("seed", [1, 2])
def test_the_stream_agrees_with_the_batch_under_any_dealing(spark, lines, tmp_path, seed):
    rng = random.Random(seed)
    dealt = [[] for _ in range(3)]
    for row in lines:
        rng.choice(dealt).append(row)
    # The last file moves the watermark past all that was sent and past the silence after it.
    live, _ = drain(
        spark, tmp_path, [*filter(None, dealt), CLOSING], FRAMES,
        lambda s: account_live(s, delay="1 hour", timeout_ms=60_000),
    )
    found = {r.request_id: r for r in streams.diagnose(live).collect()}
    assert {n: (r.counted, r.output_tokens, r.ok, r.diagnosis) for n, r in found.items()} == EXPECTED
    assert live.count() == len(EXPECTED)
    parsed = streams.before_done(streams.parse_frames(spark.createDataFrame(lines, FRAMES)))
    for row in streams.account_streams(parsed).collect():
        for column, value in row.asDict().items():
            assert getattr(found[row.request_id], column) == pytest.approx(value), (row.request_id, column)
    assert found["billed"].late_frames == 1 and not found["open"].done


def test_late_frames_are_dropped_and_counted_and_state_is_given_back(spark, tmp_path):
    first = recorded("r", [OPEN, frame({"content": "a"}), DONE])
    late = [("r", 9, START + timedelta(seconds=5), frame({"content": "late"}))]
    # What comes after the row was told, but before the request is forgotten.
    told = [("s", 0, START + timedelta(minutes=5), OPEN)]
    later = [("r", 10, START + timedelta(minutes=6), frame({"content": "later"}))]
    live, left = drain(
        spark, tmp_path, [first, late, told, later, CLOSING], FRAMES,
        lambda s: account_live(s, delay="30 seconds", timeout_ms=3_600_000),
    )
    assert [(r.counted, r.late_frames) for r in live.filter("request_id = 'r'").collect()] == [(1, 1)]
    assert [r.done for r in live.filter("request_id = 's'").collect()] == [False]
    # One held frame and one timer of the request that closed the stream.
    assert left <= 2


POLLS = "job string, poll long, ts timestamp, status string, reason string"


def polled(*rows):
    return [(j, p, START + timedelta(minutes=p), s, r) for j, p, s, r in rows]


LAST_POLL = [("closing", 0, START + timedelta(days=30), "Running", None)]


def test_status_feed_puts_polls_in_order_and_tells_reasons(spark, tmp_path):
    batches = [
        polled(("a", 2, "Running", None), ("a", 4, "Failed", " no\n\n room "), ("a", 4, "Failed", None)),
        polled(("a", 3, "Queued", None), ("a", 5, "Running", "x"), ("a", 1, "", None)),
        LAST_POLL,
    ]
    feed, left = drain(spark, tmp_path, batches, POLLS, lambda s: status_feed(s, delay="1 hour"))
    assert sorted((r.poll, r.status, r.previous, r.reason) for r in feed.collect()) == [
        (1, "?", None, None), (2, "Running", "?", None), (3, "Queued", "Running", None),
        (4, "Failed", "Queued", "no room"), (5, "Running", "Failed", None),
    ]
    assert left <= 2


def test_shuffled_polls_give_the_feed_of_the_batch_and_the_state_is_empty_at_the_end(spark, tmp_path):
    rng = random.Random(9)
    rows = []
    for job in ("a", "b", "c", "d"):
        states = [rng.choice(["Queued", "Running", "", "Running"]) for _ in range(15)] + ["Completed"]
        rows += polled(*[(job, p, s, None) for p, s in enumerate(states)])
    rng.shuffle(rows)
    feed, left = drain(
        spark, tmp_path, [rows[:20], rows[20:40], rows[40:], LAST_POLL], POLLS,
        lambda s: status_feed(s, delay="1 day"),
    )
    batch = logs.status_changes(spark.createDataFrame(rows, POLLS), block_rows=4)
    columns = ["job", "poll", "status", "previous"]
    assert sorted(map(tuple, feed.select(columns).collect()), key=str) == sorted(
        map(tuple, batch.select(columns).collect()), key=str
    )
    assert left <= 2
    assert [tuple(r) for r in watch_progress(feed).collect()] == [(4, 4, True)]
    # The same counts from the feed as a stream.
    query = (
        watch_progress(spark.readStream.schema(feed.schema).parquet(str(tmp_path / "out")))
        .writeStream.format("memory").queryName("progress").outputMode("complete")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [tuple(r) for r in spark.table("progress").collect()] == [(4, 4, True)]


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
def test_gaps(spark, block_rows):
    lines = recorded("r", [OPEN, frame({"content": "a"}), OPEN, frame({"content": "b"}), frame({"reasoning": "c"})])
    parsed = streams.parse_frames(spark.createDataFrame(lines, FRAMES))
    gaps = streams.chunk_gaps(parsed, block_rows=block_rows)
    assert [r.gap_s for r in gaps.orderBy("seq").collect()] == [None, pytest.approx(0.2), pytest.approx(0.1)]


def test_delta_keys(spark):
    lines = recorded("r", [OPEN, frame({"role": "assistant"}), *[frame({"reasoning": "x"})] * 4, "data: {broken", DONE])
    census = streams.delta_key_census(spark.createDataFrame(lines, FRAMES))
    assert {r.delta_key: r.n for r in census.collect()} == {"role": 1, "reasoning": 4}


@pytest.mark.parametrize("block_rows", [1, 2, 5, 1000])
def test_the_closing_tag_may_be_spread_over_chunks(spark, block_rows):
    rng = random.Random(11)
    rows, expected = [], {}
    for i in range(60):
        text = "".join(rng.choices(["a", "<", "/", "</thin", "k>", "</think>", "th"], k=12))
        chunks, rest = [], text
        while rest:
            cut = rng.randint(1, 4)
            chunks.append(rest[:cut])
            rest = rest[cut:]
        seqs = sorted(rng.sample(range(200), len(chunks)))
        rows += [(f"r{i}", s, c) for s, c in zip(seqs, chunks)]
        rows += [(f"r{i}", 500, "")]
        at = text.find("</think>")
        expected[f"r{i}"] = (text, "") if at < 0 else (text[: at + 8], text[at + 8 :])
    df = spark.createDataFrame(rows, "request_id string, seq long, text string").repartition(4)
    found = {}
    for r in streams.split_thinking(df, block_rows=block_rows).orderBy("seq").collect():
        thinking, content = found.get(r.request_id, ("", ""))
        found[r.request_id] = (thinking + r.thinking, content + r.content)
    assert found == expected


class Kept:
    """A list or value of the state, and how often the store was asked."""

    def __init__(self):
        self.rows, self.calls = [], 0

    def get(self):
        self.calls += 1
        return iter(list(self.rows))

    def appendList(self, rows):
        self.calls += 1
        self.rows += rows

    def put(self, rows):
        self.calls += 1
        self.rows = list(rows)

    def clear(self):
        self.put([])


def test_what_waits_for_the_watermark_is_held_packed_and_not_opened():
    class Told(Held):
        def fold(self, key, known, ready, now):
            return [r[0] for r in ready], None, None

    class Nothing(Kept):
        def get(self):
            super().get()
            return None

    told, timers = Told(), []
    told.held, told.known = Kept(), Nothing()
    told.handle = type("Handle", (), {"registerTimer": staticmethod(timers.append)})
    dealt = [[(3, 30), (1, 10)], [(4, 40)], [(2, 20)]]
    assert [list(told._advance(("k",), rows, 0)) for rows in dealt] == [[], [], []]
    # A piece and at most a timer a batch; two reads and a write.
    assert len(told.held.rows) == 3 and timers == [31, 41]
    assert told.held.calls + told.known.calls == 9
    assert list(told._advance(("k",), [], 35)) == [1, 2, 3]
    assert list(told._advance(("k",), [(5, 50)], 60)) == [4, 5] and told.held.rows == []
