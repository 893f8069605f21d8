"""Quality by ordinal regression: hashed text features, ordered thresholds.

A text has one score, the weighted sum of its hashed features; P(grade <= k) is the logistic
function of the k-th threshold minus the score, so all grades share the weights and differ
in thresholds only, which rise. The model gives the expected grade and the probability of
each grade or better.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm.shared import checkpointed, received, send, sliced, text_bytes
from meterloom.llm.shingles import words

EXAMPLES = 20_000  # labelled rows that a model is fitted to, at most
SIZE = 1 << 16
ROUNDS = 120
PENALTY = 2e-5
FACTS = 9
STEPS = 8


def _facts(data: np.ndarray, ends: np.ndarray, h: np.ndarray, starts: np.ndarray,
           stops: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows, FACTS) numbers in 0 .. 1 about the shape of each text."""

    def per_row(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[ends[1:]] - sums[ends[:-1]]).astype(np.float64)

    n = np.maximum(np.diff(ends), 1).astype(np.float64)
    count = np.diff(bounds)
    row = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((h, row))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct = np.bincount(row[order][new], minlength=len(count))
    letters = np.bincount(row, stops - starts, minlength=len(count))
    some = np.maximum(count, 1)
    lower = (data >= 97) & (data <= 122)
    upper = (data >= 65) & (data <= 90)
    marks = (data > 32) & (data < 127) & ~lower & ~upper
    digits = (data >= 48) & (data <= 57)
    return np.stack(
        [
            np.minimum(np.log2(1 + count) / 16, 1),
            distinct / some,
            np.minimum(letters / some / 20, 1),
            per_row(marks) / n,
            per_row(digits) / n,
            per_row(upper) / n,
            np.minimum(20 * per_row(data == 10) / n, 1),
            per_row(data >= 128) / n,
            per_row(data == 124) / n,
        ],
        axis=1,
    )


def hashed(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the features: words by 1 + log of their count, to length 1,
    and the step that each fact of the text is on."""
    h, starts, stops, bounds = words(data, ends)
    rows = len(ends) - 1
    row = np.repeat(np.arange(rows), np.diff(bounds))
    column = (h >> np.uint64(40)).astype(np.int64) % (SIZE - FACTS * (STEPS + 1)) + FACTS * (STEPS + 1)
    cell, times = np.unique(row * SIZE + column, return_counts=True)
    value = 1 + np.log(times)
    length = np.sqrt(np.bincount(cell // SIZE, value * value, rows))
    facts = _facts(data, ends, h, starts, stops, bounds)
    step = np.minimum(np.sqrt(facts) * STEPS, STEPS).astype(np.int64)
    fact_row = np.repeat(np.arange(rows), FACTS)
    fact_column = (step + np.arange(FACTS) * (STEPS + 1)).ravel()
    return (
        np.concatenate([cell // SIZE, fact_row]),
        np.concatenate([cell % SIZE, fact_column]),
        np.concatenate([value / np.maximum(length[cell // SIZE], 1e-9), np.ones(len(fact_row))]),
    )


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(rows, grades - 1): probabilities of grade 1 or better, 2 or better, .."""
        row, column, value = hashed(data, ends)
        score = np.bincount(row, value * self.weights[column], len(ends) - 1)
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def fit_arrays(
    row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int
) -> Ordinal:
    """Penalised likelihood by Adam; thresholds are a start and positive steps."""
    n = len(grade)
    weights, start, gaps = np.zeros(SIZE), -1.0, np.zeros(max(grades - 2, 0))
    moments = [[np.zeros_like(np.atleast_1d(p)), np.zeros_like(np.atleast_1d(p))] for p in (weights, start, gaps)]

    def thresholds() -> np.ndarray:
        return start + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])

    for at in range(1, ROUNDS + 1):
        cuts = np.concatenate([[-np.inf], thresholds(), [np.inf]])
        score = np.bincount(row, value * weights[column], n)
        with np.errstate(over="ignore"):
            below = 1 / (1 + np.exp(-(cuts[grade] - score)))
            up_to = 1 / (1 + np.exp(-(cuts[grade + 1] - score)))
        likely = np.maximum(up_to - below, 1e-12)
        slope_low, slope_high = below * (1 - below) / likely, up_to * (1 - up_to) / likely
        by_score = (slope_high - slope_low) / n
        by_cut = np.zeros(grades + 1)
        np.add.at(by_cut, grade, slope_low / n)
        np.add.at(by_cut, grade + 1, -slope_high / n)
        by_cut = by_cut[1:-1]
        later = np.cumsum(by_cut[::-1])[::-1]
        slopes = (
            np.bincount(column, value * by_score[row], SIZE) + PENALTY * weights,
            later[:1],
            later[1:] * np.exp(gaps),
        )
        moved = []
        for p, slope, m in zip((weights, start, gaps), slopes, moments):
            m[0] = 0.9 * m[0] + 0.1 * slope
            m[1] = 0.99 * m[1] + 0.01 * slope**2
            step = m[0] / (1 - 0.9**at) / (np.sqrt(m[1] / (1 - 0.99**at)) + 1e-9)
            moved.append(p - 0.1 * step)
        weights, start, gaps = moved[0], float(np.atleast_1d(moved[1])[0]), moved[2]
    return Ordinal(weights, thresholds())


def fit(docs: DataFrame, ratings: DataFrame, grades: int, learn: Column) -> Ordinal:
    """A model from at most ``EXAMPLES`` rated rows (those with the smallest hashes of ids).

    ``docs``: ``id``, ``text``; ``ratings``: ``id``, ``grade`` (0 .. grades - 1; others and
    nulls are left out). The features of the sample are gathered on the driver: their number
    is bounded by the sample and ``SIZE``. Without ratings all grades are alike.
    """
    usable = ratings.filter(learn & F.col("grade").between(0, grades - 1) & F.col("id").isNotNull())
    picked = checkpointed(
        usable.orderBy(F.xxhash64("id"), "id").limit(EXAMPLES).dropDuplicates(["id"])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            row, column, value = hashed(*text_bytes(batch.column("text")))
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("grade"),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(column[order].astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(value[order].astype(np.float32))),
                ],
                ["grade", "c", "x"],
            )

    found = (
        docs.join(F.broadcast(picked), "id")
        .select("text", F.col("grade").cast("int").alias("grade"))
        .mapInArrow(run, "grade int, c array<int>, x array<float>")
        .toArrow()
    )
    if not found.num_rows:
        return Ordinal(np.zeros(SIZE), np.log(np.arange(1, grades) / np.arange(grades - 1, 0, -1)))
    lists = found.column("c").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    return fit_arrays(
        np.repeat(np.arange(found.num_rows), sizes),
        lists.flatten().to_numpy(),
        found.column("x").combine_chunks().flatten().to_numpy(),
        found.column("grade").to_numpy(),
        grades,
    )


def graded(df: DataFrame, model: Ordinal, text: str = "text") -> DataFrame:
    """Add ``expected_grade`` and ``tails`` (of grade 1 or better, 2 or better, ..).

    Null and empty texts are texts without words: they are graded by their facts, alike.
    Equal texts are graded alike; an empty table stays empty; columns of these names are
    replaced.
    """
    df = df.drop("expected_grade", "tails")
    sent = send(df.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(sent)
        for batch in sliced(batches, text):
            tails = model.tails(*text_bytes(batch.column(text)))
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * tails.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(tails.sum(axis=1)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(tails.ravel())),
                ],
                [*batch.schema.names, "expected_grade", "tails"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, expected_grade double, tails array<double>")
