"""Block-wise operators against brute force, on groups of very different sizes."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterloom.operators.ordered import (
    measured,
    take_first,
    with_group_facts,
    with_neighbour,
    with_position,
)
from meterloom.operators.quantiles import bucket_of, exact_quantiles


@pytest.fixture(scope="module")
def rows():
    """A hot group with half of the rows, gaps in the positions, nulls among the values."""
    rng = random.Random(3)
    made = []
    for position in sorted(rng.sample(range(3000), 900)):
        group = "hot" if rng.random() < 0.5 else f"g{rng.randint(0, 40)}"
        made.append((group, position, None if rng.random() < 0.1 else rng.randint(0, 30)))
    return made


@pytest.fixture(scope="module")
def frame(spark, rows):
    shuffled = random.Random(1).sample(rows, len(rows))
    return spark.createDataFrame(shuffled, "g string, p long, v int").repartition(5)


def groups_of(rows):
    found = {}
    for group, position, value in rows:
        found.setdefault(group, []).append((position, value))
    return found


@pytest.mark.parametrize("block_rows", [1, 64, 100_000])
@pytest.mark.parametrize("ahead", [False, True])
def test_neighbours(frame, rows, block_rows, ahead):
    df = with_neighbour(frame, ["g"], "p", "n", F.col("v"), ahead=ahead, block_rows=block_rows)
    got = {(r.g, r.p): r.n for r in df.collect()}
    expected = {}
    for group, members in groups_of(rows).items():
        for i, (position, _) in enumerate(members):
            j = i + 1 if ahead else i - 1
            expected[group, position] = members[j][1] if 0 <= j < len(members) else None
    assert got == expected


def test_group_facts(frame, rows):
    facts = {"lo": ("min", F.col("v")), "hi": ("max", F.col("p")), "all": ("sum", F.col("v"))}
    df = with_group_facts(frame, ["g"], facts)
    assert df.count() == len(rows)
    by_group = groups_of(rows)
    for row in df.collect():
        known = [v for _, v in by_group[row.g] if v is not None]
        assert row.hi == by_group[row.g][-1][0]
        assert (row.lo, row["all"]) == ((min(known), sum(known)) if known else (None, None))


@pytest.mark.parametrize("n", [1, 7, 60, 5000])
@pytest.mark.parametrize("width", [1, 50, 10_000])
def test_first_rows_of_every_group(frame, rows, n, width):
    got = take_first(frame, n, ["p"], F.expr(f"p div {width}L"), ["g"])
    expected = [(g, p) for g, members in groups_of(rows).items() for p, _ in members[:n]]
    assert sorted((r.g, r.p) for r in got.collect()) == sorted(expected)


def test_first_rows_overall(frame, rows):
    got = take_first(frame, 123, ["p"], F.expr("p div 100L"))
    assert sorted(r.p for r in got.collect()) == [p for _, p, _ in rows][:123]


SPACINGS = {
    "dense": lambda rng, n: list(range(n)),
    "hashed": lambda rng, n: [rng.randrange(-(1 << 63), 1 << 63) for _ in range(n)],
    "microseconds": lambda rng, n: [1_700_000_000_000_000 + int(rng.expovariate(1e-6) * i) for i in range(n)],
    "numbered by task": lambda rng, n: [(i % 40 << 33) + i // 40 for i in range(n)],
    "one far away": lambda rng, n: [*range(n - 1), 1 << 62],
    "two heaps": lambda rng, n: [rng.choice((-(1 << 62), 1 << 62)) + i for i in range(n)],
}


@pytest.mark.parametrize("spacing", SPACINGS)
def test_blocks_are_even_and_in_order_at_any_spacing(spark, spacing):
    rng = random.Random(7)
    places = SPACINGS[spacing](rng, 20_000)
    # Two thirds of the rows in one group.
    rows = [("hot" if rng.random() < 0.67 else f"g{i % 9}", p) for i, p in enumerate(places)]
    df = spark.createDataFrame(rows, "g string, p bigint").repartition(5)
    cuts = measured(df, "p", 200)
    found = df.select("g", "p", cuts.block(F.col("p")).alias("b")).orderBy("p").collect()
    blocks = [r.b for r in found]
    assert blocks == sorted(blocks)
    sizes = {}
    for r in found:
        sizes[r.g, r.b] = sizes.get((r.g, r.b), 0) + 1
    # A piece has 313 rows; where they lie in heaps, all may be in one block.
    assert max(sizes.values()) <= 3 * 200
    neighbours = with_neighbour(df, ["g"], "p", "n", F.col("p"), cuts=cuts).collect()
    members = groups_of([(g, p, None) for g, p in sorted(rows, key=lambda r: r[1])])
    expected = {(g, b[0]): a[0] if a else None for g, m in members.items() for a, b in zip([None, *m], m)}
    if len({(g, p) for g, p in rows}) == len(rows):
        assert {(r.g, r.p): r.n for r in neighbours} == expected


def test_positions_count_up_without_gaps(spark):
    df = with_position(spark.range(0, 1000, 1, 7).filter("id % 3 = 0"))
    got = sorted((r.id, r.position) for r in df.collect())
    assert got == [(3 * i, i) for i in range(334)]


@pytest.mark.parametrize("rank", ["linear", "lower"])
@pytest.mark.parametrize("steps", [1, 1 << 16])
def test_quantiles(frame, rows, rank, steps):
    qs = (0.0, 0.37, 0.5, 0.95, 1.0)
    df = exact_quantiles(frame, ["g"], "v", qs, rank=rank, steps=steps)
    got = {(r.g, r.q): r["quantile"] for r in df.collect()}
    for group, members in groups_of(rows).items():
        known = sorted(v for _, v in members if v is not None)
        for q in qs:
            if not known:
                assert (group, q) not in got
                continue
            method = "linear" if rank == "linear" else "lower"
            assert got[group, q] == pytest.approx(np.quantile(known, q, method=method))


@pytest.mark.parametrize("rank", ["linear", "lower"])
def test_close_values_are_cut_until_few_are_left(spark, rank):
    """Half of the values lie within a millionth, and half of these within 1e-12."""
    rng = random.Random(9)
    made = [1 + rng.random() * 1e-6 for _ in range(1500)] + [1 + 5e-7 + rng.random() * 1e-12 for _ in range(1500)]
    made += [rng.gauss(0, 100) for _ in range(600)] + [1.0] * 50
    rows = [("a", v) for v in made] + [("b", v) for v in made[:700]]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    qs = (0.0, 0.1, 0.25, 0.5, 0.51, 0.9, 1.0)
    found = exact_quantiles(df, ["g"], "v", qs, rank=rank, steps=16, most=20)
    got = {(r.g, r.q): r["quantile"] for r in found.collect()}
    for g, values in (("a", made), ("b", made[:700])):
        for q in qs:
            assert got[g, q] == pytest.approx(np.quantile(values, q, method=rank), rel=1e-15)


def test_quantiles_of_the_whole_table(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "v double")
    assert [(r.q, r.n, r["quantile"]) for r in exact_quantiles(df, [], "v", [0.5]).collect()] == [(0.5, 101, 50.0)]


def test_buckets_keep_the_order_of_doubles(spark):
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, 1e-310, 2.0**-30, 1 - 2**-53, 1 + 2**-52, 1.5, 2.0]
    values += [-x for x in values] + [1e308, -1e308, float("inf"), float("-inf"), float("nan")]
    values += [1.1**k for k in range(-200, 200)]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    found = [r.b for r in df.select("v", bucket_of(F.col("v")).alias("b")).orderBy("v").collect()]
    assert found == sorted(found)
