"""Nearest neighbours by inner product: inverted lists, scanned dimension by dimension.

Vectors are lengthened by one part so that the largest inner product is the smallest
distance, and rotated at random. Lists are around centres fitted to a bounded sample; every
vector is in one list. Within a list vectors lie in blocks of columns: after each block a
candidate whose partial distance says, at the chosen confidence, that it cannot be among
the nearest is given up, and only survivors see the next columns. What survives all is
scored exactly, on the original vectors in double precision.

The first scan is of a query's own list, for a bound; the second is of the other lists it
probes, against that bound. Lists and their queries are dealt into chunks, a task holds one
chunk of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.shared import staged
from meterloom.llm.vectors import matrix, rotation, valid

SAMPLE = 20_000  # vectors that centres are fitted to, at most
MOST_LISTS = 4096
PROBED = 0.8  # part of the lists that a query probes
COLUMNS = 16
CONFIDENCE = 2.1  # of the test: larger gives up later
CHUNK = 4096
QUERIES = 1024
AT_ONCE = 64  # queries of a chunk
PAIRS = 1 << 14
SEED = 5


def lengthened(rows: np.ndarray, most: float, query: bool) -> np.ndarray:
    """Vectors with one more part: distances then fall as inner products rise."""
    wide = rows.astype(np.float64)
    squares = (wide * wide).sum(axis=1)
    if query:
        out = wide / np.sqrt(squares)[:, None]
        return np.concatenate([out, np.zeros((len(out), 1))], axis=1)
    rest = np.sqrt(np.maximum(1 - squares / most**2, 0))
    return np.concatenate([wide / most, rest[:, None]], axis=1)


def fitted_centres(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm on the sample."""
    random = np.random.default_rng(SEED)
    centres = sample[random.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(rounds):
        of = nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, sample)
        counts = np.bincount(of, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres * centres).sum(axis=1) - 2 * rows @ centres.T


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate(
        [_distances(rows[a : a + 4096], centres).argmin(axis=1) for a in range(0, len(rows), 4096)]
        or [np.zeros(0, np.int64)]
    )


def survivors(rows: np.ndarray, queries: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which rows (second axis) the partial distances to each query do not rule out.

    After d of D rotated dimensions, the squared distance so far times D / d is held
    against the bound, widened by the confidence over the square root of d. A product of
    matrices gives the distances in a block of columns; rows and queries of which all is
    given up do not see the next block.
    """
    dimension = rows.shape[1]
    alive = np.ones((len(queries), len(rows)), bool)
    asked, left = np.arange(len(queries)), np.arange(len(rows))
    partial, here = np.zeros(alive.shape), alive
    for at in range(0, dimension, COLUMNS):
        seen = min(at + COLUMNS, dimension)
        q, r = queries[asked, at:seen], rows[left, at:seen]
        partial -= 2 * (q @ r.T)
        partial += (q * q).sum(axis=1)[:, None]
        partial += (r * r).sum(axis=1)
        slack = 1.0 if seen == dimension else (1 + CONFIDENCE / math.sqrt(seen)) ** 2
        most = (bounds[asked] * slack * (1 + 1e-9) + 1e-12) * (seen / dimension)
        here = here & (partial <= most[:, None])
        some, others = here.any(axis=1), here.any(axis=0)
        if not (some.all() and others.all()):
            gone = np.zeros(alive.shape, bool)
            gone[np.ix_(asked[some], left[others])] = here[np.ix_(some, others)]
            alive, asked, left = gone, asked[some], left[others]
            partial, here = partial[np.ix_(some, others)], here[np.ix_(some, others)]
        if not here.size:
            return np.zeros(alive.shape, bool)
    alive[np.ix_(asked, left)] = here
    return alive


def _best(queries: pd.DataFrame, rows: pd.DataFrame, most: float, k: int) -> pd.DataFrame:
    """The k nearest rows of a chunk for each query, those behind its bound left out."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [
        (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    ]
    if len(queries) and len(rows):
        original = np.stack(rows["v"].to_numpy())
        turn = rotation(original.shape[1] + 1, SEED).T
        placed = lengthened(original, most, False) @ turn
        wide, ids = original.astype(np.float64), rows["id"].to_numpy()
        asked = np.stack(queries["v"].to_numpy())
        turned, asked = lengthened(asked, most, True) @ turn, asked.astype(np.float64)
        names, bounds = queries["id"].to_numpy(), queries["bound"].to_numpy(np.float64, na_value=np.inf)
        for at in range(0, len(asked), AT_ONCE):
            some = slice(at, at + AT_ONCE)
            bound = np.where(np.isnan(bounds[some]), np.inf, bounds[some])
            if len(ids) > 4 * k and np.isinf(bound).any():
                # No bound yet: the distances of a first few rows give one.
                few, new = placed[: 4 * k], np.flatnonzero(np.isinf(bound))
                apart = _distances(turned[some][new], few) + (turned[some][new] ** 2).sum(axis=1)[:, None]
                bound[new] = np.partition(apart, k, axis=1)[:, k]
            of, row = np.nonzero(survivors(placed, turned[some], bound))
            other = ids[row] != names[some][of]
            of, row = of[other], row[other]
            score = np.concatenate([
                (wide[row[a : a + PAIRS]] * asked[some][of[a : a + PAIRS]]).sum(axis=1)
                for a in range(0, max(len(row), 1), PAIRS)
            ])
            order = np.lexsort((ids[row], -score, of))
            of, row, score = of[order], row[order], score[order]
            place = np.arange(len(of)) - np.searchsorted(of, of)
            out.append((names[some][of][place < k], ids[row][place < k], score[place < k]))
    query_id, vec_id, score = (np.concatenate(column) for column in zip(*out))
    return pd.DataFrame({"query_id": query_id, "vec_id": vec_id, "score": score})


def _scan(asked: DataFrame, rows: DataFrame, most: float, k: int) -> DataFrame:
    """Every chunk of a list against every chunk of the queries that probe it."""
    chunks = rows.groupBy("list").agg(F.max("chunk").alias("chunks"))
    askers = asked.groupBy("list").agg(F.count(F.lit(1)).alias("n")).select(
        "list", F.expr(f"cast(ceil(n / {QUERIES}) as int) - 1").alias("askers")
    )
    left = (
        asked.join(chunks, "list").join(askers, "list")
        .withColumn("asker", F.pmod(F.xxhash64("id"), F.col("askers") + 1).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks"))))
        .select("list", "chunk", "asker", "id", "v", "bound")
    )
    right = (
        rows.join(askers, "list")
        .withColumn("asker", F.explode(F.sequence(F.lit(0), F.col("askers"))))
        .select("list", "chunk", "asker", "id", "v")
    )
    by = ("list", "chunk", "asker")
    return (
        left.groupBy(*by)
        .cogroup(right.groupBy(*by))
        .applyInPandas(
            lambda q, r: _best(q, r, most, k), "query_id bigint, vec_id bigint, score double"
        )
    )


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    df: DataFrame, queries: DataFrame, identity: str, vector: str, k: int = 20
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's ``k`` nearest.

    Every row of ``df`` is indexed; a query is not its own candidate; ties go to the smaller
    id. Vectors that are null, empty, zero or not finite take no part, nor do those of
    another length than the commonest. A query with fewer than ``k`` candidates in the
    lists it probes is answered with those found; with one list, with all there are. Rows
    that repeat an id are separate candidates. An empty table gives no rows.
    """
    good = valid(df, identity, vector).withColumn("n", F.size("v"))
    sizes = good.groupBy("n").count().orderBy(F.desc("count"), "n").first()
    asked = valid(queries, identity, vector)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not sizes:
        return df.sparkSession.createDataFrame([], schema)
    dimension, total = sizes["n"], sizes["count"]
    good = good.filter(F.col("n") == dimension)
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    most = math.sqrt(good.agg(F.max(length)).first()[0])
    lists = max(1, min(MOST_LISTS, round(math.sqrt(total) / 2), total // (2 * k)))
    part = min(1.0, 1.2 * SAMPLE / total)
    # A bounded sample, whole if small: centres decide which list a row is in, not whether.
    sample = good.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(part * (1 << 20)) + 1).limit(SAMPLE)
    centres = fitted_centres(
        lengthened(np.stack(sample.select("v").toPandas()["v"].to_numpy()), most, False), lists
    )
    probed = max(1, math.ceil(PROBED * len(centres)))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("v"))
            of = nearest(lengthened(rows, most, False), centres) if len(rows) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(of.astype(np.int32)), batch.column("id"), batch.column("v")],
                ["list", "id", "v"],
            )

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for batch in batches:
            rows = matrix(batch.column("v"))
            order = (
                _distances(lengthened(rows, most, True), centres).argsort(axis=1)[:, :probed]
                if len(rows)
                else np.zeros((0, probed))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(order.astype(np.int32).tolist(), kind)],
                ["id", "v", "lists"],
            )

    index = staged(
        good.select("id", "v").mapInArrow(listed, "list int, id bigint, v array<float>"), "lists"
    )
    counts = index.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    rows = index.join(counts, "list").select(
        "list",
        F.pmod(F.xxhash64("id"), F.expr(f"cast(ceil(n / {CHUNK}) as int)")).cast("int").alias("chunk"),
        "id",
        "v",
    )
    near = staged(
        asked.filter(F.size("v") == dimension)
        .select("id", "v")
        .mapInArrow(probes, "id bigint, v array<float>, lists array<int>"),
        "probes",
    )
    at_home = near.select(
        F.col("lists")[0].alias("list"), "id", "v", F.lit(None).cast("double").alias("bound")
    )
    home = staged(_scan(at_home, rows, most, k), "home")
    # The distance that belongs to the k-th score at home, if there are as many.
    kth = (
        _first(home, k)
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
        .filter(F.col("n") >= k)
        .select(F.col("query_id").alias("id"), "low")
    )
    norm = F.sqrt(length)
    others = (
        near.join(kth, "id", "left")
        .select(
            F.explode(F.slice("lists", 2, max(probed - 1, 1))).alias("list"),
            "id",
            "v",
            (2 - 2 * F.col("low") / (F.lit(most) * norm)).alias("bound"),
        )
    )
    found = home.unionByName(_scan(others, rows, most, k))
    return _first(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
