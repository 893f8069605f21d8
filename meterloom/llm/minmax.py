"""Near-duplicate documents by min-max hashing.

A document is its set of distinct word shingles. Under each of ``PERMUTATIONS`` hash
functions both the smallest and the largest value are kept, so a signature of twice that
many values costs half the hash evaluations. Bands of signature values bring candidates
together; a link is confirmed on the full sets.

With bands of 6 values and 64 of them, a pair of similarity 0.75 shares no band in 4 of a
million cases; more similar pairs less often.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.llm.components import components
from meterloom.llm.shared import checkpointed, freed, sliced, staged, text_bytes
from meterloom.llm.shingles import mixed, shingle_sets

WORDS = 5
PERCENT = 75
BANDS = 64
PAIRS_IN_BAND = 3  # hash functions a band; two values of each
PERMUTATIONS = BANDS * PAIRS_IN_BAND
IDS_SENT = 2_000_000
SKETCH = 4  # numbers of 64 bits
# Bits of two sketches agree in (1 + similarity) / 2 of the cases: 224 of 256 at 0.75, with a
# standard deviation of 5.3. One pair in a million at 0.75 agrees in fewer than these.
LEAST_BITS = 198
CHUNK = 512
SLAB = 4096


def _functions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20_240_117)
    a = random.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a, random.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)


def min_max(sets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and largest value of each set (none empty) under each hash function."""
    a, b = _functions()
    x = (sets >> np.uint64(32)).astype(np.uint32)
    low = np.empty((PERMUTATIONS, len(starts)), np.uint32)
    high = np.empty_like(low)
    for p in range(PERMUTATIONS):
        y = x * a[p] + b[p]
        np.minimum.reduceat(y, starts, out=low[p])
        np.maximum.reduceat(y, starts, out=high[p])
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One 64-bit key a band and document: (documents, BANDS)."""
    key = np.zeros((BANDS, low.shape[1]), np.uint64)
    for k in range(PAIRS_IN_BAND):
        for side in (low, high):
            key = mixed(key * np.uint64(31) + side[k::PAIRS_IN_BAND].astype(np.uint64))
    return mixed(key + np.arange(BANDS, dtype=np.uint64)[:, None]).T


def sketches(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(SKETCH, documents): one bit of each of 256 values of a signature."""
    values = np.concatenate([low, high])[: 64 * SKETCH]
    bits = (mixed(values.astype(np.uint64)) & np.uint64(1)).reshape(SKETCH, 64, -1)
    return (bits << np.arange(64, dtype=np.uint64)[None, :, None]).sum(axis=1, dtype=np.uint64)


SIGNATURES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("f1", T.LongType()),
        T.StructField("f2", T.LongType()),
        *[T.StructField(f"s{i}", T.LongType()) for i in range(SKETCH)],
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def signatures(df: DataFrame) -> DataFrame:
    """``id``, size ``n``, a 128-bit fingerprint of the set, and its band keys (none if empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            sets, bounds = shingle_sets(*text_bytes(batch.column("text")), WORDS)
            n = np.diff(bounds)
            full = np.flatnonzero(n > 0)
            prints = np.zeros((2, len(n)), np.uint64)
            keys = np.zeros((0, BANDS), np.uint64)
            bits = np.zeros((SKETCH, len(n)), np.uint64)
            if len(full):
                starts = bounds[full]
                prints[0, full] = np.add.reduceat(mixed(sets), starts)
                prints[1, full] = np.add.reduceat(mixed(~sets), starts)
                both = min_max(sets, starts)
                keys, bits[:, full] = band_keys(*both), sketches(*both)
            ends = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(n),
                    pa.array(prints[0].view(np.int64)),
                    pa.array(prints[1].view(np.int64)),
                    *[pa.array(b.view(np.int64)) for b in bits],
                    pa.ListArray.from_arrays(
                        pa.array(ends), pa.array(np.ascontiguousarray(keys).view(np.int64).ravel())
                    ),
                ],
                SIGNATURES.names,
            )

    return df.mapInArrow(freed(run), SIGNATURES)


def full_sets(df: DataFrame) -> DataFrame:
    """``id`` and its sorted shingles, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            sets, bounds = shingle_sets(*text_bytes(batch.column("text")), WORDS)
            raw, cuts = sets.tobytes(), (8 * bounds).tolist()
            rows = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(rows, pa.binary())], ["id", "shingles"]
            )

    return df.mapInArrow(freed(run), "id bigint, shingles binary")


def sets_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """:func:`full_sets` of some documents.

    They are made anew for the ids in question only, which are sent to the readers of the
    texts if there are at most two million (16 MB), and joined by a shuffle if more.
    """
    ids = checkpointed(ids.select("id").distinct())
    wanted = F.broadcast(ids) if ids.count() <= IDS_SENT else ids
    return staged(full_sets(docs.join(wanted, "id", "left_semi")), "shingles")


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets reach the similarity."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    sets = sets_of(ids, docs)
    both = (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
        .select("a", "b", "x", "y")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = int(np.count_nonzero(y[at] == x))
                good.append(100 * shared >= PERCENT * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(freed(run), "a bigint, b bigint")


def _to_groups(left: DataFrame, labelled: DataFrame, docs: DataFrame) -> DataFrame:
    """A link ``a``, ``b`` for each document that reaches another component of two or more.

    ``left``: ``key``, ``component``, ``size`` of what shares a bucket. The smaller component of
    two that meet is compared, whole, with the whole larger one. Both are cut into chunks;
    a block of two chunks counts common shingles, and gives one link for a document at most.
    """
    met = left.select("key", "component", "size").distinct()
    large = met.filter("size > 1").select(
        F.col("key").alias("k"), F.col("component").alias("group"), F.col("size").alias("group_size")
    )
    order = "size < group_size or (size = group_size and component > group)"
    asked = met.join(
        large, F.expr(f"key = k and component <> group and ({order})")
    ).select("component", "group").distinct()
    outside = checkpointed(asked.join(labelled, "component").select("group", "id").distinct())
    inside = checkpointed(
        labelled.withColumnRenamed("component", "group").join(
            outside.select("group").distinct(), "group", "left_semi"
        )
    )
    sets = sets_of(outside.select("id").unionByName(inside.select("id")), docs)

    def chunks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("group").agg(F.expr(f"cast(ceil(count(*) / {CHUNK}) as int)").alias(name))

    def dealt(df: DataFrame, own: str, other: str, counts: DataFrame) -> DataFrame:
        return (
            df.join(counts, "group")
            .withColumn(own, F.pmod(F.xxhash64("id"), F.col(f"{own}s")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
            .join(sets, "id")
            .select("group", "p", "q", "id", "shingles")
        )

    def renewed(df: DataFrame) -> DataFrame:
        # Both sides read the same tables: columns of their own keep them apart.
        return df.toDF(*[f"_{c}" for c in df.columns]).toDF(*df.columns)

    counts = checkpointed(chunks(outside, "ps").join(chunks(inside, "qs"), "group"))
    by = ("group", "p", "q")
    return (
        dealt(outside, "p", "q", counts).groupBy(*by)
        .cogroup(renewed(dealt(inside, "q", "p", counts)).groupBy(*by))
        .applyInPandas(_reaching, "a bigint, b bigint")
    )


def _reaching(asked: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
    """The smallest of ``group`` that each of ``asked`` is similar enough to."""
    if not len(asked) or not len(group):
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    group = group.sort_values("id")
    sides = []
    for side in (asked, group):
        sets = [np.frombuffer(s, np.uint64) for s in side["shingles"]]
        sizes = np.array([len(s) for s in sets])
        sides.append((np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), sizes))
    shared = np.intersect1d(np.unique(sides[0][0]), np.unique(sides[1][0]))
    common = np.zeros((len(asked), len(group)), np.float32)
    for at in range(0, len(shared), SLAB):
        slab = shared[at : at + SLAB]
        tables = []
        for values, row, sizes in sides:
            place = np.minimum(np.searchsorted(slab, values), len(slab) - 1)
            hit = slab[place] == values
            table = np.zeros((len(sizes), len(slab)), np.float32)
            table[row[hit], place[hit]] = 1
            tables.append(table)
        common += tables[0] @ tables[1].T
    union = sides[0][2][:, None] + sides[1][2][None, :] - common.astype(np.int64)
    near = 100 * common.astype(np.int64) >= PERCENT * union
    some = near.any(axis=1)
    return pd.DataFrame(
        {
            "a": asked["id"].to_numpy()[some],
            "b": group["id"].to_numpy()[near.argmax(axis=1)[some]],
        }
    )


def near_duplicates(df: DataFrame, identity: str, text: str = "text") -> DataFrame:
    """``identity``, ``n_shingles``, ``component_id`` and ``kept`` of every document.

    Documents with equal sets are one class, found by fingerprint; only the smallest id of
    a class goes on, so copies cost nothing more. Every bucket of a band links its members
    to its smallest id, as far as the sets confirm it. What then still lies in different
    components of one bucket is judged directly: single documents with each other, where
    their signatures estimate a similarity in reach of the threshold, and everything with
    the larger components that it meets in a bucket, in blocks of both.

    Null and empty texts, and texts without words, have an empty set and no links. Rows
    that repeat an id are one document. An empty table gives an empty table.
    """
    docs = df.select(F.col(identity).alias("id"), F.col(text).alias("text"))
    seen = staged(signatures(docs), "signatures")
    filled = seen.filter("n > 0")
    # A table of its own, so that a large class can be split where it is joined.
    classes = staged(filled.groupBy("f1", "f2", "n").agg(F.min("id").alias("head")), "classes")
    heads = classes.select(F.col("head").alias("id"))
    rows = filled.join(heads, "id", "left_semi").select("id", "n", F.explode("bands").alias("key"))
    centres = (
        rows.groupBy("key")
        .agg(F.min(F.struct("id", "n")).alias("c"), F.max("id").alias("top"))
        .filter("c.id < top")
    )
    shared = staged(
        rows.join(centres, "key").select("key", "id", "n", "c"), "buckets"
    )
    fits = "least(n, m) * 100 >= greatest(n, m) * 75"
    tried = checkpointed(
        shared.select(F.col("c.id").alias("a"), F.col("id").alias("b"), "n", F.col("c.n").alias("m"))
        .filter(f"a < b and {fits}")
        .select("a", "b")
        .distinct()
    )
    links = checkpointed(confirmed(tried, docs))
    reached = components(links)
    labelled = checkpointed(
        shared.select("id").distinct().join(reached, "id", "left").select(
            "id", F.coalesce("component", "id").alias("component")
        )
    )
    # Buckets that still hold several components.
    rows = shared.select("key", "id", "n").join(labelled, "id")
    open_keys = rows.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).filter("low < high").select("key")
    sizes = labelled.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    left = staged(rows.join(open_keys, "key", "left_semi").join(sizes, "component"), "open")
    names = [f"s{i}" for i in range(SKETCH)]
    single = left.filter("size = 1").join(
        filled.select("id", *names).dropDuplicates(["id"]), "id"
    )
    other = single.select(
        F.col("key").alias("k"), F.col("id").alias("b"), F.col("n").alias("m"),
        *[F.col(c).alias(f"t{i}") for i, c in enumerate(names)],
    )
    alike = " + ".join(f"64 - bit_count(s{i} ^ t{i})" for i in range(SKETCH))
    more = checkpointed(
        single.withColumnRenamed("id", "a")
        .join(other, F.expr(f"key = k and a < b and {fits} and {alike} >= {LEAST_BITS}"))
        .select("a", "b")
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    links = (
        links.unionByName(confirmed(more, docs)).unionByName(_to_groups(left, labelled, docs))
    )
    reached = checkpointed(components(links))
    return (
        seen.select("id", "n", "f1", "f2")
        .join(classes, ["f1", "f2", "n"], "left")
        .withColumn("head", F.coalesce("head", "id"))
        .join(reached.withColumnRenamed("id", "head"), "head", "left")
        .select(
            F.col("id").alias(identity),
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "head").alias("component_id"),
            (F.col("id") == F.coalesce("component", "head")).alias("kept"),
        )
    )
