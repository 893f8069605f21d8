"""Near-duplicate vectors by randomly rotated binary codes.

A unit vector is rotated and kept as the signs of its parts, with a correction factor: the
inner product of the vector with its own code. Code against code gives an estimate of the
inner product of two vectors that is right on average over rotations, with an error that
the factors bound; a pair is computed exactly unless the bound rules it out.

Candidates meet in bands of sign bits from further rotations. The number of bits in a band
grows with the logarithm of the number of vectors, that of bands so that a pair at the
threshold shares none in one of 100,000 cases.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.llm.components import components
from meterloom.llm.shared import checkpointed, staged
from meterloom.llm.shingles import mixed
from meterloom.llm.vectors import matrix, rotation, valid

MISSED = 1e-5
IN_BUCKET = 4
DEVIATIONS = 4.0  # of the estimate: beyond them a pair is not computed
CHUNK = 1024
SEED = 77


def band_shape(n: int, threshold: float) -> tuple[int, int]:
    """Bits in a band and bands, for ``n`` vectors."""
    agree = 1 - math.acos(threshold) / math.pi
    bits = min(62, max(4, math.ceil(math.log2(max(n, 2) / IN_BUCKET))))
    return bits, math.ceil(math.log(MISSED) / math.log(1 - agree**bits))


def units(rows: np.ndarray) -> np.ndarray:
    wide = rows.astype(np.float64)
    return wide / np.sqrt((wide * wide).sum(axis=1))[:, None]


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated vectors, and the correction factors."""
    turned = unit @ rotation(unit.shape[1], SEED).T
    factor = np.abs(turned).sum(axis=1) / math.sqrt(unit.shape[1])
    return np.packbits(turned > 0, axis=1), factor


def bands_of(unit: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """(vectors, bands) of 64-bit keys, from the signs under as many rotations as needed."""
    dimension = unit.shape[1]
    need, planes = bits * bands, []
    for k in range(-(-need // dimension)):
        planes.append(rotation(dimension, SEED + 1 + k))
    signs = unit @ np.concatenate(planes)[:need].T > 0
    weights = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    keys = np.stack(
        [
            (signs[:, b * bits : (b + 1) * bits] * weights).sum(axis=1, dtype=np.uint64)
            for b in range(bands)
        ],
        axis=1,
    )
    return mixed(keys * np.uint64(2 * bands) + np.arange(bands, dtype=np.uint64))


def upper_bounds(
    mine: np.ndarray, my_factor: np.ndarray, other: np.ndarray, other_factor: np.ndarray, dimension: int
) -> np.ndarray:
    """Of the inner products of pairs of codes.

    A code estimates a vector up to an error orthogonal to it of length sqrt(1 - f^2) / f,
    in a direction that the rotation made random: against any unit vector it has a standard
    deviation of that over sqrt(dimension - 1). Both sides are codes here, so the agreement of
    codes is divided by both factors and both errors count.
    """
    apart = _bits_set(np.bitwise_xor(mine, other)).sum(axis=1, dtype=np.int64)
    agreement = 1 - 2 * apart / dimension
    estimate = agreement / (my_factor * other_factor)
    errors = np.sqrt((1 / my_factor**2 - 1) + (1 / other_factor**2 - 1)
                     + (1 / my_factor**2 - 1) * (1 / other_factor**2 - 1))
    return estimate + DEVIATIONS * errors / math.sqrt(max(dimension - 1, 1))


def _bits_set(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _banded(classes: DataFrame, bits: int, bands: int) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("code", T.BinaryType()),
            T.StructField("factor", T.DoubleType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = units(matrix(batch.column("v")))
            code, factor = codes(unit)
            keys = bands_of(unit, bits, bands)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * bands
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([c.tobytes() for c in code], pa.binary()),
                    pa.array(factor),
                    pa.ListArray.from_arrays(
                        pa.array(ends), pa.array(np.ascontiguousarray(keys).view(np.int64).ravel())
                    ),
                ],
                schema.names,
            )

    return classes.select("id", "v").mapInArrow(run, schema).select(
        "id", "code", "factor", F.explode("keys").alias("key")
    )


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows of buckets with two members or more, dealt into blocks ``key, p, q``.

    A bucket of many rows is cut into chunks of about ``CHUNK`` by a hash; a row goes to the
    blocks of its chunk with each chunk, so that every pair meets in one block at least and
    no block outgrows two chunks.
    """
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    chunks = F.expr(f"cast(ceil(members / {CHUNK}) as int)")
    own = F.pmod(F.xxhash64("id"), chunks).cast("int")
    return (
        rows.join(counts, "key")
        .withColumn("chunk", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .withColumn("p", F.least("chunk", "other"))
        .withColumn("q", F.greatest("chunk", "other"))
        .drop("members", "other")
    )


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole blocks of rows that are ordered by block, and where each starts (and the end)."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table, last: bool):
        marks = [table.column(n).to_numpy() for n in ("key", "p", "q")]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.logical_or.reduce([m[1:] != m[:-1] for m in marks])
        starts = np.flatnonzero(new)
        stop = table.num_rows if last else int(starts[-1])
        return stop, np.concatenate([starts[starts < stop], [stop]])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        stop, starts = cut(table, False)
        if stop:
            yield table.slice(0, stop), starts
        held = table.slice(stop).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, cut(table, True)[1]


def _candidates(blocks: DataFrame, dimension: int, threshold: float) -> DataFrame:
    """``key`` and ``id`` of the rows that have a pair in their block which the bound lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _grouped(batches):
            code = np.frombuffer(
                b"".join(table.column("code").to_pylist()), np.uint8
            ).reshape(table.num_rows, -1)
            factor = table.column("factor").to_numpy()
            block = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            good = np.zeros(table.num_rows, bool)
            row, step = np.arange(table.num_rows), 1
            while True:
                row = row[row + step < table.num_rows]
                row = row[block[row] == block[row + step]]
                if not len(row):
                    break
                most = upper_bounds(code[row], factor[row], code[row + step], factor[row + step], dimension)
                hit = row[most >= threshold]
                good[hit] = good[hit + step] = True
                step += 1
            picked = table.select(["key", "id"]).filter(pa.array(good))
            yield from picked.to_batches()

    ordered = blocks.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    return ordered.mapInArrow(run, "key bigint, id bigint").distinct()


_LINKS = "id bigint, links bigint, other bigint"


def united(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest member of each connected part, after the links x - y are added."""
    while True:
        low = np.minimum(root[x], root[y])
        if (low == np.maximum(root[x], root[y])).all():
            return root
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while (root[root] != root).any():
            root = root[root]


def _exact(blocks: DataFrame, bits: int, bands: int, threshold: float) -> DataFrame:
    """Per row of a block: the copies behind its links there, and one link of a spanning tree.

    A pair is counted in the first band that both share, and in one block of it. Rows:
    ``id, links, other``; ``other`` is one row for all that links of the block connect.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _grouped(batches):
            ids = table.column("id").to_numpy()
            copies = table.column("copies").to_numpy()
            key = table.column("key").to_numpy()
            chunk = table.column("chunk").to_numpy()
            across = table.column("p").to_numpy() != table.column("q").to_numpy()
            unit = units(matrix(table.column("v").combine_chunks()))
            keys = bands_of(unit, bits, bands).view(np.int64)
            band = (keys == key[:, None]).argmax(axis=1)
            links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                if b - a < 2:
                    continue
                i, j = np.nonzero(np.triu(unit[a:b] @ unit[a:b].T >= threshold - 1e-9, 1))
                if across[a]:
                    apart = chunk[a + i] != chunk[a + j]
                    i, j = i[apart], j[apart]
                for at in range(0, len(i), 1 << 16):
                    x, y = a + i[at : at + (1 << 16)], a + j[at : at + (1 << 16)]
                    now = int(band[a])
                    if now:
                        new = ~(keys[x, :now] == keys[y, :now]).any(axis=1)
                        x, y = x[new], y[new]
                    near = (unit[x] * unit[y]).sum(axis=1) >= threshold
                    x, y = x[near], y[near]
                    np.add.at(links, x, copies[y])
                    np.add.at(links, y, copies[x])
                    root = united(root, x, y)
            some = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[some]), pa.array(links[some]), pa.array(ids[root[some]])],
                ["id", "links", "other"],
            )

    ordered = blocks.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    return ordered.mapInArrow(run, _LINKS)


def near_vectors(df: DataFrame, identity: str, vector: str, threshold: float = 0.9) -> DataFrame:
    """``identity``, ``n_links``, ``component_id`` and ``kept`` of every vector.

    Two vectors are linked if their cosine, in double precision, is ``threshold`` or more.
    Equal vectors are one class, found by grouping; its smallest id goes on and counts for
    all. Links are counted in the blocks where they are found, not written out as pairs;
    for the components a block gives a star of every part that its links connect.

    Rows that repeat an id and its vector count as copies of each other. Vectors that are null, empty, zero or hold a null, NaN or infinity link with nothing; so do
    vectors of another length than the commonest (each is still a row of the result). An
    empty table gives an empty table.
    """
    good = valid(df, identity, vector)
    sizes = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dimension = sizes["n"] if sizes else 1
    classes = staged(
        good.filter(F.size("v") == dimension)
        .groupBy("v")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")),
        "vectors",
    )
    bits, bands = band_shape(classes.count(), threshold)
    rows = _banded(classes, bits, bands)
    candidates = staged(_candidates(_blocks(rows), dimension, threshold), "candidates")
    found = staged(
        _exact(_blocks(candidates.join(classes, "id")), bits, bands, threshold), "links"
    )
    reached = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    of_class = checkpointed(
        classes.join(counted, "id", "left").join(reached, "id", "left").select(
            "v",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    members = good.filter(F.size("v") == dimension).join(of_class, "v").select(
        "id", "n_links", "component_id"
    )
    everyone = df.select(F.col(identity).cast("bigint").alias("id"))
    return (
        everyone.join(members.dropDuplicates(["id"]), "id", "left")
        .select(
            F.col("id").alias(identity),
            F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.col(identity) == F.col("component_id"))
    )
