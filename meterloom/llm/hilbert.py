"""Shards cut from a Hilbert curve over several metadata columns.

Rows that are near each other in all the columns are near on the curve, so the files of a
shard have narrow ranges in every column and scans can skip them by their statistics.
Built from DataFrame functions alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 5
SPREAD = 1024


def cells(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[Column]:
    """A cell number 0 .. 2^bits - 1 for each numeric column, by approximate quantiles.

    The bounds are a handful of numbers (2^bits - 1 a column), gathered by a mergeable
    sketch; they decide where cells end, never which rows are kept. Null is in cell 0.
    """
    parts = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = df.agg(
        *[F.percentile_approx(c, parts, 10_000).alias(f"b{i}") for i, c in enumerate(columns)]
    ).first()
    out = []
    for i, c in enumerate(columns):
        cell = F.lit(0)
        # The sorted bounds are one literal; a cell is how many of them a value reaches.
        reached = F.filter(F.lit(sorted(bounds[i] or [])), lambda b: b <= F.col(c))  # noqa: B023
        out.append(F.coalesce(F.size(reached), cell) if bounds[i] else cell)
    return out


def text_axis(column: str) -> Column:
    """A number that orders strings by their first seven bytes."""
    first = F.rpad(F.hex(F.substring(F.col(column).cast("binary"), 1, 7)), 14, "0")
    return F.conv(first, 16, 10).cast("bigint")


def curve_index(axes: Sequence[Column], bits: int = BITS) -> Column:
    """The place on a Hilbert curve of a point with ``bits`` bits on each axis.

    From the highest bit down, an axis whose bit is set turns the lower bits of the first
    axis over, and one whose bit is clear swaps them with the first axis; then the axes are
    Gray-coded against each other and their bits interleaved (Skilling, 2004).
    """
    names = [f"h{i}" for i in range(len(axes))]
    one = F.lit(1).cast("bigint")

    def struct(values: Sequence[Column]) -> Column:
        return F.struct(*[v.cast("bigint").alias(n) for v, n in zip(values, names)])

    def turned(point: Column, high: Column) -> Column:
        low = F.call_function("shiftleft", one, high) - 1
        values = [point[n] for n in names]
        for i in range(len(values)):
            is_set = F.call_function("shiftright", values[i], high).bitwiseAND(one) == 1
            other = values[0].bitwiseXOR(values[i]).bitwiseAND(low)
            first = values[0].bitwiseXOR(F.when(is_set, low).otherwise(other))
            if i:
                values[i] = F.when(is_set, values[i]).otherwise(values[i].bitwiseXOR(other))
            values[0] = first
        return struct(values)

    def coded(point: Column) -> Column:
        gray = [point[names[0]]]
        for n in names[1:]:
            gray.append(point[n].bitwiseXOR(gray[-1]))
        flip = F.lit(0).cast("bigint")
        for high in range(bits - 1, 0, -1):
            is_set = F.shiftright(gray[-1], high).bitwiseAND(one) == 1
            flip = flip.bitwiseXOR(F.when(is_set, F.lit((1 << high) - 1)).otherwise(F.lit(0)))
        return struct([g.bitwiseXOR(flip) for g in gray])

    def woven(point: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for bit in range(bits - 1, -1, -1):
            for n in names:
                out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(point[n], bit).bitwiseAND(one))
        return out

    point = struct(axes)
    if bits > 1:
        point = F.aggregate(F.sequence(F.lit(bits - 1), F.lit(1), F.lit(-1)), point, turned)
    # A lambda variable stands for a value, so that it is computed once.
    return F.transform(F.transform(F.array(point), coded), woven)[0]


def assign_shards(
    df: DataFrame, axes: Sequence[Column], shards: int, order: str, bits: int = BITS
) -> DataFrame:
    """Add ``curve``, ``shard`` (0 .. shards - 1) and ``slot`` (0, 1, .. in the shard).

    Law ``rows``: rows in the order of the curve, ties by a hash of ``order`` and then by
    ``order``, are cut into runs whose counts differ by one at most. The rank of a row is
    the count of rows in cells before its own, of those in earlier parts of its cell, and
    its place in its part. A cell may hold any share of the rows: it is dealt into
    ``SPREAD`` parts by a hash, and only counts of parts are ordered across a cell, only
    2^(bits * axes) counts across the table. Nulls sort first; equal rows take any order
    among themselves; an empty table stays empty.
    """
    taken = ("curve", "shard", "slot", "_part", "_a0", "_rank", "_before", "_total", "_n")
    df = df.drop(*taken)
    named = df.select("*", *[a.alias(f"_a{i}") for i, a in enumerate(axes)])
    columns = [f"_a{i}" for i in range(len(axes))]
    part = F.pmod(F.xxhash64(F.col(order)), F.lit(SPREAD))
    placed = named.withColumn("curve", curve_index(cells(named, columns, bits), bits)).withColumn(
        "_part", part
    ).drop(*columns)
    parts = placed.groupBy("curve", "_part").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(F.lit(0))
    earlier = (Window.unboundedPreceding, -1)
    totals = parts.groupBy("curve").agg(F.sum("_n").alias("_cell")).select(
        "curve",
        F.coalesce(
            F.sum("_cell").over(whole.orderBy("curve").rowsBetween(*earlier)), F.lit(0)
        ).alias("_cells_before"),
        F.sum("_cell").over(whole).alias("_total"),
    )
    within = Window.partitionBy("curve").orderBy("_part").rowsBetween(*earlier)
    offsets = (
        parts.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0)))
        .join(totals, "curve")
        .select("curve", "_part", (F.col("_before") + F.col("_cells_before")).alias("_before"), "_total")
    )
    place = F.row_number().over(Window.partitionBy("curve", "_part").orderBy(order))
    ranked = placed.withColumn("_rank", place - 1).join(offsets, ["curve", "_part"]).withColumn(
        "_rank", F.col("_rank") + F.col("_before")
    )
    each, more = F.expr(f"_total div {shards}"), F.expr(f"_total % {shards}")
    in_larger = F.col("_rank") < more * (each + 1)
    after = F.col("_rank") - more * (each + 1)
    return (
        ranked.withColumn("_each", each)
        .withColumn(
            "shard",
            F.when(in_larger, F.expr("_rank div (_each + 1)"))
            .otherwise(more + F.call_function("div", after, F.col("_each")))
            .cast("int"),
        )
        .withColumn(
            "slot",
            F.when(in_larger, F.expr("_rank % (_each + 1)"))
            .otherwise(after % F.when(F.col("_each") > 0, F.col("_each")).otherwise(F.lit(1)))
            .cast("bigint"),
        )
        .select(*df.columns, "curve", "shard", "slot")
    )


def write_shards(df: DataFrame, path: str, sort: Sequence[str] = ("curve",)) -> None:
    """One folder a shard, rows in the order of the curve: several files where it is large."""
    df.repartition("shard", F.pmod(F.col("slot"), F.lit(8))).sortWithinPartitions(
        "shard", *sort
    ).write.partitionBy("shard").parquet(path)
