"""Exact percentiles of many groups, including groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.session import stage

# Distinct values that are put in order in one task; more are cut again.
MOST_IN_ORDER = 1 << 20
# Steps into which the values between two powers of two are cut.
STEPS = 1 << 16


def bucket_of(value: Column, steps: int = STEPS) -> Column:
    """An integer that never falls as a double rises: its power of two, and the step in it.

    It is read off the value alone, so no pass is needed to find bounds, and equal values
    are in one bucket. NaN comes last, as in Spark's order.
    """
    size = F.abs(value)
    power = F.floor(F.log2(size))
    step = F.floor((size / F.pow(F.lit(2.0), power) - 1) * steps)
    place = (power + 1100) * steps + step
    endless = F.lit(1 << 61).cast("bigint")
    return (
        F.when(F.isnan(value), endless + 1)
        .when(value == 0, F.lit(0).cast("bigint"))
        .when(size == float("inf"), F.when(value > 0, endless).otherwise(-endless))
        .when(value > 0, place)
        .otherwise(-place)
    )


def exact_quantiles(
    values: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Sequence[float],
    *,
    rank: str = "linear",
    steps: int = STEPS,
    most: int = MOST_IN_ORDER,
) -> DataFrame:
    """One row per group and quantile: ``keys, q, n, quantile``.

    ``rank="linear"`` interpolates at ``(n - 1) * q``; ``rank="lower"`` takes the value at
    ``floor(q * (n - 1))``. Null values are left out.

    Equal values are counted on the map side and written once; all else reads that table.
    Counts of buckets of neighbouring values tell which buckets hold a wanted rank. Buckets
    that hold more than ``most`` distinct values are cut again into ``steps`` even parts of
    their own range until none does, so however closely values lie, no task orders more.
    The driver sees one number a round.
    """
    if rank not in ("linear", "lower"):
        raise ValueError(f"unknown rank rule {rank!r}")
    if not keys:
        whole = values.select(F.lit(0).alias("_all"), value)
        return exact_quantiles(
            whole, ["_all"], value, quantiles, rank=rank, steps=steps, most=most
        ).drop("_all")
    present = values.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_v")
    )
    counted = stage(
        present.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")), "counted"
    )
    summary = (
        counted.groupBy(*keys, bucket_of(F.col("_v"), steps).alias("_bucket"))
        .agg(*_size())
        .withColumn("_before", _sum_before(keys, "_bucket"))
        .withColumn("n", F.sum("_in").over(Window.partitionBy(*keys)))
    )
    place = (F.col("n") - 1) * F.col("q")
    targets = (
        summary.withColumn("q", F.explode(F.lit([float(q) for q in quantiles])))
        .withColumn("_low", F.floor(place))
        .withColumn("_high", F.least(F.col("_low") + 1, F.col("n") - 1))
        .withColumn("_part", place - F.col("_low"))
    )
    asked = [*keys, "q", "n", "_low", "_high", "_part"]
    needed = stage(targets.filter(_is_wanted()).select(*asked, *_RANGE), "needed")
    while (needed.agg(F.max(F.when(_can_split(), F.col("_distinct")))).first()[0] or 0) > most:
        needed = stage(_cut_again(counted, needed, keys, asked, steps, most), "needed")

    inside = Window.partitionBy(*keys, "_lo").orderBy("_v")
    upto = F.sum("_c").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    ranked = (
        _within(counted, needed, keys)
        .withColumn("_upto", F.col("_before") + upto)
        .withColumn("_from", F.col("_upto") - F.col("_c"))
        .select(*keys, "_lo", "_v", "_from", "_upto")
    )

    def at(position: str) -> Column:
        return (F.col(position) >= F.col("_from")) & (F.col(position) < F.col("_upto"))

    found = (
        needed.select(*asked, "_lo")
        .join(ranked, [*keys, "_lo"])
        .filter(at("_low") | at("_high"))
        .groupBy(*keys, "q", "n", "_part")
        .agg(
            F.max(F.when(at("_low"), F.col("_v"))).alias("_lower"),
            F.max(F.when(at("_high"), F.col("_v"))).alias("_upper"),
        )
    )
    if rank == "lower":
        result = F.col("_lower")
    else:
        result = F.col("_lower") * (1 - F.col("_part")) + F.col("_upper") * F.col("_part")
    return found.select(*keys, "q", "n", result.alias("quantile"))


# A range of values: rows before it, rows and distinct values in it, its ends.
_RANGE = ("_before", "_in", "_distinct", "_lo", "_hi")


def _size() -> list[Column]:
    return [
        F.sum("_c").alias("_in"),
        F.count(F.lit(1)).alias("_distinct"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
    ]


def _sum_before(keys: Sequence[str], order: str) -> Column:
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_in").over(before), F.lit(0))


def _is_wanted() -> Column:
    """Whether a range holds one of the two ranks; a pair may straddle two ranges."""
    return (F.col("_high") >= F.col("_before")) & (F.col("_low") < F.col("_before") + F.col("_in"))


def _can_split() -> Column:
    return F.col("_lo") < F.col("_hi")


def _within(counted: DataFrame, needed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The counted values of the needed ranges, each once a range."""
    ranges = needed.select(*keys, "_before", "_lo", "_hi").distinct()
    return counted.join(ranges, [*keys]).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _cut_again(
    counted: DataFrame, needed: DataFrame, keys: Sequence[str], asked: Sequence[str], steps: int, most: int
) -> DataFrame:
    """The needed ranges, those with too many values replaced by the parts of them that are."""
    too_large = _can_split() & (F.col("_distinct") > most)
    large = needed.filter(too_large)
    parts = (
        _within(counted, large, keys)
        .withColumnsRenamed({"_lo": "_of", "_before": "_start", "_hi": "_end"})
        .withColumn("_at", F.floor((F.col("_v") - F.col("_of")) / (F.col("_end") - F.col("_of")) * steps))
        .groupBy(*keys, "_of", "_start", "_at")
        .agg(*_size())
        .withColumn("_before", F.col("_start") + _sum_before([*keys, "_of"], "_at"))
        .select(*keys, "_of", *_RANGE)
    )
    again = (
        large.select(*asked, F.col("_lo").alias("_of"))
        .join(parts, [*keys, "_of"])
        .filter(_is_wanted())
        .select(*asked, *_RANGE)
    )
    return needed.filter(~too_large).unionByName(again)
