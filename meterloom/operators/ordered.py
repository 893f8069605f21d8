"""Ordered and per-group work that never puts a whole group into one task.

A group (a log file, a request, a source) may hold a third of all rows, so a plain
window over it would be one task's work. Operators here cut groups into blocks of
neighbouring positions instead: rows are shuffled by (group, block), and only one row per
block, the summary, is ever ordered within a group.

Positions are integers that rise in the wanted order: line numbers, frame sequence
numbers, row ids, hashes, microseconds. Where blocks start is read off a quantile sketch of
the positions (:func:`measured`), so that no block holds many more rows than others,
however the positions are spaced. The input is read once for the sketch, once for the
summaries and once for the rows; stage it first (:func:`meterloom.session.stage`) where it
is costly to make. Group columns hold no nulls.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.session import stage

BLOCK_ROWS = 1 << 16
# Pieces of the positions with about equally many rows each, and blocks in all of them.
PIECES = 64
MOST_BLOCKS = 1 << 20
_BLOCK = "_block"
_MERGE = {"min": F.min, "max": F.max, "sum": F.sum}


@dataclass(frozen=True)
class Cuts:
    """Pieces of like row counts; each is cut into ``blocks`` of equal width.

    Everything counts in halves of a position, so that no difference of two overflows.
    """

    starts: tuple[int, ...] = ()
    widths: tuple[int, ...] = ()
    blocks: int = 1

    def block(self, position: Column) -> Column:
        """The block of a position; it never falls as the position rises."""
        if not self.starts:
            return F.lit(0).cast("bigint")
        half = F.shiftright(position.cast("bigint"), 1)
        piece = _piece(half, self.starts[1:], 0)
        start = F.get(F.lit(list(self.starts)), piece)
        width = F.get(F.lit(list(self.widths)), piece)
        inside = F.floor((half - start) / width).cast("bigint")
        return (
            F.greatest(F.least(inside, F.lit(self.blocks - 1)), F.lit(0))
            + piece.cast("bigint") * self.blocks
        )


def _piece(half: Column, cuts: Sequence[int], before: int) -> Column:
    """How many of the rising ``cuts`` a value has reached, by halving."""
    if not cuts:
        return F.lit(before)
    middle = len(cuts) // 2
    return F.when(half < cuts[middle], _piece(half, cuts[:middle], before)).otherwise(
        _piece(half, cuts[middle + 1 :], before + middle + 1)
    )


def measured(df: DataFrame, position: str, block_rows: int = BLOCK_ROWS) -> Cuts:
    """Cuts for blocks of about ``block_rows`` rows, from a sketch of all positions.

    One job over the position column; the driver sees ``PIECES`` numbers. Rows of one group
    are a part of the rows in a piece, so a block of a group holds no more than a block of
    the table. A table of one block is not cut.
    """
    place = F.col(position).cast("bigint")
    ranks = [i / PIECES for i in range(PIECES + 1)]
    found = (
        df.agg(F.count(place).alias("n"), F.kll_sketch_agg_bigint(place).alias("sketch"))
        .select("n", F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(ranks))).alias("cuts"))
        .first()
    )
    if found["n"] <= block_rows:
        return Cuts()
    cuts = [c >> 1 for c in found["cuts"]]
    starts = sorted(set(cuts[:-1]))
    wanted = min(-(-found["n"] // block_rows), MOST_BLOCKS)
    blocks = -(-wanted // len(starts))
    ends = [*starts[1:], cuts[-1] + 1]
    widths = [max(1, -(-(b - a) // blocks)) for a, b in zip(starts, ends)]
    return Cuts(tuple(starts), tuple(widths), blocks)


def with_group_facts(
    df: DataFrame, group: Sequence[str], facts: Mapping[str, tuple[str, Column]]
) -> DataFrame:
    """Add group-wide ``min``, ``max`` or ``sum`` columns to every row.

    ``facts`` maps a new column to (operation, column). They are combined on the map side,
    and there is one row a group to join back: a join that adaptive execution sends to the
    rows where it is small, and whose hot groups it splits where it is not.
    """
    found = df.groupBy(*group).agg(
        *[_MERGE[op](column).alias(name) for name, (op, column) in facts.items()]
    )
    return df.join(found, [*group], "left")


def with_neighbour(
    df: DataFrame,
    group: Sequence[str],
    position: str,
    name: str,
    value: Column,
    *,
    ahead: bool = False,
    block_rows: int = BLOCK_ROWS,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Add ``value`` of the previous row (the next one with ``ahead``) of the group.

    Null on the first (last) row. Positions must be unique within a group. The value is
    wrapped in a struct so that a null value differs from a missing row.
    """
    keys = [*group, _BLOCK]
    own, edge, shifted, carried = "_own", "_edge", "_shifted", "_carried"
    cuts = cuts or measured(df, position, block_rows)
    blocked = df.withColumn(_BLOCK, cuts.block(F.col(position))).withColumn(
        own, F.struct(value.alias("v"))
    )
    pick, shift = (F.min_by, F.lead) if ahead else (F.max_by, F.lag)
    edges = blocked.groupBy(*keys).agg(pick(own, F.col(position)).alias(edge))
    across = Window.partitionBy(*group).orderBy(_BLOCK)
    carries = edges.select(*keys, shift(edge).over(across).alias(carried))
    inside = Window.partitionBy(*keys).orderBy(position)
    return (
        blocked.join(carries, keys, "left")
        .withColumn(shifted, shift(own).over(inside))
        .withColumn(name, F.coalesce(F.col(shifted), F.col(carried))["v"])
        .drop(_BLOCK, own, shifted, carried)
    )


def take_first(
    df: DataFrame,
    n: int,
    order: Sequence[str],
    block: Column,
    group: Sequence[str] = (),
) -> DataFrame:
    """Exactly the first ``n`` rows of every group, in ``order``, for an ``n`` of any size.

    ``block`` must rise with ``order``. Block counts, from a scan of the key columns, tell
    which blocks the cut leaves in; only their rows are shuffled, and ranked per block.
    """
    if n <= 0:
        raise ValueError(f"cannot take the first {n} rows")
    keys = [*group, _BLOCK]
    blocked = df.withColumn(_BLOCK, block)
    # The block summaries of one group: bounded by the number of blocks, not of rows.
    so_far = (
        Window.partitionBy(*(group or [F.lit(0)]))
        .orderBy(_BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    plan = (
        blocked.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(so_far), F.lit(0)))
        .filter(F.col("_before") < n)
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        blocked.join(plan.select(*keys, "_before"), keys)
        .withColumn("_rank", F.row_number().over(inside))
        .filter(F.col("_before") + F.col("_rank") <= n)
        .select(*df.columns)
    )


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows 0, 1, 2, ... in reading order.

    A row knows its place in its own split; all it lacks is how many rows come before that
    split. These counts, one a split, are written as a table small enough to be sent to the
    readers, so no row is moved.
    """
    tagged = df.withColumn("_id", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_id", 33)
    )
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        tagged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.col("_id").bitwiseAND((1 << 33) - 1)
    return (
        tagged.join(stage(offsets, "offsets"), "_part")
        .withColumn(name, F.col("_offset") + inside)
        .drop("_id", "_part", "_offset")
    )
