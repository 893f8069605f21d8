"""Failure causes and tails out of log files; change feeds out of polled job states."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.functions.classify import cluster_error, log_read
from meterloom.functions.text import SPACE, is_blank, strip
from meterloom.operators.ordered import BLOCK_ROWS, measured, take_first, with_neighbour
from meterloom.session import stage

# What marks the line where something went wrong.
ERROR_MARKS = (
    "Traceback (most recent call last)",
    "ERROR ",
    "Error:",
    "error:",
    "raise ",
    "out of memory",
    "No available memory",
    "not supported",
    "Unsupported",
    "AssertionError",
    "ValueError",
    "RuntimeError",
)
# The speaker stamp at the start of a line, and the whole line prefix with
# level and time.
SPEAKER_STAMP = r"\A\([A-Za-z][^)\n]*\)"
LINE_PREFIX = (
    rf"\A\([A-Za-z][^)\n]*\)[{SPACE}]*"
    rf"(?:(?:ERROR|WARNING|INFO|DEBUG)[{SPACE}]+[0-9:\- ]+\[[^\]]+\] ?)?"
)
TERMINAL = ("Completed", "Failed", "Canceled")
NO_VALUE_YET = "(logged, no value yet)"


def has_error_mark(line: Column) -> Column:
    found = F.lit(False)
    for mark in ERROR_MARKS:
        found = found | line.contains(mark)
    return found


def first_error(lines: DataFrame, file: str = "file_id", position: str = "line_no") -> DataFrame:
    """Lines from the first marked one on, with ``first_no`` and its ``speaker``.

    ``speaker`` is empty when the marked line carries no stamp. Files without a marked
    line have no rows.

    What is known of a file is written as a table before lines meet it. Spark then knows how
    large it is: as long as it is small it goes to the readers, and no line is shuffled.
    """
    marked = lines.filter(has_error_mark(F.col("line")))
    found = (
        marked.groupBy(file)
        .agg(F.min(F.struct(position, "line")).alias("_first"))
        .select(
            file,
            F.col(f"_first.{position}").alias("first_no"),
            F.regexp_extract("_first.line", SPEAKER_STAMP, 0).alias("speaker"),
        )
    )
    return lines.join(stage(found, "first_error"), file).filter(F.col(position) >= F.col("first_no"))


def cause_block(lines: DataFrame, file: str = "file_id", position: str = "line_no") -> DataFrame:
    """The unbroken run of the first speaker, stamps stripped, blanks dropped."""
    return _cause_of(first_error(lines, file, position), file, position)


def _cause_of(started: DataFrame, file: str, position: str) -> DataFrame:
    """The runs of first speakers, which end with the first line that is not theirs."""
    stamped = started.filter(F.col("speaker") != "")
    other = stamped.filter(~F.col("line").startswith(F.col("speaker")))
    stops = stage(other.groupBy(file).agg(F.min(position).alias("_stop")), "stops")
    bare = F.regexp_replace(F.regexp_replace("line", LINE_PREFIX, ""), rf"[{SPACE}]+\z", "")
    return (
        stamped.join(stops, file, "left")
        .filter(F.col("_stop").isNull() | (F.col(position) < F.col("_stop")))
        .withColumn("line", bare)
        .filter(F.col("line") != "")
        .select(file, position, "line")
    )


def _ranked(rows: DataFrame, file: str, n: int, *, last: bool = False) -> DataFrame:
    """The first (or last) few rows of every file by ``_at``, with their ``_rank``.

    Every task keeps its own ``n`` of a file before anything is shuffled.
    """
    order = F.desc("_at") if last else F.asc("_at")
    rank = F.row_number().over(Window.partitionBy(file).orderBy(order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n)


def _joined_text(rows: DataFrame, file: str, position: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct(position, "line")))
    return rows.groupBy(file).agg(
        F.array_join(F.transform(ordered, lambda r: F.concat(r["line"], F.lit("\n"))), "").alias(
            "excerpt"
        )
    )


def error_excerpt(
    lines: DataFrame,
    window: int = 28,
    head: int = 6,
    file: str = "file_id",
    position: str = "line_no",
) -> DataFrame:
    """``file, excerpt`` for every file in which something went wrong.

    A stamped cause keeps its first ``head`` and last ``window - head`` lines with a
    marker between; an unstamped one keeps ``window`` lines as they are.

    The runs of the speakers are written once; their sizes and both their ends are found in
    that table. At most ``window`` lines of a file leave a task.
    """
    started = first_error(lines, file, position)
    at = F.col(position).cast("bigint").alias("_at")
    plain = _ranked(started.filter(F.col("speaker") == "").select(file, at, "line"), file, window)
    block = stage(_cause_of(started, file, position).select(file, at, "line"), "cause")
    sizes = block.groupBy(file).agg(F.count(F.lit(1)).alias("_n"))
    overlong = F.col("_n") > window
    opening = _ranked(block, file, window).join(sizes, file).filter(~overlong | (F.col("_rank") <= head))
    closing = _ranked(block, file, window - head, last=True).join(sizes.filter(overlong), file)
    omitted = F.concat(F.lit("... "), F.col("_n") - window, F.lit(" lines omitted ..."))
    # The marker stands behind the last line of the head.
    marker = opening.filter(overlong & (F.col("_rank") == head)).withColumn("line", omitted)
    rows = reduce(
        DataFrame.unionByName,
        [
            part.select(file, F.struct("_at", F.lit(after).alias("_after")).alias("_place"), "line")
            for part, after in ((plain, 0), (opening, 0), (closing, 0), (marker, 1))
        ],
    )
    return _joined_text(rows, file, "_place")


def log_tail(
    lines: DataFrame, n: int = 40, file: str = "file_id", position: str = "line_no"
) -> DataFrame:
    """The last ``n`` lines of every file, as rows, for an ``n`` of any size."""
    block = -measured(lines, position).block(F.col(position))
    return take_first(lines, n, [F.desc(position)], block, [file])


def tail_text(
    lines: DataFrame, n: int = 40, file: str = "file_id", position: str = "line_no"
) -> DataFrame:
    """W7 as one text per file: at most ``n`` lines are gathered."""
    return _joined_text(log_tail(lines, n, file, position), file, position)


def failure_reason(status: Column, reason: Column) -> Column:
    """The reason of a failure, on one line of at most 400 characters."""
    one_line = strip(F.regexp_replace(reason, f"[{SPACE}]+", " "))
    return F.when((status == "Failed") & ~is_blank(reason), F.substring(one_line, 1, 400))


def status_changes(
    polls: DataFrame,
    job: str = "job",
    position: str = "poll",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Polls whose status differs from the poll before; unknown reads as ``?``.

    A failure's reason is put on one line of at most 400 characters.
    """
    state = F.coalesce(F.nullif(F.col("status"), F.lit("")), F.lit("?"))
    known = polls.withColumn("status", state)
    changed = with_neighbour(
        known, [job], position, "previous", F.col("status"), block_rows=block_rows
    ).filter(F.col("previous").isNull() | (F.col("previous") != F.col("status")))
    if "reason" not in polls.columns:
        return changed
    return changed.withColumn("reason", failure_reason(F.col("status"), F.col("reason")))


def first_sightings(values: DataFrame, job: str = "job", position: str = "poll") -> DataFrame:
    """Where each (job, channel, name, value) was first seen.

    ``channel`` is ``metric`` or ``tag``. A metric without a value is a sighting of its
    own; tags the tracking service sets itself are left out.
    """
    named = F.coalesce(F.col("name"), F.lit("")) != ""
    own = (F.col("channel") == "tag") & F.col("name").startswith("mlflow.")
    return (
        values.filter(named & ~own)
        .groupBy(job, "channel", "name", "value")
        .agg(F.min(position).alias(position))
        .withColumn(
            "shown",
            F.when(
                (F.col("channel") == "metric") & F.col("value").isNull(), F.lit(NO_VALUE_YET)
            ).otherwise(F.col("value")),
        )
    )


def last_status(polls: DataFrame, job: Sequence[str] = ("job",), position: str = "poll") -> DataFrame:
    """The latest status of every job."""
    return polls.groupBy(*job).agg(F.max(F.struct(position, "status")).alias("_last")).select(
        *job, F.col("_last.status").alias("status")
    )


def all_terminal(
    polls: DataFrame, by: Sequence[str] = (), job: str = "job", position: str = "poll"
) -> DataFrame:
    """Whether every job of a watch list has ended."""
    latest = last_status(polls, [*by, job], position)
    return latest.groupBy(*by).agg(
        F.count(F.lit(1)).alias("jobs"),
        F.count_if(F.col("status").isin(*TERMINAL)).alias("terminal"),
        F.bool_and(F.coalesce(F.col("status").isin(*TERMINAL), F.lit(False))).alias(
            "all_terminal"
        ),
    )


def classify_log_reads(reads: DataFrame) -> DataFrame:
    """P19 over fetched logs with ``status_code`` and ``body``."""
    return (
        reads.withColumn("_read", log_read(F.col("status_code"), F.col("body")))
        .select(*reads.columns, "_read.status", "_read.detail", "_read.is_evidence")
    )


def classify_cluster_errors(errors: DataFrame, message: str = "message") -> DataFrame:
    """P20 over refused clusters."""
    return errors.withColumn("_error", cluster_error(F.col(message))).select(
        *errors.columns,
        "_error.code",
        "_error.family",
        "_error.quota",
        "_error.sku",
        "_error.detail",
    )
