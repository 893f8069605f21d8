"""Instruction-corpus preparation: scoring, splitting, deduplication, chat records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.functions import text as T
from meterloom.functions.messages import chat_messages, chat_record
from meterloom.operators.once import computed_once
from meterloom.operators.ordered import BLOCK_ROWS, measured, take_first
from meterloom.session import stage

DEFAULT_MIN_RATIO = 0.3
DEFAULT_MIN_OUTPUT_CHARS = 10
DEFAULT_MAX_REPEAT_RATIO = 0.5


def from_documents(documents: DataFrame) -> DataFrame:
    """Instruction rows from plain documents: first line asks, the rest answers."""
    first_break = F.instr("text", "\n")
    has_break = first_break > 0
    return documents.select(
        F.col("doc_id").alias("row_id"),
        F.when(has_break, F.substring("text", F.lit(1), first_break - 1))
        .otherwise(F.col("text"))
        .alias("instruction"),
        F.lit("").alias("input"),
        F.when(has_break, F.substring("text", first_break + 1, F.length("text")))
        .otherwise(F.lit(""))
        .alias("output"),
        "source",
    )


# So much of two texts is compared before their whole canonical forms are made.
_GLANCE = 256


def _echoes(instruction: Column, output: Column) -> Column:
    """Whether the canonical forms of two composed texts are equal.

    Nearly all pairs differ in the first characters, and then only these are looked at. The
    last of them is left out: how it is lowered may depend on the next.
    """
    whole = T.canonical_form(instruction)
    glance = T.canonical_form(F.substring(output, 1, _GLANCE))
    start = F.substring(glance, F.lit(1), F.length(glance) - 1)
    return F.when(whole.startswith(start), whole == T.canonical_form(output)).otherwise(F.lit(False))


def _lacks_script(instruction: Column, output: Column, script: str, min_ratio: float) -> Column:
    """Whether under ``min_ratio`` of the letters of two texts belong to ``script``.

    Letters are no more than characters, so a text with enough of the script among all its
    characters has enough, and one without any has too few; letters are counted for others.
    """
    found = T.count_in_class(instruction, script) + T.count_in_class(output, script)
    characters = F.length(instruction) + F.length(output)

    def verdict(found: Column) -> Column:
        letters = F.length(T.letters_of(instruction)) + F.length(T.letters_of(output))
        return (
            F.when(found >= F.lit(min_ratio) * characters, F.lit(False))
            .when(found == 0, F.lit(min_ratio > 0))
            .otherwise(T.ratio_or_zero(found, letters) < min_ratio)
        )

    return T.once(found, verdict)


def score(
    rows: DataFrame,
    *,
    script: str = T.HANGUL,
    min_ratio: float = DEFAULT_MIN_RATIO,
    min_output_chars: int = DEFAULT_MIN_OUTPUT_CHARS,
    max_repeat_ratio: float = DEFAULT_MAX_REPEAT_RATIO,
    wrong_script: str = "not_korean",
) -> DataFrame:
    """Add ``reasons``, every reason to drop a row in fixed order, and ``dedup_key``.

    Expects ``instruction`` and ``output``; both may be null. The key covers instruction
    and output, not the input (A2).
    """
    composed = (
        rows.withColumn("_in", T.nfc(F.coalesce("instruction", F.lit(""))))
        .withColumn("_out", T.nfc(F.coalesce("output", F.lit(""))))
        .withColumn("instruction_n", T.tidy_layout(F.col("_in")))
        .withColumn("output_n", T.tidy_layout(F.col("_out")))
    )
    instruction, output = F.col("instruction_n"), F.col("output_n")
    both = (instruction != "") & (output != "")
    repetitive = T.is_repetitive(output, max_repeat_ratio)
    # Cheap tests first inside each condition: `when` stops at the first false operand.
    reasons = F.array(
        F.when(instruction == "", F.lit("empty_instruction")),
        F.when(output == "", F.lit("empty_output")),
        F.when(
            F.length(output).between(1, min_output_chars - 1), F.lit("output_too_short")
        ),
        F.when(both, F.when(_lacks_script(instruction, output, script, min_ratio), F.lit(wrong_script))),
        F.when(both, F.when(_echoes(F.col("_in"), F.col("_out")), F.lit("output_echoes_instruction"))),
        F.when(both, F.when(repetitive, F.lit("repetitive"))),
    )
    kept = [c for c in rows.columns if c not in ("instruction_n", "output_n", "reasons", "dedup_key")]
    scored = computed_once(
        composed,
        [*kept, "_in", "_out"],
        instruction_n=instruction,
        output_n=output,
        reasons=F.array_compact(reasons),
    )
    # Outside of what is computed once: nobody pays for a key that is not read, and a filter
    # by the reasons comes before it.
    key = F.sha1(F.concat(T.canonical_form(F.col("_in")), T.canonical_form(F.col("_out"))))
    return scored.withColumn("dedup_key", key).drop("_in", "_out")


def accepted(scored: DataFrame) -> DataFrame:
    """Rows without a reason, and without the reasons column."""
    return scored.filter(F.size("reasons") == 0).drop("reasons")


def rejected(scored: DataFrame) -> DataFrame:
    """Rows with at least one reason."""
    return scored.filter(F.size("reasons") > 0)


def reject_histogram(scored: DataFrame) -> DataFrame:
    """A1: rows per rejection reason, most frequent first."""
    return (
        scored.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "reason")
    )


def dedup_exact(
    rows: DataFrame, key: Sequence[str] = ("dedup_key",), row_id: str = "row_id"
) -> DataFrame:
    """A2: one row per key, the one with the lowest id. Ids are unique and not null.

    Only keys and ids are shuffled: a copy count on the map side finds the keys that occur
    more than once, and with them the ids of all rows but the first of each. These ids are
    written as a table, so that Spark knows their size; rows meet them in an anti-join, for
    which no text is moved as long as they are few enough to be sent. Rows are read twice:
    stage what is costly to make.
    """
    named = {k: f"_{at}" for at, k in enumerate(key)}
    narrow = stage(rows.select(*[F.col(k).alias(n) for k, n in named.items()], row_id), "keys")
    copied = (
        narrow.groupBy(*named.values())
        .agg(F.min(row_id).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .withColumnsRenamed({n: f"{n}_of" for n in named.values()})
    )
    same = reduce(and_, [F.col(n).eqNullSafe(F.col(f"{n}_of")) for n in named.values()])
    later = narrow.join(copied, same & (F.col(row_id) > F.col("_first"))).select(row_id)
    return rows.join(stage(later, "copies"), row_id, "left_anti").select(*rows.columns)


def funnel(scored: DataFrame, by: str = "source") -> DataFrame:
    """A3: loaded, rejected, kept, unique and duplicate counts per ``by``.

    Duplicates are judged over the whole corpus; the survivor of a key counts for the
    source it came from. One pass: the rows collapse to (by, key) before anything else.
    """
    is_rejected = F.size("reasons") > 0
    collapsed = (
        scored.select(
            by,
            F.when(~is_rejected, F.col("dedup_key")).alias("_key"),
            F.col("row_id"),
        )
        .groupBy(by, "_key")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("row_id").alias("_first"))
    )
    kept = F.col("_key").isNotNull()
    # At most one row per source and key is left; rejected rows have no key to share.
    same_key = Window.partitionBy("_key", F.when(~kept, F.col(by)))
    return (
        collapsed.withColumn("_survivor", F.min("_first").over(same_key) == F.col("_first"))
        .groupBy(by)
        .agg(
            F.sum("_n").alias("loaded"),
            F.coalesce(F.sum(F.when(~kept, F.col("_n"))), F.lit(0)).alias("rejected"),
            F.coalesce(F.sum(F.when(kept, F.col("_n"))), F.lit(0)).alias("kept"),
            F.count_if(kept & F.col("_survivor")).alias("unique"),
        )
        .withColumn("duplicates", F.col("kept") - F.col("unique"))
    )


def cap_rows(
    rows: DataFrame, n: int, order: str = "row_id", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """S3: the first ``n`` rows by ``order``; 0 means no cap.

    The cut is found by blocks of the integer ``order`` column, for a cap of any size.
    """
    if n == 0:
        return rows
    block = measured(rows, order, block_rows).block(F.col(order))
    return take_first(rows, n, [order], block)


def preview(rows: DataFrame, n: int = 5, order: str = "row_id") -> DataFrame:
    """The first few rows, always the same ones."""
    return rows.orderBy(order).limit(n)


def chat_records(rows: DataFrame, system: str = "") -> DataFrame:
    """Add ``messages`` and ``value``, the JSON line of the record.

    Uses the tidied columns of :func:`score` where they are present.
    """

    def tidied(name: str):
        ready = f"{name}_n"
        return F.col(ready) if ready in rows.columns else T.normalize_text(F.col(name))

    return (
        rows.withColumn("_in", tidied("instruction"))
        .withColumn("_extra", tidied("input"))
        .withColumn("_out", tidied("output"))
        .withColumn(
            "messages", chat_messages(F.col("_in"), F.col("_extra"), F.col("_out"), system)
        )
        .withColumn("value", chat_record(F.col("messages"), F.col("source")))
        .drop("_in", "_extra", "_out")
    )
