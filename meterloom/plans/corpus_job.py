"""Corpus preparation end to end: load, score, split, deduplicate, write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions.text import HANGUL
from meterloom.operators import corpus
from meterloom.operators.ordered import with_position
from meterloom.session import stage
from meterloom.sources.sinks import write_chat_records, write_rejected


@dataclass(frozen=True)
class CorpusResult:
    """What a run produced; all of it reads from the staged scores."""

    funnel: DataFrame
    histogram: DataFrame
    records: DataFrame
    rejected: DataFrame


def prepare_corpus(
    raw: DataFrame,
    *,
    max_rows: int = 0,
    script: str = HANGUL,
    min_ratio: float = corpus.DEFAULT_MIN_RATIO,
    min_output_chars: int = corpus.DEFAULT_MIN_OUTPUT_CHARS,
    system: str = "",
) -> CorpusResult:
    """Score the corpus once, stage the scores, and derive every output from them.

    ``raw`` holds ``instruction, input, output, source`` and may hold ``row_id``; without
    it, rows are numbered in reading order. The counts and the histogram read two narrow
    columns of the staged table, not the texts.
    """
    rows = raw if "row_id" in raw.columns else with_position(raw, "row_id")
    scored = stage(
        corpus.score(
            corpus.cap_rows(rows, max_rows),
            script=script,
            min_ratio=min_ratio,
            min_output_chars=min_output_chars,
        ),
        "scored",
    )
    unique = corpus.dedup_exact(corpus.accepted(scored))
    return CorpusResult(
        funnel=corpus.funnel(scored),
        histogram=corpus.reject_histogram(scored),
        records=corpus.chat_records(unique, system),
        rejected=corpus.rejected(scored).select(
            *[c for c in rows.columns], F.col("reasons")
        ),
    )


def write_corpus(result: CorpusResult, output_path: str, rejected_path: str) -> None:
    write_chat_records(result.records, output_path)
    write_rejected(result.rejected, rejected_path)
