"""From raw documents to token ids: five stages, each written and read again.

Every stage takes what its predecessor kept and calls one operator of ``meterloom.llm``;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm import bpe, minmax, mixing, queries, suffixes, toxicity
from meterloom.llm.shared import staged

TOXIC = 0.5


def _apart(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` with names for all columns but ``needed`` that no operator uses."""
    return docs.toDF(*[c if c in needed else f"other_{at}" for at, c in enumerate(docs.columns)])


def _as_before(found: DataFrame, own: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of :func:`_apart`, under their names and of their types again."""
    columns = [F.col(c).cast(f.dataType) for c, f in zip(own.columns, docs.schema)]
    return found.select(*columns).toDF(*docs.columns)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5.

    A null or empty text has the score of texts without a known word; equal texts have equal
    scores and go or stay together, each row by itself. Labels are learnt from all rows of
    ``labels`` that meet a document and are not held out; without any nothing is rejected.
    An empty table stays empty. Columns come back as they were, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        F.col("doc_id").alias("id"), "toxic"
    )
    model = toxicity.fit(
        docs.select(F.col("doc_id").alias("id"), "text"), labels, ~queries.held_out("id")
    )
    own = _apart(docs, "doc_id", "text")
    return _as_before(toxicity.scored(own, model).filter(F.col("score") < TOXIC), own, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Null texts and texts without words are in no group and stay. Rows that repeat an id are
    one document and go or stay together; a row without an id stays. An empty table stays
    empty. Columns come back as they were, whatever their names.
    """
    own = _apart(docs, "doc_id", "text")
    groups = minmax.near_duplicates(own.select("doc_id", "text"), "doc_id")
    dropped = staged(groups.filter(~F.col("kept")).select("doc_id"), "dropped")
    # A written table: Spark knows its size, and sends it to the texts if that is small.
    unique = own.join(dropped.filter("doc_id is not null").distinct(), "doc_id", "left_anti")
    return _as_before(unique, own, docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that stand earlier, cut between characters.

    A document of which nothing is left goes, one that was null or empty before stays as it
    is. Rows that repeat an id are one document and lose the same; a row without an id is
    not cut. ``n_chars``, if there, follows the text. An empty table stays empty. Other
    columns come back as they were, whatever their names.
    """
    own = _apart(docs, "doc_id", "text", "n_chars")
    cut = suffixes.without_repeats(own, "doc_id", whole_characters=True)
    changed = F.col("n_removed") > 0
    found = cut.filter(~changed | (F.octet_length("kept") > 0)).withColumn(
        "text", F.when(changed, F.col("kept").cast("string")).otherwise(F.col("text"))
    )
    if "n_chars" in own.columns:
        found = found.withColumn(
            "n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))
        )
    return _as_before(found, own, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources evened out: a document comes as often as the mix reads it.

    A null source counts as ""; a null or empty text has one token. Rows that repeat an id
    have the same place and are read together. An empty table stays empty. Columns come back
    as they were, whatever their names.
    """
    own = _apart(docs, "doc_id", "text", "source")
    mixed = mixing.mix(own, "doc_id", "source", mixing.estimated_tokens("text"), **queries.MIX)
    return _as_before(mixed, own, docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of these and of what they decode to.

    Null and empty texts have no ids. Every row is encoded, repeated ones too. An empty table
    stays empty. Only ``doc_id`` and ``text`` are read.
    """
    # Written in between, so that a task does not need a worker for each of the two at once.
    encoded = staged(bpe.encode(docs.select("doc_id", "text"), queries.TOKENIZER).drop("text"), "ids")
    return bpe.decode(encoded, queries.TOKENIZER).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("mixing", mix_sources),
    ("tokens", to_tokens),
]

# No SQL expresses the first stage; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
