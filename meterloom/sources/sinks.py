"""Writers. Output is partitioned unless a number of files is asked for."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.operators.reports import metrics_of, tags_of
from meterloom.session import stage


def _into(df: DataFrame, files: int | None) -> DataFrame:
    return df if files is None else df.repartition(files)


def write_chat_records(records: DataFrame, path: str, files: int | None = None) -> None:
    """K1: one JSON object per line. ``files=1`` puts all output through one task."""
    _into(records.select("value"), files).write.mode("overwrite").text(path)


def write_rejected(rejected: DataFrame, path: str) -> None:
    """K2: rejected rows with their reasons."""
    rejected.write.mode("overwrite").json(path)


def write_judgements(results: DataFrame, path: str) -> None:
    """K3: one judgement per line; a null score stays visible."""
    results.select("key", "category", "score", "answer", "judgement", "error").write.mode(
        "overwrite"
    ).option("ignoreNullFields", False).json(path)


def write_documents(documents: DataFrame, path: str) -> None:
    """K4 and K5: one report per line; unknown values stay visible."""
    documents.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def publish(flat: DataFrame, path: str, keys: Sequence[str] = ("run_id",)) -> None:
    """K6: a flat report as a metrics table and a tags table, a batch of its own in each.

    What makes a batch visible is the last thing written: a row per run that names it.
    Readers take the latest batch of a run, so publishing again replaces a run as a whole,
    and a batch that broke off is never seen.
    """
    flat = stage(flat, "published")
    batch = uuid.uuid4().hex
    metrics_of(flat, keys).write.parquet(f"{path}/metrics/batch={batch}")
    tags_of(flat, keys).write.parquet(f"{path}/tags/batch={batch}")
    runs = flat.select(*keys).distinct()
    runs.select(*keys, F.lit(batch).alias("batch"), F.current_timestamp().alias("published_at")).write.mode(
        "append"
    ).parquet(f"{path}/committed")


def published(
    spark: SparkSession, path: str, keys: Sequence[str] = ("run_id",)
) -> tuple[DataFrame, DataFrame]:
    """K6: the metrics and the tags of the latest batch of every run."""
    committed = spark.read.parquet(f"{path}/committed")
    latest = committed.groupBy(*keys).agg(
        F.max(F.struct("published_at", "batch"))["batch"].alias("batch")
    )
    return tuple(
        spark.read.parquet(f"{path}/{table}")
        .join(latest, [*keys, "batch"], "left_semi")
        .select(*keys, "name", value)
        for table, value in (("metrics", "metric"), ("tags", "tag"))
    )
