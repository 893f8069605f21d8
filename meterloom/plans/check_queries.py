"""Registered queries: data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.operators import checks
from meterloom.plans.inputs import table
from meterloom.plans.registry import query


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem
       GROUP BY ALL HAVING count(*) > 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return checks.duplicate_keys(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query(
    "shared_ids",
    "SELECT doc_id AS id FROM documents INTERSECT SELECT item_id FROM benchmark",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return checks.shared_ids(
        table(spark, folder, "documents"), "doc_id", table(spark, folder, "benchmark"), "item_id"
    )


@query(
    "without_shared",
    "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT item_id FROM benchmark)",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return checks.without_shared(
        table(spark, folder, "documents").select("doc_id", "source"),
        "doc_id",
        table(spark, folder, "benchmark"),
        "item_id",
    )


@query(
    "dangling",
    """SELECT doc_id, quality, toxic FROM labels
       WHERE doc_id NOT IN (SELECT item_id FROM benchmark)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of documents that are no benchmark item."""
    labels = table(spark, folder, "labels").select("doc_id", "quality", "toxic")
    return checks.dangling(labels, "doc_id", table(spark, folder, "benchmark"), "item_id")


@query(
    "license_drift",
    """SELECT d.doc_id AS key, CASE WHEN l.doc_id IS NULL THEN 'missing'
              WHEN d.doc_id % 5 = 0 OR l.doc_id % 7 = 0 THEN 'unknown'
              WHEN quality = 0 THEN 'drift' ELSE 'ok' END AS status
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.col("doc_id")
    declared = table(spark, folder, "documents").select(
        doc.alias("key"),
        doc.alias("dataset_id"),
        F.when(doc % 5 == 0, F.lit("unknown")).otherwise(F.lit("MIT")).alias("license"),
    )
    observed = table(spark, folder, "labels").select(
        doc.alias("dataset_id"),
        F.when(doc % 7 == 0, F.lit("unspecified"))
        .when(F.col("quality") == 0, F.lit("cc-by-4.0"))
        .otherwise(F.lit("mit"))
        .alias("license"),
    )
    return checks.license_drift(declared, observed).select("key", "status")
