"""Data-quality checks on keys and references. Each returns the offending rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def duplicate_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """A4: keys that occur more than once, with their counts."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def shared_ids(left: DataFrame, left_id: str, right: DataFrame, right_id: str) -> DataFrame:
    """Ids on both sides. Train and benchmark sets must share none."""
    return left.select(F.col(left_id).alias("id")).intersect(
        right.select(F.col(right_id).alias("id"))
    )


def without_shared(left: DataFrame, left_id: str, right: DataFrame, right_id: str) -> DataFrame:
    """J4 enforced: the rows of ``left`` whose id is not on the right."""
    known = right.select(F.col(right_id).alias(left_id)).distinct()
    return left.join(known, left_id, "left_anti")


def dangling(rows: DataFrame, reference: str, known: DataFrame, known_key: str) -> DataFrame:
    """Rows whose non-null reference points at nothing.

    References are skewed by nature: adaptive execution splits hot ones in this join.
    """
    keys = known.select(F.col(known_key).alias(reference)).distinct()
    pointing = rows.filter(F.col(reference).isNotNull())
    return pointing.join(keys, reference, "left_anti")


def license_drift(
    declared: DataFrame, observed: DataFrame, key: str = "dataset_id"
) -> DataFrame:
    """Declared licenses against a metadata snapshot.

    ``status`` is ``missing`` for an id the snapshot does not hold, ``drift`` for
    licenses that differ beyond case, ``unknown`` when one side states none, else ``ok``.
    Of several entries of an id in the snapshot the smallest license counts.
    """
    snapshot = observed.groupBy(key).agg(
        F.min("license").alias("observed_license"), F.lit(True).alias("_seen")
    )
    joined = declared.join(snapshot, key, "left")
    unstated = _unstated("license", "unknown") | _unstated("observed_license", "unspecified")
    status = (
        F.when(F.col("_seen").isNull(), F.lit("missing"))
        .when(unstated, F.lit("unknown"))
        .when(F.lower("license") != F.lower("observed_license"), F.lit("drift"))
        .otherwise(F.lit("ok"))
    )
    return joined.withColumn("status", status).drop("_seen")


def _unstated(column: str, marker: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")).isin("", marker)
