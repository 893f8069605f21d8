"""Columns that are evaluated once per row, however often they are used afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and the new columns.

    The optimizer moves a filter below the projection its columns come from, and copies
    their expressions into it, so a costly text expression would run again for every
    mention in every later filter. It does not move filters below a generator.
    """
    computed = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*keep, F.inline(F.array(computed)))
