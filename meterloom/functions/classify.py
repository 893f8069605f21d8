"""Classification of log reads and of cluster error messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterloom.functions.text import strip

# Wordings that decide what a log response is.
WITHHELD_WORDINGS = ("can't be retrieved", "cannot be retrieved")
GONE_WORDING = "no logs for this deployment"
BAD_REQUEST_WORDINGS = ("not a valid enum value", "requestinvalid")
# Error codes of a refused cluster.
QUOTA_CODE = "ClusterMinNodesExceedCoreQuota"
PROPERTY_CODE = "InvalidPropertyValue"


def _mentions(text: Column, wordings: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for wording in wordings:
        found = found | text.contains(wording)
    return found


def log_read(status_code: Column, body: Column) -> Column:
    """``struct<status, text, detail, is_evidence>`` of one log response.

    Only ``ok`` is evidence; an empty body that was served is ``ok``.
    """
    text = F.coalesce(body, F.lit(""))
    lowered = F.lower(text)
    status = (
        F.when(status_code.isNull() | (status_code != 200), F.lit("error"))
        .when(_mentions(lowered, WITHHELD_WORDINGS), F.lit("withheld"))
        .when(lowered.contains(GONE_WORDING), F.lit("gone"))
        .when(_mentions(lowered, BAD_REQUEST_WORDINGS), F.lit("error"))
        .otherwise(F.lit("ok"))
    )
    detail = (
        F.when(status == "ok", F.lit(""))
        .when(status.isin("withheld", "gone"), strip(text))
        .when(
            status_code == 200,
            F.concat(F.lit("bad request: "), F.substring(text, 1, 200)),
        )
        .otherwise(
            F.concat(
                F.lit("http "),
                F.coalesce(status_code.cast("string"), F.lit("unknown")),
                F.lit(": "),
                F.substring(text, 1, 200),
            )
        )
    )
    return F.struct(
        status.alias("status"),
        F.when(status == "ok", text).otherwise(F.lit("")).alias("text"),
        detail.alias("detail"),
        (status == "ok").alias("is_evidence"),
    )


def cluster_error(message: Column) -> Column:
    """P20: ``struct<code, family, quota, sku, detail>`` of one refused cluster."""
    text = F.coalesce(message, F.lit(""))

    def part(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))

    code = (
        F.when(text.contains(QUOTA_CODE), F.lit(QUOTA_CODE))
        .when(text.contains(PROPERTY_CODE), F.lit(PROPERTY_CODE))
        .otherwise(F.lit("Unknown"))
    )
    is_quota, is_property = code == QUOTA_CODE, code == PROPERTY_CODE
    family = part(r"Standard\s+(\w+)\s+family")
    quota = part(r"quota of (\d+)")
    sku = part(r"value (\S+) for property")
    detail = (
        F.when(
            is_quota,
            F.concat(
                F.lit("dedicated quota for "),
                F.coalesce(family, F.lit("this family")),
                F.lit(" is "),
                F.coalesce(quota, F.lit("0")),
            ),
        )
        .when(
            is_property,
            F.concat(
                F.coalesce(sku, F.lit("this SKU")), F.lit(" is refused at either tier")
            ),
        )
        .otherwise(F.substring(strip(text), 1, 300))
    )
    return F.struct(
        code.alias("code"),
        F.when(is_quota, family).alias("family"),
        F.when(is_quota, quota).alias("quota"),
        F.when(is_property, sku).alias("sku"),
        detail.alias("detail"),
    )
