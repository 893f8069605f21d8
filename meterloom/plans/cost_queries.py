"""Registered queries: the cost audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.operators import costs
from meterloom.plans.inputs import (
    cluster_rows,
    deployment_rows,
    disk_rows,
    endpoint_rows,
    endpoint_scan_rows,
    ip_rows,
    job_rows,
    nic_rows,
    scan_rows,
    with_sql,
)
from meterloom.plans.registry import query

BY = ["subscription"]
_PRICE = "CASE WHEN hourly IS NOT NULL THEN round(hourly * greatest(instances, 0), 6) END"


def orphans(spark: SparkSession, folder: str) -> DataFrame:
    ips = costs.orphan_ips(
        ip_rows(spark, folder), nic_rows(spark, folder), scan_rows(spark, folder), BY
    )
    return costs.orphan_disks(disk_rows(spark, folder), BY).unionByName(ips)


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Every item of every listing, priced."""
    listings = [
        orphans(spark, folder),
        costs.cluster_items(cluster_rows(spark, folder), BY),
        costs.job_items(job_rows(spark, folder), BY),
        costs.endpoint_items(
            endpoint_rows(spark, folder),
            deployment_rows(spark, folder),
            endpoint_scan_rows(spark, folder),
            BY,
        ),
    ]
    return costs.price_items(reduce(DataFrame.unionByName, listings))


INVENTORY = (
    with_sql("disks", "ips", "rates", "clusters", "jobs", "endpoints")
    + """,
    raw AS (
        SELECT subscription, 'orphaned-disk' AS kind, name, sku, 0 AS instances,
               true AS bills, monthly_usd, false AS unknown
        FROM priced_disks WHERE loose AND NOT claimed
        UNION ALL SELECT subscription, 'orphaned-public-ip', name, sku, 0, true, monthly_usd, false
        FROM orphan_ips
        UNION ALL SELECT subscription, 'compute-cluster', name, sku, coalesce(min_instances, 0),
               coalesce(min_instances > 0, false), NULL, min_instances IS NULL FROM clusters
        UNION ALL SELECT subscription, 'job', name, '', 0, false, NULL, true FROM jobs
               WHERE name IS NOT NULL AND status IN ('Running', 'Queued', 'Starting')
        UNION ALL SELECT subscription, kind, name, sku, instances, bills_when_idle, NULL,
               cost_unknown FROM endpoint_items),
    known AS (
        SELECT r.*, hourly, CASE WHEN unknown THEN false WHEN NOT bills THEN true
                    WHEN monthly_usd IS NOT NULL THEN true ELSE hourly IS NOT NULL END AS rate_known
        FROM raw r LEFT JOIN rates USING (sku)),
    items AS (
        SELECT *, CASE WHEN NOT rate_known THEN NULL WHEN NOT bills THEN 0
                       WHEN monthly_usd IS NOT NULL THEN monthly_usd / 730
                       ELSE hourly * instances END::DOUBLE AS hourly_usd
        FROM known),
    scan_counts AS (
        SELECT subscription, count(*)::BIGINT AS scans,
               (count(*) FILTER (WHERE NOT ok))::BIGINT AS failed_scans,
               (count(*) FILTER (WHERE NOT ok AND section LIKE 'orphaned%'))::BIGINT
                   AS failed_orphan_scans
        FROM scans GROUP BY 1)"""
).replace("WITH ", with_sql("scans") + ", ", 1)


@query(
    "cluster_items",
    with_sql("clusters")
    + """ SELECT subscription, name, sku, coalesce(min_instances, 0)::BIGINT AS instances,
             coalesce(min_instances > 0, false) AS bills_when_idle,
             min_instances IS NULL AS cost_unknown,
             CASE WHEN min_instances IS NULL THEN 'min_instances not reported'
                  WHEN min_instances > 0 THEN 'min_instances=' || min_instances || ': always on'
                  ELSE 'min_instances=0: idle costs nothing' END || ' (' || tier || ')' AS detail
          FROM clusters""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return costs.cluster_items(cluster_rows(spark, folder), BY).drop("kind", "monthly_usd")


@query(
    "batch_endpoint_items",
    """SELECT o_orderkey % 5 AS subscription,
              CASE WHEN o_orderkey % 23 = 0 THEN 'gone-' ELSE '' END || o_orderkey AS name,
              false AS bills_when_idle, false AS cost_unknown FROM orders""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    endpoints = endpoint_rows(spark, folder).withColumnRenamed("endpoint", "name")
    return costs.batch_endpoint_items(endpoints, BY).select(
        "subscription", "name", "bills_when_idle", "cost_unknown"
    )


@query(
    "job_items",
    with_sql("jobs")
    + """ SELECT subscription, name, 'status=' || status || CASE WHEN status = 'Queued'
             THEN ': waiting for nodes' ELSE ': holding nodes' END AS detail
          FROM jobs WHERE name IS NOT NULL AND status IN ('Running', 'Queued', 'Starting')""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return costs.job_items(job_rows(spark, folder), BY).select("subscription", "name", "detail")


@query(
    "job_scan",
    with_sql("jobs")
    + """ SELECT subscription, 'jobs' AS section, count(*) = count(name) AS ok,
             CASE WHEN count(*) > count(name)
                  THEN (count(*) - count(name)) || ' job(s) could not be read' ELSE '' END AS detail
          FROM jobs GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return costs.job_scan(job_rows(spark, folder), BY)


@query(
    "endpoint_items",
    with_sql("endpoints")
    + """ SELECT subscription, kind, name, sku, instances::BIGINT AS instances, bills_when_idle,
             cost_unknown FROM endpoint_items""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return costs.endpoint_items(
        endpoint_rows(spark, folder),
        deployment_rows(spark, folder),
        endpoint_scan_rows(spark, folder),
        BY,
    ).drop("detail", "monthly_usd")


@query(
    "sku_rates",
    with_sql("rates", "endpoints")
    + """ SELECT endpoint, deployment, sku, hourly AS hourly_usd
          FROM deployments LEFT JOIN rates USING (sku)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The price join against a table of rates."""
    rates = spark.createDataFrame(
        list(costs.SKU_HOURLY_USD.items()), "sku string, hourly_usd double"
    )
    rows = deployment_rows(spark, folder).withColumnRenamed("instance_type", "sku")
    return costs.with_hourly_rate(rows, rates).select(
        "endpoint", "deployment", "sku", "hourly_usd"
    )


@query(
    "disk_tier_cost",
    with_sql("disks") + " SELECT name, gb::BIGINT AS gb, sku, monthly_usd FROM priced_disks",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    size, sku = F.col("properties.diskSizeGB"), F.col("sku.name")
    return disk_rows(spark, folder).select(
        "name",
        size.cast("bigint").alias("gb"),
        sku.alias("sku"),
        costs.disk_monthly_usd(size, sku).alias("monthly_usd"),
    )


@query(
    "public_ip_cost",
    with_sql("ips") + " SELECT name, round(monthly_usd, 6) AS monthly_usd FROM ips",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    price = costs.public_ip_monthly_usd(F.col("sku.name"))
    return ip_rows(spark, folder).select("name", F.round(price, 6).alias("monthly_usd"))


@query("orphaned_nics", with_sql("ips") + " SELECT subscription, nic FROM nics WHERE NOT live")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return costs.orphaned_nics(nic_rows(spark, folder)).select(
        "subscription", F.lower("name").alias("nic")
    )


@query(
    "orphan_ips",
    with_sql("ips") + " SELECT subscription, name, sku, round(monthly_usd, 6) AS monthly_usd FROM orphan_ips",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = costs.orphan_ips(
        ip_rows(spark, folder), nic_rows(spark, folder), scan_rows(spark, folder), BY
    )
    return found.select(
        "subscription", "name", "sku", F.round("monthly_usd", 6).alias("monthly_usd")
    )


@query(
    "withheld_ips",
    with_sql("ips")
    + """ SELECT subscription, count(*)::BIGINT AS withheld FROM ips
          WHERE nic IS NOT NULL AND subscription = 3 GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return costs.withheld_ips(ip_rows(spark, folder), scan_rows(spark, folder), BY)


@query(
    "orphan_disks",
    with_sql("disks")
    + """ SELECT subscription, name, sku, monthly_usd, 
             coalesce(gb || ' GB ', 'size not reported, ') || sku || ', unattached' AS detail
          FROM priced_disks WHERE loose AND NOT claimed""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return costs.orphan_disks(disk_rows(spark, folder), BY).select(
        "subscription", "name", "sku", "monthly_usd", "detail"
    )


@query(
    "priced_items",
    INVENTORY
    + """ SELECT subscription, kind, name, rate_known, round(hourly_usd, 6) AS hourly_usd,
             round(hourly_usd * 730, 4) AS item_monthly_usd FROM items""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return inventory(spark, folder).select(
        "subscription",
        "kind",
        "name",
        "rate_known",
        F.round("hourly_usd", 6).alias("hourly_usd"),
        F.round("item_monthly_usd", 4).alias("item_monthly_usd"),
    )


@query(
    "inventory_order",
    INVENTORY + " SELECT subscription, bills AS bills_when_idle, kind, name FROM items",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return costs.in_report_order(inventory(spark, folder), BY).select(
        "subscription", "bills_when_idle", "kind", "name"
    )


@query(
    "unpriced_items",
    INVENTORY + " SELECT subscription, kind, name, sku FROM items WHERE bills AND NOT rate_known",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return costs.unpriced(inventory(spark, folder)).select("subscription", "kind", "name", "sku")


@query("unread_items", INVENTORY + " SELECT subscription, kind, name FROM items WHERE unknown")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return costs.unread(inventory(spark, folder)).select("subscription", "kind", "name")


_TOTALS = """totals AS (
    SELECT subscription, count(*)::BIGINT AS items,
           (count(*) FILTER (WHERE bills))::BIGINT AS billing,
           (count(*) FILTER (WHERE bills AND NOT rate_known))::BIGINT AS unpriced,
           (count(*) FILTER (WHERE unknown))::BIGINT AS unread,
           (count(*) FILTER (WHERE unknown AND NOT bills))::BIGINT AS unread_outside,
           round(sum(hourly_usd), 2) AS hourly_usd, round(sum(hourly_usd * 730), 0) AS monthly_usd
    FROM items GROUP BY 1)"""


def _rounded(totals: DataFrame) -> DataFrame:
    return totals.withColumn("hourly_usd", F.round("hourly_usd", 2)).withColumn(
        "monthly_usd", F.round("monthly_usd", 0)
    )


@query("inventory_totals", f"{INVENTORY}, {_TOTALS} SELECT * FROM totals")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(costs.inventory_totals(inventory(spark, folder), BY))


@query(
    "billing_verdict",
    f"""{INVENTORY}, {_TOTALS}, merged AS (
        SELECT subscription, coalesce(items, 0) AS items, coalesce(billing, 0) AS billing,
               coalesce(unpriced, 0) AS unpriced, coalesce(unread, 0) AS unread,
               coalesce(unread_outside, 0) AS unread_outside, hourly_usd, monthly_usd,
               coalesce(scans, 0) AS scans, coalesce(failed_scans, 0) AS failed_scans
        FROM totals FULL JOIN scan_counts USING (subscription))
    SELECT * REPLACE (
               CASE WHEN unpriced < billing THEN hourly_usd END AS hourly_usd,
               CASE WHEN unpriced < billing THEN monthly_usd END AS monthly_usd),
           CASE WHEN billing > 0 AND unpriced < billing THEN 'billing'
                WHEN billing > 0 THEN 'cost unknown' WHEN failed_scans > 0 OR scans = 0 THEN 'could not look'
                ELSE 'nothing' END AS verdict FROM merged""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    priced = inventory(spark, folder)
    return _rounded(costs.billing_verdict(priced, scan_rows(spark, folder), BY))


@query(
    "leftovers",
    f"""{INVENTORY}, found AS (
        SELECT subscription, count(*)::BIGINT AS orphans,
               (count(*) FILTER (WHERE NOT rate_known))::BIGINT AS unpriced,
               round(sum(hourly_usd * 730), 1) AS priced_monthly_usd
        FROM items WHERE kind LIKE 'orphaned%' GROUP BY 1),
    merged AS (
        SELECT subscription, coalesce(orphans, 0) AS orphans, coalesce(unpriced, 0) AS unpriced,
               priced_monthly_usd, coalesce(failed_orphan_scans, 0) AS failed_orphan_scans
        FROM found FULL JOIN scan_counts USING (subscription))
    SELECT *, CASE WHEN orphans = 0 AND failed_orphan_scans > 0 THEN 'unknown'
                   WHEN orphans = 0 THEN 'nothing' WHEN unpriced = orphans THEN 'cost unknown'
                   ELSE 'leftovers' END AS verdict FROM merged""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    priced = costs.price_items(orphans(spark, folder))
    found = costs.leftovers(priced, scan_rows(spark, folder), BY)
    return found.withColumn("priced_monthly_usd", F.round("priced_monthly_usd", 1))
