"""The cost audit end to end, over landed listings of many accounts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.operators import costs
from meterloom.session import stage


@dataclass(frozen=True)
class Listings:
    """Landed listings; ``scans`` tells which of them happened."""

    endpoints: DataFrame
    deployments: DataFrame
    batch_endpoints: DataFrame
    clusters: DataFrame
    jobs: DataFrame
    disks: DataFrame
    public_ips: DataFrame
    nics: DataFrame
    scans: DataFrame


@dataclass(frozen=True)
class Audit:
    items: DataFrame
    verdict: DataFrame
    leftovers: DataFrame
    unpriced: DataFrame
    unread: DataFrame
    withheld_ips: DataFrame


def audit(listings: Listings, by: Sequence[str], rates: DataFrame | None = None) -> Audit:
    """Price every item once, stage the items, and derive the verdicts from them."""
    keys = list(by)
    items = reduce(
        DataFrame.unionByName,
        [
            costs.endpoint_items(
                listings.endpoints, listings.deployments, listings.scans, keys
            ),
            costs.batch_endpoint_items(listings.batch_endpoints, keys),
            costs.cluster_items(listings.clusters, keys),
            costs.job_items(listings.jobs, keys),
            costs.orphan_disks(listings.disks, keys),
            costs.orphan_ips(listings.public_ips, listings.nics, listings.scans, keys),
        ],
    )
    priced = stage(costs.price_items(items, rates), "items")
    # A job listing with unreadable records is no evidence, whatever its own status said.
    holes = (
        costs.job_scan(listings.jobs, keys)
        .filter("NOT ok")
        .select(*keys, "section", F.col("detail").alias("_hole"))
    )
    scans = (
        listings.scans.select(*keys, "section", "ok", "detail")
        .join(holes, [*keys, "section"], "left")
        .select(
            *keys,
            "section",
            (F.col("ok") & F.col("_hole").isNull()).alias("ok"),
            F.coalesce("_hole", "detail").alias("detail"),
        )
    )
    return Audit(
        items=costs.in_report_order(priced, keys),
        verdict=costs.billing_verdict(priced, scans, keys),
        leftovers=costs.leftovers(priced, scans, keys),
        unpriced=costs.unpriced(priced),
        unread=costs.unread(priced),
        withheld_ips=costs.withheld_ips(listings.public_ips, listings.scans, keys),
    )
