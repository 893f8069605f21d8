"""Cloud-cost audit over landed listings.

Null is "unknown" and 0.0 is "free" everywhere; nothing here turns one into the other.
Listings are keyed by ``by`` columns such as subscription and snapshot date. ``scans``
holds ``by..., section, ok, detail``: which listings happened.

Billing items: ``by..., kind, name, detail, sku, instances, bills_when_idle, monthly_usd,
cost_unknown``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


HOURS_PER_MONTH = 730

# USD per hour by VM size.
SKU_HOURLY_USD = {
    "Standard_NC4as_T4_v3": 0.647,
    "Standard_NC8as_T4_v3": 0.925,
    "Standard_NC16as_T4_v3": 1.481,
    "Standard_NC64as_T4_v3": 5.353,
    "Standard_NV6ads_A10_v5": 0.613,
    "Standard_NV12ads_A10_v5": 1.226,
    "Standard_NV18ads_A10_v5": 2.160,
    "Standard_NV36ads_A10_v5": 4.320,
    "Standard_NV36adms_A10_v5": 6.102,
    "Standard_NV72ads_A10_v5": 8.802,
    "Standard_NC24ads_A100_v4": 4.959,
    "Standard_NC48ads_A100_v4": 9.917,
    "Standard_NC96ads_A100_v4": 19.834,
    "Standard_NC40ads_H100_v5": 9.423,
    "Standard_NC80adis_H100_v5": 18.846,
    "Standard_ND96isr_H100_v5": 132.732,
}
# USD per month of a premium disk, by the size its tier reaches up to.
PREMIUM_DISK_USD = {
    4: 0.81,
    8: 1.62,
    16: 3.24,
    32: 5.2795,
    64: 10.207,
    128: 19.71,
    256: 38.012142,
    512: 73.22,
    1024: 135.17,
}
# USD per hour of a public IP.
PUBLIC_IP_HOURLY_USD = {"Standard": 0.005, "Basic": 0.0036, "Global": 0.01}
# Job states that count as active, and the one that holds no nodes yet.
ACTIVE_JOB_STATES = ("Running", "Preparing", "Queued", "Starting")
WAITING_JOB_STATE = "Queued"

ENDPOINTS_SECTION = "online endpoints"
JOBS_SECTION = "jobs"
NICS_SECTION = "network interfaces"
ORPHANS_SECTION = "orphaned disks/IPs (resource group)"
ORPHAN_KINDS = ("orphaned-disk", "orphaned-public-ip")


def _lookup(table: dict, key: Column) -> Column:
    literal = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(literal, key)


def hourly_rate(sku: Column, rates: dict[str, float] = SKU_HOURLY_USD) -> Column:
    """J8 against a price list in code; null when there is no price."""
    return _lookup(rates, sku)


def with_hourly_rate(items: DataFrame, rates: DataFrame) -> DataFrame:
    """J8 against a price table ``sku, hourly_usd`` of any size.

    Of several prices of a SKU the highest counts, so that no item is repeated or priced too
    low; hot SKUs are split by adaptive execution.
    """
    prices = rates.groupBy("sku").agg(F.max("hourly_usd").alias("hourly_usd"))
    return items.join(prices, "sku", "left")


def disk_monthly_usd(
    size_gb: Column, sku: Column, tiers: dict[int, float] = PREMIUM_DISK_USD
) -> Column:
    """The price of the smallest tier that holds the disk.

    Null for a size above every tier and for disks that are not premium.
    """
    price = F.lit(None).cast("double")
    for limit in sorted(tiers, reverse=True):
        price = F.when(size_gb <= limit, F.lit(tiers[limit])).otherwise(price)
    return F.when(F.lower(sku).startswith("premium"), price)


def public_ip_monthly_usd(sku: Column) -> Column:
    """Null for an unknown kind of address."""
    return _lookup(PUBLIC_IP_HOURLY_USD, sku) * HOURS_PER_MONTH


def _item(
    kind: str | Column,
    name: Column,
    detail: Column,
    *,
    sku: Column | None = None,
    instances: Column | None = None,
    bills: Column | bool = False,
    monthly: Column | None = None,
    unknown: Column | bool = False,
) -> list[Column]:
    def given(value: Column | None, default: object, kind: str) -> Column:
        return (F.lit(default) if value is None else value).cast(kind)

    def flag(value: Column | bool) -> Column:
        return F.lit(value) if isinstance(value, bool) else value

    return [
        (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
        name.alias("name"),
        detail.alias("detail"),
        F.coalesce(given(sku, "", "string"), F.lit("")).alias("sku"),
        F.coalesce(given(instances, 0, "bigint"), F.lit(0).cast("bigint")).alias("instances"),
        flag(bills).alias("bills_when_idle"),
        given(monthly, None, "double").alias("monthly_usd"),
        flag(unknown).alias("cost_unknown"),
    ]


def cluster_items(clusters: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Idle charge of compute clusters ``name, type, min_instances, size, tier``.

    A minimum of zero is free, a positive one is always on, and an unread one is unknown:
    not billing, but not free either.
    """
    count, tier = F.col("min_instances"), F.lower(F.coalesce("tier", F.lit("dedicated")))
    kind = (
        F.when(count.isNull(), F.lit("min_instances not reported"))
        .when(count > 0, F.concat(F.lit("min_instances="), count, F.lit(": always on")))
        .otherwise(F.lit("min_instances=0: idle costs nothing"))
    )
    return clusters.filter(F.col("type") == "amlcompute").select(
        *by,
        *_item(
            "compute-cluster",
            F.col("name"),
            F.concat(kind, F.lit(" ("), tier, F.lit(")")),
            sku=F.col("size"),
            instances=F.when(count > 0, count),
            bills=F.coalesce(count > 0, F.lit(False)),
            unknown=count.isNull(),
        ),
    )


def batch_endpoint_items(endpoints: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Batch endpoints scale to nothing between jobs."""
    return endpoints.select(
        *by, *_item("batch-endpoint", F.col("name"), F.lit("scales to 0 between jobs"))
    )


def job_items(jobs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Active jobs; what they cost was never listed. Unreadable records are null names."""
    waiting = F.col("status") == WAITING_JOB_STATE
    nodes = F.when(waiting, F.lit(": waiting for nodes")).otherwise(F.lit(": holding nodes"))
    return jobs.filter(
        F.col("name").isNotNull() & F.col("status").isin(*ACTIVE_JOB_STATES)
    ).select(
        *by,
        *_item(
            "job",
            F.col("name"),
            F.concat(F.lit("status="), F.col("status"), nodes),
            unknown=True,
        ),
    )


def job_scan(jobs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A job listing with unreadable records proves no absence."""
    unreadable = F.count_if(F.col("name").isNull())
    return (
        jobs.groupBy(*by)
        .agg(unreadable.alias("_unreadable"))
        .select(
            *by,
            F.lit(JOBS_SECTION).alias("section"),
            (F.col("_unreadable") == 0).alias("ok"),
            F.when(
                F.col("_unreadable") > 0,
                F.concat(F.col("_unreadable"), F.lit(" job(s) could not be read")),
            )
            .otherwise(F.lit(""))
            .alias("detail"),
        )
    )


def endpoint_items(
    endpoints: DataFrame, deployments: DataFrame, scans: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Deployments bill around the clock; an endpoint without any is a free shell,
    unless its deployments could not be listed, and then it is unknown.

    ``endpoints`` holds ``endpoint``; ``deployments`` holds ``endpoint, deployment,
    instance_type, instance_count``; ``scans`` has a section ``deployments of {endpoint}``.
    """
    key = [*by, "endpoint"]
    # A deployment bills whether its endpoint was listed or not.
    known = endpoints.select(*key, F.lit(True).alias("_known")).distinct()
    serving = deployments.join(known, key, "left")
    count = F.col("instance_count")
    stray = F.when(F.col("_known"), F.lit("")).otherwise(F.lit(", endpoint not listed"))
    running = serving.select(
        *by,
        *_item(
            "online-deployment",
            F.concat_ws("/", "endpoint", "deployment"),
            F.concat(
                F.when(count.isNull(), F.lit("bills 24/7, instance count not reported")).otherwise(
                    F.lit("bills 24/7")
                ),
                stray,
            ),
            sku=F.col("instance_type"),
            instances=count,
            bills=True,
            unknown=count.isNull(),
        ),
    )
    bare = endpoints.join(deployments.select(*key).distinct(), key, "left_anti")
    listed = scans.select(
        *by,
        F.regexp_extract("section", r"\Adeployments of (.*)\z", 1).alias("endpoint"),
        F.col("ok").alias("_listed"),
    ).filter(F.col("endpoint") != "").groupBy(*key).agg(F.bool_and("_listed").alias("_listed"))
    looked = F.coalesce(F.col("_listed"), F.lit(False))
    shells = bare.join(listed, key, "left").select(
        *by,
        *_item(
            "online-endpoint",
            F.col("endpoint"),
            F.when(looked, F.lit("no deployments, no compute cost")).otherwise(
                F.lit("deployments could not be listed")
            ),
            unknown=~looked,
        ),
    )
    return running.unionByName(shells)


def orphaned_nics(nics: DataFrame) -> DataFrame:
    """Network interfaces without a machine."""
    return nics.filter(F.col("properties.virtualMachine.id").isNull())


def nic_name(config_id: Column) -> Column:
    """The interface an IP configuration id points at, lower case; '' if none."""
    return F.regexp_extract(F.lower(config_id), r"networkinterfaces/([^/]+)", 1)


def orphan_disks(disks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Disks nothing claims, in state unattached, priced by tier."""
    unclaimed = F.coalesce("managedBy", F.lit("")) == ""
    unattached = F.lower("properties.diskState") == "unattached"
    size = F.col("properties.diskSizeGB")
    held = F.coalesce(F.concat(size, F.lit(" GB")), F.lit("size not reported,"))
    sku = F.coalesce("sku.name", F.lit(""))
    return disks.filter(unclaimed & unattached).select(
        *by,
        *_item(
            "orphaned-disk",
            F.col("name"),
            F.concat(held, F.lit(" "), sku, F.lit(", unattached")),
            sku=sku,
            bills=True,
            monthly=disk_monthly_usd(size, sku),
        ),
    )


def _ip_items(ips: DataFrame, by: Sequence[str]) -> DataFrame:
    sku = F.coalesce("sku.name", F.lit(""))
    where = F.when(
        _config_id() != "", F.lit(" public IP, attached to a NIC with no VM")
    ).otherwise(F.lit(" public IP, not attached to anything"))
    return ips.select(
        *by,
        *_item(
            "orphaned-public-ip",
            F.col("name"),
            F.concat(sku, where),
            sku=sku,
            bills=True,
            monthly=public_ip_monthly_usd(sku),
        ),
    )


def _config_id() -> Column:
    return F.coalesce("properties.ipConfiguration.id", F.lit(""))


def _attached_by_scan(
    ips: DataFrame, scans: DataFrame, by: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Attached addresses, split by whether their interface listing happened."""
    attached = ips.filter(_config_id() != "")
    read = scans.filter((F.col("section") == NICS_SECTION) & F.col("ok"))
    if not by:
        # Without account keys there is a single listing, so one flag decides for all.
        happened = read.agg((F.count(F.lit(1)) > 0).alias("_ok")).scalar()
        return attached.filter(happened), attached.filter(~happened)
    accounts = read.select(*by).distinct()
    # A row an account: small beside the addresses, and split where one account is hot.
    return attached.join(accounts, list(by), "left_semi"), attached.join(
        accounts, list(by), "left_anti"
    )


def orphan_ips(
    ips: DataFrame, nics: DataFrame, scans: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Addresses attached to nothing, or to an interface that is dead or gone.

    An attached address is judged only where the interfaces were listed; elsewhere it is
    withheld (see :func:`withheld_ips`), not reported.
    """
    loose = ips.filter(_config_id() == "")
    judged, _ = _attached_by_scan(ips, scans, by)
    live = (
        nics.filter(F.col("properties.virtualMachine.id").isNotNull())
        .select(*by, F.lower("name").alias("_nic"))
        .distinct()
    )
    dead = judged.withColumn("_nic", nic_name(_config_id())).join(
        live, [*by, "_nic"], "left_anti"
    )
    return _ip_items(loose.unionByName(dead.select(*ips.columns)), by)


def withheld_ips(ips: DataFrame, scans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many attached addresses could not be judged."""
    _, withheld = _attached_by_scan(ips, scans, by)
    return withheld.groupBy(*by).agg(F.count(F.lit(1)).alias("withheld"))


def price_items(items: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """Add ``rate_known``, ``hourly_usd`` and ``item_monthly_usd``.

    Unknown stays null; only what truly does not bill is 0.0.
    """
    priced = (
        items.withColumn("hourly_usd", hourly_rate(F.col("sku")))
        if rates is None
        else with_hourly_rate(items, rates)
    )
    metered_monthly = F.coalesce(F.col("monthly_usd") != 0, F.lit(False))
    bills, unknown = F.col("bills_when_idle"), F.col("cost_unknown")
    known = (
        F.when(unknown, F.lit(False))
        .when(~bills, F.lit(True))
        .when(metered_monthly, F.lit(True))
        .otherwise(F.col("hourly_usd").isNotNull())
    )
    hourly = (
        F.when(~F.col("rate_known"), F.lit(None).cast("double"))
        .when(~bills, F.lit(0.0))
        .when(metered_monthly, F.col("monthly_usd") / HOURS_PER_MONTH)
        .otherwise(F.col("hourly_usd") * F.greatest("instances", F.lit(0)))
    )
    return (
        priced.withColumn("rate_known", known)
        .withColumn("hourly_usd", hourly)
        .withColumn("item_monthly_usd", F.col("hourly_usd") * HOURS_PER_MONTH)
    )


def in_report_order(priced: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """L4: what bills first, then by kind."""
    return priced.orderBy(*by, F.desc("bills_when_idle"), "kind", "name")


def unpriced(priced: DataFrame) -> DataFrame:
    """Items that bill at a rate nobody knows. Never worth 0."""
    return priced.filter(F.col("bills_when_idle") & ~F.col("rate_known"))


def unread(priced: DataFrame) -> DataFrame:
    """Items that exist because something about them could not be read."""
    return priced.filter(F.col("cost_unknown"))


def inventory_totals(priced: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals over priced items only, with the counts of what they leave out."""
    bills, known = F.col("bills_when_idle"), F.col("rate_known")
    return priced.groupBy(*by).agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(bills).alias("billing"),
        F.count_if(bills & ~known).alias("unpriced"),
        F.count_if(F.col("cost_unknown")).alias("unread"),
        F.count_if(F.col("cost_unknown") & ~bills).alias("unread_outside"),
        F.sum(F.when(known, F.col("hourly_usd"))).alias("hourly_usd"),
        F.sum(F.when(known, F.col("item_monthly_usd"))).alias("monthly_usd"),
    )


def scan_totals(scans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    failed = ~F.coalesce(F.col("ok"), F.lit(False))
    return scans.groupBy(*by).agg(
        F.count(F.lit(1)).alias("scans"),
        F.count_if(failed).alias("failed_scans"),
        F.count_if(failed & (F.col("section") == ORPHANS_SECTION)).alias("failed_orphan_scans"),
    )


def _with_scans(totals: DataFrame, scans: DataFrame, by: Sequence[str]) -> DataFrame:
    """Totals next to scan counts; an account known to either side has a row."""
    counted = scan_totals(scans, by)
    if by:
        joined = totals.join(counted, list(by), "full_outer")
    else:
        # Both sides are single rows.
        joined = totals.withColumn("_one", F.lit(1)).join(
            counted.withColumn("_one", F.lit(1)), "_one", "full_outer"
        ).drop("_one")
    counts = [
        c
        for c in joined.columns
        if c not in (*by, "hourly_usd", "monthly_usd", "priced_monthly_usd")
    ]
    return joined.fillna(0, counts)


def billing_verdict(
    priced: DataFrame, scans: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """What may be said about an account. Never ``nothing`` while a scan failed or none ran.

    ``hourly_usd`` and ``monthly_usd`` are null unless some billing item has a price.
    """
    joined = _with_scans(inventory_totals(priced, by), scans, by)
    some_price = F.col("unpriced") < F.col("billing")
    verdict = (
        F.when((F.col("billing") > 0) & some_price, F.lit("billing"))
        .when(F.col("billing") > 0, F.lit("cost unknown"))
        .when((F.col("failed_scans") > 0) | (F.col("scans") == 0), F.lit("could not look"))
        .otherwise(F.lit("nothing"))
    )
    return (
        joined.withColumn("verdict", verdict)
        .withColumn("hourly_usd", F.when(some_price, F.col("hourly_usd")))
        .withColumn("monthly_usd", F.when(some_price, F.col("monthly_usd")))
        .drop("failed_orphan_scans")
    )


def leftovers(priced: DataFrame, scans: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What deleted machines left behind, and whether that can be known."""
    orphan = priced.filter(F.col("kind").isin(*ORPHAN_KINDS))
    known = F.col("rate_known")
    totals = orphan.groupBy(*by).agg(
        F.count(F.lit(1)).alias("orphans"),
        F.count_if(~known).alias("unpriced"),
        F.sum(F.when(known, F.col("item_monthly_usd"))).alias("priced_monthly_usd"),
    )
    joined = _with_scans(totals, scans, by)
    verdict = (
        F.when((F.col("orphans") == 0) & (F.col("failed_orphan_scans") > 0), F.lit("unknown"))
        .when(F.col("orphans") == 0, F.lit("nothing"))
        .when(F.col("unpriced") == F.col("orphans"), F.lit("cost unknown"))
        .otherwise(F.lit("leftovers"))
    )
    return joined.withColumn("verdict", verdict).drop("scans", "failed_scans")
