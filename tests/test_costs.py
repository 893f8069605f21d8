from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterloom.operators import costs
from meterloom.plans.cost_job import Listings, audit

DISKS = """sub string, name string, managedBy string,
    properties struct<diskState:string, diskSizeGB:int>, sku struct<name:string>"""
NICS = "sub string, name string, properties struct<virtualMachine: struct<id:string>>"
IPS = """sub string, name string, properties struct<ipConfiguration: struct<id:string>>,
    sku struct<name:string>"""
SCANS = "sub string, section string, ok boolean, detail string"
NIC_ID = "/subscriptions/s/providers/Microsoft.Network/networkInterfaces/vm-a10VMNic"
LIVE = ("a", "vm-a10VMNic", (("/vm",),))
DEAD = ("a", "vm-a10VMNic", (None,))
BY = ["sub"]


def disk(name="d", state="Unattached", owner=None, gb=256, sku="Premium_LRS", sub="a"):
    return (sub, name, owner, (state, gb), (sku,))


def ip(name="ip", config=None, sku="Standard", sub="a"):
    return (sub, name, ((config,),) if config else (None,), (sku,))


def scans(*failed, sub="a"):
    sections = (costs.NICS_SECTION, costs.ORPHANS_SECTION, costs.JOBS_SECTION)
    return [(sub, s, s not in failed, "") for s in sections]


def orphan_ips(spark, ips, nics, scan_rows=None, by=BY):
    found = costs.orphan_ips(
        spark.createDataFrame(ips, IPS),
        spark.createDataFrame(nics, NICS),
        spark.createDataFrame(scan_rows or scans(), SCANS),
        by,
    )
    return sorted(r.name for r in found.collect())


@pytest.mark.parametrize(
    ("gb", "sku", "usd"),
    [
        (32, "Premium_LRS", 5.2795), (200, "Premium_LRS", 38.012142), (256, "premium_ZRS", 38.012142),
        (1024, "Premium_LRS", 135.17), (1025, "Premium_LRS", None), (64, "UltraSSD_LRS", None),
        (0, "Premium_LRS", 0.81),
    ],
)
def test_tiers(spark, gb, sku, usd):
    df = spark.range(1).select(costs.disk_monthly_usd(F.lit(gb), F.lit(sku)))
    assert df.first()[0] == usd


def test_disks(spark):
    rows = [disk("loose"), disk("owned", owner="/vm"), disk("attached", state="Attached"),
            disk("case", state="unATTACHED"), ("a", "empty", None, None, None)]
    found = costs.orphan_disks(spark.createDataFrame(rows, DISKS), BY).collect()
    assert sorted(r.name for r in found) == ["case", "loose"]
    assert all(r.bills_when_idle for r in found)


@pytest.mark.parametrize("by", [BY, []])
def test_an_ip_is_judged_through_its_nic(spark, by):
    attached = ip(config=f"{NIC_ID.upper()}/ipConfigurations/c")
    assert orphan_ips(spark, [ip()], [], by=by) == ["ip"]
    assert orphan_ips(spark, [attached], [LIVE], by=by) == []
    assert orphan_ips(spark, [attached], [DEAD], by=by) == ["ip"]
    assert orphan_ips(spark, [attached], [], by=by) == ["ip"]


@pytest.mark.parametrize("by", [BY, []])
def test_without_the_nic_listing_attached_ips_are_withheld(spark, by):
    rows = [ip("loose"), ip("attached", config=f"{NIC_ID}/ipConfigurations/c")]
    failed = scans(costs.NICS_SECTION)
    assert orphan_ips(spark, rows, [], failed, by=by) == ["loose"]
    withheld = costs.withheld_ips(
        spark.createDataFrame(rows, IPS), spark.createDataFrame(failed, SCANS), by
    )
    assert withheld.first().withheld == 1


ITEMS = """sub string, kind string, name string, detail string, sku string, instances long,
    bills_when_idle boolean, monthly_usd double, cost_unknown boolean"""
A100 = "Standard_NC24ads_A100_v4"


def item(name, sku="", n=0, bills=True, monthly=None, unknown=False, kind="x", sub="a"):
    return (sub, kind, name, "", sku, n, bills, monthly, unknown)


def test_item_prices(spark):
    rows = [item("gpu", A100, 2), item("free", bills=False), item("disk", monthly=73.0),
            item("odd", "Standard_Z", 1), item("dark", bills=False, unknown=True),
            item("nan", A100, 1, unknown=True), item("none", A100, 0)]
    found = {
        r.name: (r.rate_known, r.hourly_usd)
        for r in costs.price_items(spark.createDataFrame(rows, ITEMS)).collect()
    }
    assert found == {
        "gpu": (True, pytest.approx(9.918)), "free": (True, 0.0), "disk": (True, pytest.approx(0.1)),
        "odd": (False, None), "dark": (False, None), "nan": (False, None), "none": (True, 0.0),
    }
    rates = spark.createDataFrame([("Standard_Z", 3.0)], "sku string, hourly_usd double")
    priced = costs.price_items(spark.createDataFrame(rows, ITEMS), rates).collect()
    assert {r.name: r.hourly_usd for r in priced}["odd"] == 3.0


def verdict(spark, items, scan_rows):
    priced = costs.price_items(spark.createDataFrame(items, ITEMS))
    return costs.billing_verdict(priced, spark.createDataFrame(scan_rows, SCANS), BY).first()


def test_verdicts(spark):
    assert verdict(spark, [item("g", A100, 1)], scans()).verdict == "billing"
    unknown = verdict(spark, [item("g", "Standard_Z", 1)], scans())
    assert (unknown.verdict, unknown.hourly_usd) == ("cost unknown", None)
    assert verdict(spark, [], scans()).verdict == "nothing"
    assert verdict(spark, [], scans(costs.ORPHANS_SECTION)).verdict == "could not look"
    dark = verdict(spark, [item("d", bills=False, unknown=True)], scans())
    assert (dark.verdict, dark.unread_outside) == ("nothing", 1)


def test_leftovers(spark):
    def found(items, scan_rows):
        priced = costs.price_items(spark.createDataFrame(items, ITEMS))
        return costs.leftovers(priced, spark.createDataFrame(scan_rows, SCANS), BY).first()

    assert found([], scans(costs.ORPHANS_SECTION)).verdict == "unknown"
    assert found([], scans()).verdict == "nothing"
    gap = found([item("d", "UltraSSD", kind="orphaned-disk")], scans())
    assert (gap.verdict, gap.priced_monthly_usd) == ("cost unknown", None)


def test_the_whole_audit(spark):
    """The measured leak of 41.66 USD a month, beside everything else an account can hold."""
    listings = Listings(
        endpoints=spark.createDataFrame(
            [("a", "ep"), ("a", "shell"), ("a", "dark")], "sub string, endpoint string"
        ),
        deployments=spark.createDataFrame(
            [("a", "ep", "blue", A100, 1), ("a", "ep", "green", A100, None)],
            "sub string, endpoint string, deployment string, instance_type string, instance_count long",
        ),
        batch_endpoints=spark.createDataFrame([("a", "batch")], "sub string, name string"),
        clusters=spark.createDataFrame(
            [("a", "idle", "amlcompute", 0, A100, None), ("a", "hot", "amlcompute", 2, A100, "LowPriority"),
             ("a", "unread", "amlcompute", None, A100, None), ("a", "other", "aks", 3, A100, None)],
            "sub string, name string, type string, min_instances int, size string, tier string",
        ),
        jobs=spark.createDataFrame(
            [("a", "run", "Running"), ("a", "wait", "Queued"), ("a", "done", "Completed"), ("a", None, None)],
            "sub string, name string, status string",
        ),
        disks=spark.createDataFrame([disk("os")], DISKS),
        public_ips=spark.createDataFrame([ip("pip", config=f"{NIC_ID}/ipConfigurations/c")], IPS),
        nics=spark.createDataFrame([DEAD], NICS),
        scans=spark.createDataFrame(
            [*scans(), ("a", "deployments of shell", True, ""), ("a", "deployments of dark", False, "403")],
            SCANS,
        ),
    )
    done = audit(listings, BY)
    items = {r.name: r for r in done.items.collect()}
    assert set(items) == {
        "ep/blue", "ep/green", "shell", "dark", "batch", "idle", "hot", "unread", "run", "wait", "os", "pip"
    }
    assert items["ep/blue"].hourly_usd == pytest.approx(4.959)
    assert items["hot"].hourly_usd == pytest.approx(9.918)
    assert [n for n, r in items.items() if r.hourly_usd == 0.0] == ["batch", "idle", "shell"] or {
        n for n, r in items.items() if r.hourly_usd == 0.0
    } == {"batch", "idle", "shell"}
    assert {r.name for r in done.unread.collect()} == {"ep/green", "dark", "unread", "run", "wait"}
    assert {r.name for r in done.unpriced.collect()} == {"ep/green"}
    left = done.leftovers.first()
    assert left.verdict == "leftovers" and left.priced_monthly_usd == pytest.approx(41.66, abs=0.01)
    said = done.verdict.first()
    # The unreadable job record makes the job listing non-evidence.
    assert (said.verdict, said.failed_scans) == ("billing", 2)
    assert done.withheld_ips.count() == 0
