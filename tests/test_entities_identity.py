"""Golden cases F-abuse, F-ship, F-component, F-label, F-score, F-reseller
and the connected-components property against a plain union-find."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from souk.plans import entities as EN
from souk.plans import identity as ID
from souk.plans import risk as RK

LINES = (
    "order_code long, customer_id long, device_id string, phone string, customer_status string, voucher_code string, "
    "voucher_discount decimal(18,0), free_shipping_id long, platform_shipping decimal(18,2)"
)


def _lines(spark, uses, accounts, fs=None):
    rows, k = [], 0
    for code, n, disc in uses:
        for _ in range(n):
            rows.append((k, k % accounts, "D1", "1700", "Delivered", code, D(disc), None, D("0")))
            k += 1
    for fid, n, sub in fs or []:
        for _ in range(n):
            rows.append((k, k % accounts, "D1", "1700", "Delivered", None, D("0"), fid, D(sub)))
            k += 1
    # make sure all accounts appear
    for a in range(accounts):
        rows.append((k, a, "D1", "1700", "Delivered", None, D("0"), None, D("0")))
        k += 1
    return spark.createDataFrame(rows, LINES)


def test_voucher_abuse_golden(spark):
    limits = spark.createDataFrame([("SALE", 2)], "code string, limit int")
    uses = [("APG1", 2, "5"), ("APH2", 1, "5"), ("WINNERX", 1, "5"), ("SALE", 3, "30")]
    r = EN.voucher_abuse(_lines(spark, uses, 6), limits).filter("entity_type = 'DeviceID'").first()
    assert r.abused_vouchers == "APG1 [2], SALE [3], Multiple APG/APH vouchers [2]"
    assert (r.total_voucher_count, int(r.voucher_subsidy_lost), r.abused_voucher_count, r.voucher_abuse) == (7, 90, 7, True)
    r5 = EN.voucher_abuse(_lines(spark, uses, 5), limits).filter("entity_type = 'DeviceID'").first()
    assert (r5.voucher_abuse, r5.abused_vouchers, r5.total_voucher_count, int(r5.voucher_subsidy_lost)) == (False, "", 0, 0)


def test_shipping_abuse_golden(spark):
    limits = spark.createDataFrame([(8, 10)], "template_id long, limit int")
    fs = [(0, 50, "1"), (7, 11, "2"), (8, 10, "3")]
    r = EN.shipping_abuse(_lines(spark, [], 6, fs), limits).filter("entity_type = 'DeviceID'").first()
    assert (r.shipping_abuse, float(r.shipping_subsidy_lost), r.abused_shipping_id_count) == (True, 22.0, 11)
    r5 = EN.shipping_abuse(_lines(spark, [], 5, fs), limits).filter("entity_type = 'DeviceID'").first()
    assert (r5.shipping_abuse, float(r5.shipping_subsidy_lost), r5.abused_shipping_id_count) == (False, 0.0, 11)


def test_components_golden(spark):
    cust = spark.createDataFrame(
        [("Phone", "P1", 1), ("Phone", "P1", 2), ("Phone", "P2", 2), ("DeviceID", "D1", 2), ("DeviceID", "D1", 9),
         ("Phone", "P3", 3), ("Phone", "P4", 4), ("Phone", "P5", 5)],
        "entity_type string, entity string, customer_id long",
    )
    addr = spark.createDataFrame(
        [("Phone", "P3", "155"), ("Phone", "P4", "155"), ("Phone", "P5", "P1")],
        "entity_type string, entity string, phone_from_address string",
    )
    comp = {r.entity: r.component for r in ID.entity_components(cust, addr).collect()}
    groups = {}
    for e, c in comp.items():
        groups.setdefault(c, set()).add(e)
    assert sorted(map(sorted, groups.values())) == [["D1", "P1", "P2"], ["P3", "P4"], ["P5"]]


def _union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in list(parent)}


@pytest.mark.parametrize("hub_links", [10_000, 3])
def test_components_match_union_find(spark, hub_links):
    rnd = random.Random(7)
    n = 60
    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(0, 20)]  # chain
    edges += [("n030", f"n{j:03d}") for j in range(31, 40)]  # star
    edges += [(f"m{j:03d}", "n038") for j in range(20)] + [("n038", f"k{j:03d}") for j in range(20)]  # hub on both ends
    edges += [("n040", "n041"), ("n041", "n042"), ("n042", "n040")]  # cycle
    edges += [(f"n{rnd.randrange(43, n):03d}", f"n{rnd.randrange(43, n):03d}") for _ in range(10)]
    edges += [("n099", "n099")]  # isolated (self loop only)
    df = spark.createDataFrame(edges, "src string, dst string")
    got = {r.node: r.component for r in ID.connected_components(df, hub_links).collect()}
    want = _union_find(edges)
    assert got == {k: v for k, v in want.items()}


GROUPS = (
    "entity_group_id string, entity_type string, gis long, cancel_count long, total_returned long, "
    "total_invalid_return long, num_of_accounts long, abuse_type string"
)


def test_labels_golden(spark):
    g = spark.createDataFrame(
        [("a", "Phone", 10, 4, 2, 0, 1, "None"), ("b", "Phone", 5, 5, 0, 5, 1, None),
         ("c", "Phone", 10, 0, 0, 4, 1, "VoucherAbuser"), ("d", "Phone", 1, 0, 0, 0, 5, None),
         ("e", "Phone", 1, 0, 0, 0, 6, None)],
        GROUPS,
    )
    got = {r.entity_group_id: r.abuse_type for r in RK.abuse_labels(g).collect()}
    assert got == {"a": "High Cancel/Return", "b": "None", "c": "High Invalid Return; VoucherAbuser", "d": "None",
                   "e": "Multiple Accounts"}


def test_score_golden(spark):
    g = spark.createDataFrame(
        [("a", "High Cancel/Return; Reseller"), ("b", "VoucherAbuser"), ("c", "Multiple Accounts"), ("d", "None")],
        "entity_group_id string, abuse_type string",
    )
    got = {r.entity_group_id: (r.risk_score, r.category) for r in RK.risk_score(g).collect()}
    assert got == {"a": (6, "High Risk"), "b": (3, "Medium Risk"), "c": (2, "Low Risk"), "d": (0, "Low Risk")}


def test_reseller_golden(spark):
    mx = dt.date(2025, 9, 30)
    prod = spark.createDataFrame(
        [("g1", mx - dt.timedelta(days=30), "X", 16), ("g2", mx - dt.timedelta(days=30), "X", 15),
         ("g3", mx - dt.timedelta(days=31), "X", 16), ("g0", mx, "Y", 1)],
        "entity_group_id string, order_date date, deepest_category string, gis long",
    )
    got = {r.entity_group_id for r in RK.reseller_groups(prod, since="2025-10-01").collect()}
    assert got == {"g1"}
    late = spark.createDataFrame(
        [("g4", dt.date(2025, 10, 3), "X", 8), ("g4", dt.date(2025, 11, 3), "X", 8), ("g5", dt.date(2026, 3, 1), "Z", 1)],
        "entity_group_id string, order_date date, deepest_category string, gis long",
    )
    assert {r.entity_group_id for r in RK.reseller_groups(late, since="2025-10-01").collect()} == set()


def test_loyal_midnight_is_strict(spark):
    g = spark.createDataFrame(
        [("a", 0, D("100"), dt.date(2025, 1, 1), dt.date(2025, 6, 1), "Low Risk"),
         ("b", 0, D("100"), dt.date(2025, 1, 1), dt.date(2025, 6, 2), "Low Risk"),
         ("c", 0, D("1"), dt.date(2025, 1, 1), dt.date(2025, 6, 2), "Low Risk")],
        "entity_group_id string, risk_score int, gmv decimal(18,2), first_order_date date, last_order_date date, category string",
    )
    got = {r.entity_group_id: r.category for r in RK.loyal_customers(g, "2025-07-10 09:00:00").collect()}
    assert got == {"a": "Low Risk", "b": "Loyal Customer", "c": "Low Risk"}
    assert RK.loyal_customers(g, "2025-07-10 09:00:00").filter(F.col("category") == "Loyal Customer").count() == 1


def test_components_links_are_contracted(spark, monkeypatch):
    """Rounds run over distinct links of entities, not over one link per customer; names and groups are the plain ones."""
    edges = [(f"E:Phone:{i % 3}", f"C:{i}") for i in range(600)] + [(f"E:DeviceID:{i % 2}", f"C:{i}") for i in range(0, 600, 3)]
    edges += [("E:Phone:8", "P:77"), ("E:Phone:9", "P:77"), ("E:Phone:9", "C:0900"), ("E:Phone:lone", "P:1"), ("E:Phone:8", "P:77")]
    df = spark.createDataFrame(edges, "src string, dst string")
    plain = {(r.node, r.component) for r in ID.connected_components(df).collect() if r.node.startswith("E:")}
    seen = []
    whole = ID.connected_components
    monkeypatch.setattr(ID, "connected_components", lambda e: (seen.append(e.count()), whole(e))[1])
    customers = df.filter("dst like 'C:%'").selectExpr("split(src, ':')[1] AS entity_type", "split(src, ':')[2] AS entity", "substring(dst, 3) AS customer_id")
    phones = df.filter("dst like 'P:%'").selectExpr("split(src, ':')[1] AS entity_type", "split(src, ':')[2] AS entity", "substring(dst, 3) AS phone_from_address")
    got = {(f"E:{r.entity_type}:{r.entity}", r.component) for r in ID.entity_components(customers, phones).collect()}
    assert got == plain
    assert {c for n, c in got if n.startswith("E:Phone:") and n[-1] in "89"} == {"C:0900"}
    assert max(seen) < 20
