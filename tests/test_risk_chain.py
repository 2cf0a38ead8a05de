"""The risk chain's written intermediates: facts give what lines give; a changed input is read again."""

from __future__ import annotations

import os
import shutil

import __spark_entry__ as entry
from souk.plans import entities as EN
from souk.plans import reg_risk

SF = "/root/testdata/sf0.001"


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_facts_give_the_rules_what_lines_give(spark):
    base = reg_risk._base(spark, SF)
    facts, limits = EN.entity_order_facts(base), reg_risk._limits(spark, SF)
    assert same(EN.voucher_abuse(base, limits, min_accounts=0), EN.voucher_abuse(base, limits, min_accounts=0, facts=facts))
    none = spark.createDataFrame([], "template_id long, limit int")
    lost = [EN.shipping_abuse(base, none, 0, 1, facts=f) for f in (None, facts)]
    assert same(*lost) and lost[0].filter("shipping_abuse").count()


def test_chain_is_written_once_and_follows_its_input(spark, tmp_path):
    d = str(tmp_path / "sf")
    shutil.copytree(SF, d, copy_function=shutil.copyfile)
    first = entry.queries()["customer_profile"](spark, d)
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan and plan.count("Join") <= 8
    n = reg_risk._base(spark, d).count()
    assert reg_risk._base(spark, d) is reg_risk._base(spark, d)
    half = spark.read.parquet(f"{SF}/lineitem.parquet").filter("l_orderkey % 2 = 0").coalesce(1)
    (tmp_path / "sf" / "lineitem.parquet").unlink()
    half.write.parquet(f"{d}/lineitem.parquet")
    assert 0 < reg_risk._base(spark, d).count() < n


def test_group_tables_of_lines_do_not_wait_for_the_rollup(spark, tmp_path):
    for f in os.listdir(SF):
        shutil.copyfile(f"{SF}/{f}", tmp_path / f)
    before = set(reg_risk._MATERIALISED)
    shipping, products, members = (entry.queries()[q](spark, str(tmp_path)) for q in ("group_shipping", "group_products", "entity_group_map"))
    assert {name for _, name in set(reg_risk._MATERIALISED) - before} == {"base", "customers", "phones", "components", "group-map"}
    assert shipping.count() and products.count()
    made = entry.queries()["group_rollup"](spark, str(tmp_path)).select("entity_group_id")
    assert same(members.select("entity_group_id").distinct(), made)
