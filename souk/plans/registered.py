"""Registration of every query key of the coverage table."""

from __future__ import annotations

from souk.oracle import kpi_sql
from souk.plans import kpi
from souk.plans.category import category_tree
from souk.registry import AS_OF, SINCE, register
from souk.sources import testviews as tv


# ---------------------------------------------------------------- KPIs
# The fixture's categories have other names: two of them stand for the bikes.
BIKES_TEST = ["Supplier#000000003", "Supplier#000000005"]


@register("daily_kpis", lambda: kpi_sql.daily_kpis_sql(SINCE, AS_OF, BIKES_TEST))
def _daily_kpis(spark, d):
    tree = category_tree(tv.categories(spark, d), tv.industries(spark, d))
    return kpi.daily_kpis(tv.order_lines(spark, d), tree, SINCE, AS_OF, bike_categories=BIKES_TEST)


@register("new_returning", lambda: kpi_sql.new_returning_sql(SINCE, AS_OF))
def _new_returning(spark, d):
    return kpi.new_returning(tv.order_lines(spark, d), SINCE, AS_OF)


@register("repurchase_gap", lambda: kpi_sql.repurchase_gap_sql(SINCE, AS_OF))
def _repurchase_gap(spark, d):
    return kpi.repurchase_gap(tv.order_lines(spark, d), SINCE, AS_OF)


@register("repurchase_cohort", lambda: kpi_sql.repurchase_cohort_sql(SINCE, AS_OF))
def _repurchase_cohort(spark, d):
    return kpi.repurchase_cohort(tv.order_lines(spark, d), SINCE, AS_OF)


@register("daily_created_orders", kpi_sql.daily_created_orders_sql)
def _daily_created_orders(spark, d):
    return kpi.daily_created_orders(tv.order_lines(spark, d))
