"""Joins by order: the rows of the plain joins, without a shuffle of the wide side."""

from souk.operators.joins import lookup_by_order, merge_by_order


def _frames(spark):
    left = spark.createDataFrame([(1, 1, "a"), (1, None, "b"), (2, 1, "c"), (2, 1, "c"), (3, 9, "d")], "order_code long, k int, w string")
    right = spark.createDataFrame([(1, 1, "x"), (1, 1, "y"), (1, None, "z"), (2, 2, "n")], "order_code long, k int, v string")
    return left, right


def _rows(df):
    return sorted(map(tuple, df.select("order_code", "k", "w", "v").collect()), key=repr)


def test_same_rows_as_the_plain_joins(spark):
    left, right = _frames(spark)
    assert _rows(merge_by_order(left, right, ["k"], null_safe=False)) == _rows(left.join(right, ["order_code", "k"], "left"))
    r = right.toDF("o", "rk", "v")
    safe = left.join(r, left["order_code"].eqNullSafe(r["o"]) & left["k"].eqNullSafe(r["rk"]), "left")
    assert _rows(merge_by_order(left, right, ["k"])) == _rows(safe)


def test_lookup_keeps_rows_and_fan_out(spark):
    left, _ = _frames(spark)
    dim = spark.createDataFrame([(1, "x"), (1, "y"), (7, "n")], "k int, v string")
    assert _rows(lookup_by_order(left, left, ["k"], lambda keys: keys.join(dim, "k", "left"))) == _rows(left.join(dim, "k", "left"))


def test_wide_rows_are_not_shuffled_again(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = _frames(spark)
        plan = merge_by_order(left.repartition("order_code"), right, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(order_code") == 1 and plan.count("hashpartitioning(_r_order_code") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
