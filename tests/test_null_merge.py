"""Null-safe merge: rows as in pandas, NULL keys spread over tasks."""

from __future__ import annotations

import statistics

import pandas as pd
from pyspark.sql import functions as F

from souk.operators.joins import merge_left_spread


def test_rows_equal_pandas(spark):
    left = [(k, None if k % 3 == 0 else f"c{k % 7}", None if k % 5 == 0 else k % 4) for k in range(300)]
    right = [("c1", 1, "a"), ("c1", None, "b"), (None, 2, "c"), (None, None, "d"), (None, None, "e"), ("c9", 0, "f")]
    out = merge_left_spread(
        spark.createDataFrame(left, "id long, code string, part long"), spark.createDataFrame(right, "code string, part long, what string"), ["code", "part"], 5
    )
    assert out.columns == ["id", "code", "part", "what"]
    frame = lambda rows, names: pd.DataFrame(rows, columns=names).astype(object)
    want = frame(left, ["id", "code", "part"]).merge(frame(right, ["code", "part", "what"]), how="left", on=["code", "part"])
    clean = lambda rows: sorted((tuple(None if pd.isna(v) else v for v in r) for r in rows), key=repr)
    assert clean(map(tuple, out.collect())) == clean(want.itertuples(index=False, name=None))


def test_null_keys_are_spread(spark):
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(48000).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"))
        right = spark.range(0, 48000, 2).select(F.col("id").alias("k"), F.lit(1).alias("x")).unionByName(spark.createDataFrame([(None, 2)], "k long, x int"))
        out = merge_left_spread(left, right, ["k"], 64)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 48000 and max(sizes) <= 2 * statistics.median(sizes)
        assert out.filter("k IS NULL AND x = 2").count() == 16000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
