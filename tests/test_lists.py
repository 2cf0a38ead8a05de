"""Chunked member lists: whole, ordered, bounded and spread."""

from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import functions as F

from souk.operators.lists import SEPARATOR, chunked_lists, numbered_members
from souk.plans import identity as ID


def test_chunks_make_the_whole_list(spark):
    rng = random.Random(4)
    rows = [("hot", f"m{rng.randrange(4000):05d}") for _ in range(3000)] + [(f"g{k % 50}", f"é{rng.randrange(90)}") for k in range(3000)]
    rows += [(None, "a"), (None, "b"), ("empty", None), ("g1", None)]
    want = defaultdict(set)
    for g, m in rows:
        if m is not None:
            want[g].add(m)
    df = spark.createDataFrame(rows, "g string, m string").repartition(7)
    got = defaultdict(list)
    for r in sorted(chunked_lists(df, ["g"], "m", 64).collect(), key=lambda r: r.chunk_no):
        assert r.n_members <= 64 and r.first_member == r.chunk_no * 64
        assert r.first_char == sum(len(x.list_text) for x in got[r.g])
        got[r.g].append(r)
    assert {g: "".join(x.list_text for x in v) for g, v in got.items()} == {g: SEPARATOR.join(sorted(v)) for g, v in want.items()}
    assert {g: sum(x.n_members for x in v) for g, v in got.items()} == {g: len(v) for g, v in want.items()}


def test_hot_group_is_spread(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 500)).alias("g"), F.col("id").cast("string").alias("m"))
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = [F.col("g"), F.col("m")]
        sizes = [r["n"] for r in df.repartitionByRange(*order).filter("g = 'hot'").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) >= 4 and max(sizes) < 30000 / 6
        numbers = [r.member_no for r in numbered_members(df, ["g"], "m").filter("g = 'hot'").collect()]
        assert sorted(numbers) == list(range(10000))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_group_members(spark):
    comps = spark.createDataFrame([("DeviceID", "d1", "c1"), ("Phone", "17", "c1"), ("Phone", "18", "c1"), ("DeviceID", "d2", "c2")], "entity_type string, entity string, component string")
    cust = spark.createDataFrame([("DeviceID", "d1", 5), ("Phone", "17", 5), ("Phone", "18", 12), ("DeviceID", "d2", 9)], "entity_type string, entity string, customer_id long")
    phones = spark.createDataFrame([("Phone", "17", "0199"), ("DeviceID", "d1", "0155")], "entity_type string, entity string, phone_from_address string")
    got = {(r.entity_group_id, r.kind): r.list_text for r in ID.group_member_lists(comps, cust, phones).collect()}
    assert got == {("EG_c1", "device"): "d1", ("EG_c1", "entity"): "17, 18", ("EG_c1", "customer"): "12, 5", ("EG_c1", "phone"): "0199"}
    own = {(r.entity, r.kind): r.list_text for r in ID.entity_member_lists(cust, phones).collect()}
    assert own[("17", "customer")] == "5" and own[("17", "phone")] == "0199" and len(own) == 6
