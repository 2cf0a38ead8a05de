"""Identity resolution and group tables.

Connected components run as Spark jobs over an edge DataFrame: iterative
min-label propagation with pointer jumping.  Each round is two
aggregations and two joins; the label table is cut from its lineage with
``checkpoint()`` (reliable, in the cluster's ``spark.checkpoint.dir``) so
a lost executor recomputes one round, not the whole history.  The loop
stops when a round changes no label.

Node namespaces are kept apart as in the source: an entity row
(``E:type:value``), a customer (``C:id``) and a phone written in an
address (``P:phone``) are different nodes even if their text agrees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.operators.dedupe import asc, first_per_key
from souk.operators.lists import CHUNK, chunked_lists
from souk.plans.entities import KEY

DEVICE = "DeviceID"


def split_hubs(edges: DataFrame, hub_links: int) -> DataFrame:
    """``edges(a, b)`` where no ``b`` has far more than ``hub_links`` links:
    a hub's links go to helper nodes, one per ``hub_links`` of them, and the
    helpers to the hub.  Who is connected with whom stays the same.  A
    helper's name extends the hub's, so it is never the smallest node."""
    hubs = (
        edges.groupBy("b")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > hub_links)
        .select(F.col("b").alias("hub"), F.ceil(F.col("n") / hub_links).alias("parts"))
    )
    j = edges.join(hubs, F.col("b") == F.col("hub"), "left")
    helper = F.concat("b", F.lit("\x01"), F.pmod(F.xxhash64("a"), "parts").cast("string"))
    near = j.select("a", F.when(F.col("hub").isNull(), F.col("b")).otherwise(helper).alias("b"))
    far = hubs.select(
        F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.concat("hub", F.lit("\x01"), k.cast("string")))).alias("a"),
        F.col("hub").alias("b"),
    )
    return near.unionByName(far)


def connected_components(edges: DataFrame, hub_links: int = 10_000) -> DataFrame:
    """``edges(src, dst)`` (strings) -> ``(node, component)`` where the
    component is the smallest node id of the node's component.

    A node with more than ``hub_links`` links is split (see ``split_hubs``),
    so no task of a round holds a hub's links alone."""
    from souk.session import ensure_checkpoint_dir

    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    one_way = edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).filter(F.col("a") != F.col("b")).distinct()
    # both ends may be hubs: first the links into each ``b``, then those into each ``a``
    into_b = split_hubs(one_way, hub_links)
    into_a = split_hubs(into_b.select(F.col("b").alias("a"), F.col("a").alias("b")), hub_links)
    links = into_a.distinct()
    # adjacency in both directions, hash-partitioned by the node whose label
    # is looked up; checkpointing keeps that partitioning, so the per-round
    # join with the (equally partitioned) label table needs no exchange
    sym = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().repartition(n, "b").checkpoint()
    own = edges.select(F.col("src").alias("b")).unionByName(edges.select(F.col("dst").alias("b"))).distinct()
    nodes = (
        own.select("b", F.lit(True).alias("own"))
        .unionByName(sym.select("b", F.lit(False).alias("own")))
        .groupBy("b")
        .agg(F.max("own").alias("own"))
    )
    labels = nodes.select("b", F.col("b").alias("label"), "own").repartition(n, "b").checkpoint()
    while True:
        # 1. new label = min(own label, neighbours' labels); one map-side
        #    combined aggregate (a hub node costs one partial min per task)
        cand = labels.select(F.col("b").alias("node"), "label", F.col("label").alias("old"), "own").unionByName(
            sym.join(labels, "b").select(
                F.col("a").alias("node"), "label", F.lit(None).cast("string").alias("old"), F.lit(None).cast("boolean").alias("own")
            )
        )
        step = cand.groupBy("node").agg(F.min("label").alias("label"), F.min("old").alias("old"), F.max("own").alias("own"))
        # 2. pointer jumping: a label is itself a node; take its label
        look = step.select(F.col("node").alias("l_node"), F.col("label").alias("l_label"))
        jumped = (
            step.join(look, step["label"] == look["l_node"], "left")
            .select(F.col("node").alias("b"), F.least("label", F.coalesce("l_label", "label")).alias("label"), "old", "own")
            .repartition(n, "b")
            .checkpoint()
        )
        changed = jumped.filter(F.col("label") != F.col("old")).limit(1).count()
        labels = jumped.drop("old")
        if changed == 0:
            return labels.filter("own").select(F.col("b").alias("node"), F.col("label").alias("component"))


def bipartite_components(edges: DataFrame) -> DataFrame:
    """``connected_components`` of the ``src`` nodes of ``edges(src, dst)``
    whose ``src`` and ``dst`` are different kinds of nodes.

    What a ``dst`` links is linked to the smallest of it instead, so the
    rounds shuffle the distinct links of ``src`` nodes, however many ``dst``
    nodes make each of them; the ``dst`` nodes come back for the name."""
    stars = edges.groupBy("dst").agg(F.min("src").alias("least"))
    links = edges.join(stars, "dst").select("src", F.col("least").alias("dst")).distinct()
    cc = connected_components(links)
    lows = edges.groupBy("src").agg(F.least("src", F.min("dst")).alias("low"))
    members = cc.join(lows, F.col("node") == F.col("src"))
    names = members.groupBy("component").agg(F.min("low").alias("name"))
    return cc.join(names, "component").select("node", F.col("name").alias("component"))


def entity_node(type_col: str = "entity_type", entity_col: str = "entity"):
    return F.concat(F.lit("E:"), F.col(type_col), F.lit(":"), F.col(entity_col))


# ------------------------------------------------------------------ C11
def entity_components(customers: DataFrame, address_phones: DataFrame) -> DataFrame:
    """(entity_type, entity, component) over links by shared customer ids
    and by shared phones written in addresses."""
    e1 = customers.select(entity_node().alias("src"), F.concat(F.lit("C:"), F.col("customer_id").cast("string")).alias("dst"))
    e2 = address_phones.select(entity_node().alias("src"), F.concat(F.lit("P:"), F.col("phone_from_address")).alias("dst"))
    cc = bipartite_components(e1.unionByName(e2))
    ents = customers.select(*KEY).unionByName(address_phones.select(*KEY)).distinct()
    return ents.withColumn("node", entity_node()).join(cc, "node").drop("node")


def _abuse_parts(col: str):
    """Abuse-type text -> array of parts (split on ';' or ','), 'None' and
    blanks removed."""
    parts = F.transform(F.split(F.coalesce(F.col(col), F.lit("")), "[;,]"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: (x != "") & (x != "None"))


def normalize_group_abuse(parts_col: str):
    """None -> 'None', one -> it, two or more -> both abuser labels."""
    n = F.size(parts_col)
    return (
        F.when(n == 0, F.lit("None"))
        .when(n == 1, F.element_at(parts_col, 1))
        .otherwise(F.lit("VoucherAbuser; FreeShippingAbuser"))
    )


SUM_METRICS = [
    "gos", "gis", "gmv", "nos", "nis", "nmv", "voucher_subsidy", "shipping_subsidy", "prepayment_subsidy",
    "voucher_subsidy_lost", "shipping_subsidy_lost", "abused_voucher_count", "abused_shipping_id_count",
    "cancel_count", "overall_cancel_count", "gmv_cancelled", "total_returned", "total_valid_return",
    "total_invalid_return", "gmv_valid_return", "gmv_invalid_return",
]


# ------------------------------------------------------------ C12 / W10
def group_rollup(profile: DataFrame, components: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per group.  Only non-device entity rows make a group; device
    rows add their count, their customers and their abuse types.  The
    group id is ``EG_`` + the component's smallest node (stable across
    runs, unlike a row number)."""
    rows = profile.join(components, KEY, "inner")
    dev = F.col("entity_type") == DEVICE
    non_dev = rows.filter(~dev).groupBy("component").agg(
        F.first("entity_type", ignorenulls=True).alias("entity_type"),
        F.count(F.lit(1)).alias("entity_count"),
        *[F.sum(c).alias(c) for c in SUM_METRICS],
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
    )
    devices = rows.filter(dev).groupBy("component").agg(F.count(F.lit(1)).alias("linked_device_count"))
    # abuse labels of every member (device or not): exploded and made
    # distinct per component first, so only the handful of distinct labels
    # is ever collected - never one entry per member of a big component
    labels = (
        rows.select("component", F.explode(_abuse_parts("abuse_type")).alias("part"))
        .distinct()
        .groupBy("component")
        .agg(F.collect_set("part").alias("_labels"))
    )
    accounts = (
        customers.join(components, KEY, "inner")
        .select("component", "customer_id")
        .distinct()
        .groupBy("component")
        .agg(F.count(F.lit(1)).alias("num_of_accounts"))
    )
    g = non_dev.join(devices, "component", "left").join(accounts, "component", "left").join(labels, "component", "left")
    g = g.withColumn("_all", F.array_sort(F.coalesce("_labels", F.array().cast("array<string>"))))
    return g.select(
        F.concat(F.lit("EG_"), F.col("component")).alias("entity_group_id"),
        "entity_type",
        "entity_count",
        F.coalesce("num_of_accounts", F.lit(0)).alias("num_of_accounts"),
        F.coalesce("linked_device_count", F.lit(0)).alias("linked_device_count"),
        *SUM_METRICS,
        "first_order_date",
        "last_order_date",
        normalize_group_abuse("_all").alias("abuse_type"),
    )


# ------------------------------------------------------------------ C14
def entity_group_map(components: DataFrame, address_phones: DataFrame) -> DataFrame:
    """Entity text -> group: the non-device entities of each group plus the
    phones found in their addresses.  Text that lands in two groups (an
    address phone equal to another group's phone) keeps the smallest
    group id - the source kept the first row, whose order is not stable."""
    nd = components.filter(F.col("entity_type") != DEVICE)
    members = nd.select(F.col("entity").alias("member"), "component").unionByName(
        address_phones.filter(F.col("entity_type") != DEVICE)
        .join(nd, KEY)
        .select(F.col("phone_from_address").alias("member"), "component")
    )
    m = members.select("member", F.concat(F.lit("EG_"), F.col("component")).alias("entity_group_id"))
    return first_per_key(m.distinct(), ["member"], [asc("entity_group_id")])


# ------------------------------------------------------- A09 / A10 / C12
def group_members(components: DataFrame, customers: DataFrame, address_phones: DataFrame) -> DataFrame:
    """``entity_group_id``, ``kind``, ``member``: the entities, linked devices,
    customers and address phones of every group (those with a non-device
    entity)."""
    ents = components.withColumn("kind", F.when(F.col("entity_type") == DEVICE, "device").otherwise("entity"))
    members = (
        ents.select("component", "kind", F.col("entity").alias("member"))
        .unionByName(
            customers.join(components, KEY).select("component", F.lit("customer").alias("kind"), F.col("customer_id").cast("string").alias("member"))
        )
        .unionByName(
            address_phones.filter(F.col("entity_type") != DEVICE)
            .join(components, KEY)
            .select("component", F.lit("phone").alias("kind"), F.col("phone_from_address").alias("member"))
        )
    )
    made = components.filter(F.col("entity_type") != DEVICE).select("component").distinct()
    return members.join(made, "component", "left_semi").select(F.concat(F.lit("EG_"), F.col("component")).alias("entity_group_id"), "kind", "member")


def group_member_lists(components: DataFrame, customers: DataFrame, address_phones: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The sorted member lists of every group and kind, in bounded chunks."""
    return chunked_lists(group_members(components, customers, address_phones), ["entity_group_id", "kind"], "member", chunk)


def entity_member_lists(customers: DataFrame, address_phones: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The sorted customer and address-phone lists of every entity, in bounded chunks."""
    members = customers.select(*KEY, F.lit("customer").alias("kind"), F.col("customer_id").cast("string").alias("member")).unionByName(
        address_phones.select(*KEY, F.lit("phone").alias("kind"), F.col("phone_from_address").alias("member"))
    )
    return chunked_lists(members, [*KEY, "kind"], "member", chunk)


# ------------------------------------------------------------ C15 / A14
def group_products(lines: DataFrame, group_map: DataFrame) -> DataFrame:
    """Group x day x category facts over every order line whose receiver
    phone belongs to a group."""
    l = lines.select(
        F.trim(F.col("phone").cast("string")).alias("member"),
        "order_date", "vertical", F.col("cat1").alias("category"), "deepest_category",
        "qty", "total_price", "voucher_discount", "platform_shipping",
    )
    j = l.join(group_map, "member", "inner")
    return j.groupBy("entity_group_id", "order_date", "vertical", "category", "deepest_category").agg(
        F.coalesce(F.sum("qty"), F.lit(0)).alias("gis"),
        F.coalesce(F.sum("total_price"), F.lit(0)).alias("gmv"),
        F.coalesce(F.sum("voucher_discount"), F.lit(0)).alias("voucher_subsidy"),
        F.coalesce(F.sum("platform_shipping"), F.lit(0)).alias("shipping_subsidy"),
    )


# ------------------------------------------------------------ A15 / J12
def group_shipping(lines: DataFrame, group_map: DataFrame) -> DataFrame:
    l = lines.select(
        F.trim(F.col("phone").cast("string")).alias("member"),
        "order_code", "shipping_state", "shipping_city", "shipping_zone", "total_price",
    )
    j = l.join(group_map, "member", "inner")
    return j.groupBy("entity_group_id", "shipping_state", "shipping_city", "shipping_zone").agg(
        F.count_distinct("order_code").alias("gos"),
        F.coalesce(F.sum("total_price"), F.lit(0)).alias("gmv"),
    )
