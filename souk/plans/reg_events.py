"""Registered event-ETL and streaming queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from souk.oracle.views import with_views
from souk.registry import register
from souk.sources import io as IO
from souk.sources import testviews as tv
from souk.streaming import events as EV

WATERMARK = "2024-01-15 00:00:00"
WINDOW_HI = "2024-01-25 12:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
FMT = "'%Y-%m-%d %H:%M:%S'"


def scratch(spark, name: str) -> str:
    """A fresh folder under the session's checkpoint directory (shared
    storage on a cluster); never reused, never deleted by the job."""
    from souk.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/souk-scratch/{name}-{uuid.uuid4().hex}"


def xid(col: str) -> str:
    return (
        f"CASE WHEN trim({col}) IS NULL OR lower(trim({col})) IN ('', 'null', 'none', 'nan') THEN NULL "
        f"ELSE TRY_CAST(NULLIF(regexp_extract(trim({col}), '(\\d+)', 1), '') AS BIGINT) END"
    )


ATTRS = ["vertical", "cat1", "deepest_category", "shop_name", "seller_code", "product_link"]
ATTR_ORDER = ", ".join(f"{a} ASC NULLS LAST" for a in ATTRS)

CATALOG_CTES = f"""cat AS (
  SELECT * FROM (SELECT {xid('product_id')} AS pid, {xid('variant_id')} AS vid, {', '.join(ATTRS)} FROM catalog)
  WHERE pid IS NOT NULL OR vid IS NOT NULL
),
prod AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pid ORDER BY vid ASC NULLS LAST, {ATTR_ORDER}) AS rn
                        FROM cat WHERE pid IS NOT NULL) WHERE rn = 1),
var AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY vid ORDER BY pid ASC NULLS LAST, {ATTR_ORDER}) AS rn
                       FROM cat WHERE vid IS NOT NULL) WHERE rn = 1)"""


def enrich_ctes(src: str = "user_events") -> str:
    vcols = ", ".join(f"var.{a} AS v_{a}" for a in ATTRS)
    pcols = ", ".join(f"prod.{a} AS p_{a}" for a in ATTRS)
    return f"""{CATALOG_CTES},
ev AS (
  SELECT trim(event_name) AS event_name, COALESCE(TRY_CAST(trim(user_id) AS BIGINT), 0) AS user_id,
    {xid('product_id')} AS pid0, {xid('product_variant_id')} AS vid,
    COALESCE(CAST(try_strptime(event_date, '%Y-%m-%d') AS DATE), CAST(ts AS DATE)) AS event_date, ts AS event_timestamp
  FROM (SELECT *, TRY_CAST(event_timestamp AS TIMESTAMP) AS ts FROM {src}) WHERE ts IS NOT NULL
),
j AS (SELECT ev.*, var.pid AS vpid, var.vid AS vvid, {vcols} FROM ev LEFT JOIN var ON ev.vid = var.vid),
j2 AS (SELECT *, CASE WHEN pid0 IS NULL AND vid IS NOT NULL THEN vpid ELSE pid0 END AS pid FROM j),
j3 AS (SELECT j2.*, prod.pid AS ppid, {pcols} FROM j2 LEFT JOIN prod ON j2.pid = prod.pid),
enriched AS (
  SELECT event_name, user_id, pid AS product_id, vid AS variant_id, event_date, event_timestamp,
    {', '.join(f"CASE WHEN p_vertical IS NULL AND vvid IS NOT NULL THEN v_{a} WHEN ppid IS NOT NULL THEN p_{a} END AS {o}" for a, o in zip(ATTRS, ['vertical', 'category_level1', 'deepest_category', 'shop_name', 'seller_code', 'product_link']))}
  FROM j3 WHERE pid IS NOT NULL OR vid IS NOT NULL
)"""


ENRICHED_OUT = f"""SELECT event_name, user_id, product_id, variant_id, strftime(event_date, '%Y-%m-%d') AS event_date,
  strftime(event_timestamp, {FMT}) AS event_timestamp, vertical, category_level1, deepest_category, shop_name,
  seller_code, product_link FROM enriched"""

RAW_COLS = ["event_name", "user_id", "product_id", "product_variant_id", "event_date", "event_timestamp"]


def _raw(spark, d):
    return tv.user_events(spark, d).select(*RAW_COLS)


def _lookups(spark, d):
    return EV.catalog_lookup(tv.catalog(spark, d))


@register(
    "catalog_lookup",
    lambda: with_views(
        ["catalog"],
        f"""WITH {CATALOG_CTES}
SELECT 'product' AS kind, pid AS id, vid AS other_id, {', '.join(ATTRS)} FROM prod
UNION ALL SELECT 'variant', vid, pid, {', '.join(ATTRS)} FROM var""",
    ),
)
def _catalog_lookup(spark, d):
    p, v = _lookups(spark, d)
    a = p.select(F.lit("product").alias("kind"), F.col("pid").alias("id"), F.col("vid").alias("other_id"), *ATTRS)
    b = v.select(F.lit("variant").alias("kind"), F.col("vid").alias("id"), F.col("pid").alias("other_id"), *ATTRS)
    return a.unionByName(b)


@register("event_enrich", lambda: with_views(["catalog", "user_events"], f"WITH {enrich_ctes()} {ENRICHED_OUT}"))
def _event_enrich(spark, d):
    p, v = _lookups(spark, d)
    return EV.event_enrich(_raw(spark, d), p, v)


SLICE = f"""(SELECT * FROM user_events WHERE (product_id IS NOT NULL OR product_variant_id IS NOT NULL)
   AND TRY_CAST(event_timestamp AS TIMESTAMP) > TIMESTAMP '{WATERMARK}'
   AND TRY_CAST(event_timestamp AS TIMESTAMP) <= TIMESTAMP '{WINDOW_HI}')"""


@register(
    "incremental_window_scan",
    lambda: with_views(
        ["user_events"],
        f"""SELECT {', '.join(RAW_COLS)} FROM user_events WHERE (product_id IS NOT NULL OR product_variant_id IS NOT NULL)
  AND source_ts > TIMESTAMP '{WATERMARK}' AND source_ts <= TIMESTAMP '{WINDOW_HI}'""",
    ),
)
def _incremental_window_scan(spark, d):
    ids = F.col("product_id").isNotNull() | F.col("product_variant_id").isNotNull()
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in (WATERMARK, WINDOW_HI))
    return IO.incremental_window_scan(tv.user_events(spark, d), "source_ts", lo, hi, ids).select(*RAW_COLS)


@register(
    "late_event_policy",
    lambda: with_views(
        ["user_events"],
        f"SELECT {', '.join(RAW_COLS)} FROM user_events WHERE TRY_CAST(event_timestamp AS TIMESTAMP) > TIMESTAMP '{WATERMARK}'",
    ),
)
def _late_event_policy(spark, d):
    return EV.late_event_policy(_raw(spark, d), WATERMARK)


#: Parts that the replay arrives in, and how late an event may be.
REPLAY_PARTS, LATENESS = 4, "1 hour"


@register(
    "late_tolerant_dedupe",
    lambda: with_views(
        ["user_events"],
        f"SELECT DISTINCT {', '.join(RAW_COLS)} FROM user_events WHERE TRY_CAST(event_timestamp AS TIMESTAMP) IS NOT NULL",
    ),
)
def _late_tolerant_dedupe(spark, d):
    """A replay in parts, in time order.  Each part also holds copies of its
    own events, copies of the last hour's events of the part before, and
    events that are a part or more late (they must go); every part is a run
    of its own, so each starts from the checkpoint."""
    raw = _raw(spark, d).withColumn("ts", F.try_to_timestamp("event_timestamp")).filter("ts IS NOT NULL")
    ends = raw.agg(F.min(F.unix_seconds("ts")).alias("lo"), F.max(F.unix_seconds("ts")).alias("hi")).first()
    src, out, ck = scratch(spark, "dedupe-src"), scratch(spark, "dedupe-out"), scratch(spark, "dedupe-ckpt")
    if ends.lo is None:
        return raw.drop("ts")
    width = (ends.hi - ends.lo) // REPLAY_PARTS + 1
    raw = raw.withColumn("part", F.floor((F.unix_seconds("ts") - ends.lo) / width))
    last = {r.part: r.ts for r in raw.groupBy("part").agg(F.max("ts").alias("ts")).collect()}
    for part in sorted(last):
        own = raw.filter(F.col("part") == part)
        sent = own.unionByName(own.filter(F.pmod(F.xxhash64("user_id", "event_timestamp"), F.lit(7)) == 0))
        earlier = [p for p in sorted(last) if p < part]
        if earlier:
            before = raw.filter(F.col("part") == earlier[-1])
            sent = sent.unionByName(before.filter(F.col("ts") > F.lit(last[earlier[-1]]) - F.expr(f"INTERVAL {LATENESS}")))
        if len(earlier) > 1:
            sent = sent.unionByName(raw.filter(F.col("part") == earlier[0]).withColumn("user_id", F.concat(F.lit("late "), "user_id")))
        sent.drop("ts", "part").write.parquet(f"{src}/part-{part}")
        EV.stream_dedupe(spark, src, out, ck, LATENESS)
    return spark.read.parquet(out).select(*RAW_COLS)


@register(
    "watermark_state",
    lambda: with_views(
        ["catalog", "user_events"],
        f"""WITH {enrich_ctes()},
tgt AS (SELECT MAX(event_timestamp) AS t FROM enriched WHERE event_timestamp <= TIMESTAMP '{WATERMARK}'),
src AS (SELECT MAX(TRY_CAST(event_timestamp AS TIMESTAMP)) AS source_max FROM user_events)
SELECT strftime(COALESCE(t, TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 30 DAY), {FMT}) AS watermark,
  strftime(source_max, {FMT}) AS source_max,
  source_max IS NULL OR source_max <= COALESCE(t, TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 30 DAY) AS skip,
  FALSE AS is_first_run
FROM tgt, src""",
    ),
)
def _watermark_state(spark, d):
    p, v = _lookups(spark, d)
    target = EV.event_enrich(_raw(spark, d), p, v).filter(F.col("event_timestamp") <= F.lit(WATERMARK).cast("timestamp"))
    return EV.watermark_state(target, _raw(spark, d), EVENTS_AS_OF)


@register(
    "incremental_append",
    lambda: with_views(["catalog", "user_events"], f"WITH {enrich_ctes(SLICE)} {ENRICHED_OUT}"),
)
def _incremental_append(spark, d):
    p, v = _lookups(spark, d)
    path = scratch(spark, "incremental-append")
    raw = tv.user_events(spark, d)
    EV.incremental_append(raw, p, v, path, WATERMARK, WINDOW_HI, window_hours=48, ts_col="source_ts")
    return spark.read.parquet(path).drop("batch_id")


@register("stream_enrich", lambda: with_views(["catalog", "user_events"], f"WITH {enrich_ctes()} {ENRICHED_OUT}"))
def _stream_enrich(spark, d):
    src = scratch(spark, "events-src")
    raw = _raw(spark, d).withColumn("_day", F.coalesce(F.substring("event_timestamp", 1, 10), F.lit("none")))
    raw.repartition("_day", F.pmod(F.xxhash64("user_id", "event_timestamp"), F.lit(4))).write.partitionBy("_day").parquet(src)
    out, ck = scratch(spark, "events-out"), scratch(spark, "events-ckpt")
    EV.stream_enrich(spark, src, tv.catalog(spark, d), out, ck)
    return spark.read.parquet(out).select(
        "event_name", "user_id", "product_id", "variant_id", "event_date", "event_timestamp", "vertical",
        "category_level1", "deepest_category", "shop_name", "seller_code", "product_link",
    )


@register(
    "enrichment_stats",
    lambda: with_views(
        ["catalog", "user_events"],
        f"""WITH {enrich_ctes()}
SELECT COUNT(*) AS rows_inserted, COUNT(vertical) AS rows_enriched,
  CAST(round(COUNT(vertical) * 1000.0 / greatest(COUNT(*), 1)) / 10.0 AS DOUBLE) AS enriched_pct FROM enriched""",
    ),
)
def _enrichment_stats(spark, d):
    p, v = _lookups(spark, d)
    return EV.enrichment_stats(EV.event_enrich(_raw(spark, d), p, v))


@register(
    "load_metrics",
    lambda: with_views(
        ["catalog", "user_events"],
        f"""WITH {enrich_ctes()}
SELECT COUNT(*) AS rows_inserted, COUNT(vertical) AS rows_enriched, COUNT(*) AS rows_written, COUNT(*) > 0 AS has_rate FROM enriched""",
    ),
)
def _load_metrics(spark, d):
    """Counts and rate of a load as its own write reports them, beside a count of what it wrote."""
    p, v = _lookups(spark, d)
    path = scratch(spark, "load")
    m = EV.load_metrics(EV.event_enrich(_raw(spark, d), p, v), path)
    told = (F.lit(m["rows_inserted"]).alias("rows_inserted"), F.lit(m["rows_enriched"]).alias("rows_enriched"))
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_written")).select(*told, "rows_written", F.lit(m["rows_per_second"] > 0).alias("has_rate"))


@register(
    "stream_new_files",
    lambda: with_views(
        ["partner_status"],
        "SELECT CAST(row_id AS VARCHAR) AS row_id, merchant_order_id, order_status, partner_name FROM partner_status",
    ),
)
def _stream_new_files(spark, d):
    from pyspark.sql import types as T

    folder = scratch(spark, "drop-folder")
    out = scratch(spark, "drop-processed")
    ps = tv.partner_status(spark, d).select(
        F.col("row_id").cast("string").alias("row_id"), "merchant_order_id", "order_status", "partner_name"
    )
    ps.repartition(4).write.option("header", True).csv(folder)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ["row_id", "merchant_order_id", "order_status", "partner_name"]])

    def handle(batch, batch_id):
        # foreachBatch is at-least-once; writing the batch under its own
        # batch_id partition (dynamic overwrite) makes a retry replace it
        from souk.sources.io import incremental_append

        incremental_append(batch, out, batch_id=batch_id)

    EV.stream_new_files(spark, folder, schema, handle, scratch(spark, "drop-ckpt"))
    return spark.read.parquet(out).drop("batch_id")
