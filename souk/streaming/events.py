"""User-event ETL: catalog lookups, enrichment, incremental and streaming
loads (C27, C28, J10, T01-T07, S03, S07, S10).

The reference walked 1-hour windows from a high-water mark and inserted
chunks with retries.  Here:

* batch form - ``incremental_window_scan`` is one ``(lo, hi]`` filter on
  the typed timestamp (pushed to the scan); ``incremental_append`` writes
  each window idempotently under its batch id, so a retried window
  replaces its own output instead of duplicating it;
* streaming form - ``stream_enrich`` is a file-source Structured Streaming
  query (``trigger(availableNow=True)``) with a stream-static join to the
  catalog and an exactly-once parquet sink; the checkpoint replaces the
  watermark bookkeeping.

Whether a catalog side is broadcast is left to the planner's measured sizes.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.text import extract_id
from souk.operators.dedupe import asc, first_per_key

ATTRS = ["vertical", "cat1", "deepest_category", "shop_name", "seller_code", "product_link"]

RAW_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_name", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_variant_id", T.StringType()),
        T.StructField("event_date", T.StringType()),
        T.StructField("event_timestamp", T.StringType()),
    ]
)


# ------------------------------------------------------------------ C27
def catalog_lookup(allsku: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(products, variants): ids cleaned to numbers, rows without either id
    dropped, the first row per product / per variant kept (ordered by the
    other id, then the attributes, so "first" is reproducible)."""
    c = allsku.select(
        extract_id("product_id").alias("pid"), extract_id("variant_id").alias("vid"), *ATTRS
    ).dropna(how="all", subset=["pid", "vid"])
    order = [asc("vid"), *[asc(a) for a in ATTRS]]
    products = first_per_key(c.filter(F.col("pid").isNotNull()), ["pid"], order)
    variants = first_per_key(c.filter(F.col("vid").isNotNull()), ["vid"], [asc("pid"), *[asc(a) for a in ATTRS]])
    return products, variants


# ------------------------------------------------------------- C28 / J10
def parse_events(raw: DataFrame) -> DataFrame:
    """Typed events: bad timestamps dropped, date from its column or the
    timestamp, ids cleaned, bad user id -> 0."""
    ts = F.try_to_timestamp(F.col("event_timestamp"))
    out = raw.withColumn("event_ts", ts).filter(F.col("event_ts").isNotNull())
    return out.select(
        F.trim(F.col("event_name").cast("string")).alias("event_name"),
        F.coalesce(F.trim("user_id").try_cast("bigint"), F.lit(0).cast("bigint")).alias("user_id"),
        extract_id("product_id").alias("pid"),
        extract_id("product_variant_id").alias("vid"),
        F.coalesce(F.try_to_timestamp(F.col("event_date"), F.lit("yyyy-MM-dd")).cast("date"), F.to_date("event_ts")).alias(
            "event_date"
        ),
        F.col("event_ts").alias("event_timestamp"),
    )


def event_enrich(raw: DataFrame, products: DataFrame, variants: DataFrame) -> DataFrame:
    """12-column enriched events.  A missing product id is filled from the
    variant's product; attributes come from the product, else - only where
    the vertical is still NULL - from the variant.  Rows with neither id
    are dropped."""
    ev = parse_events(raw)
    v = (
        variants.select(F.col("vid").alias("_vid"), F.col("pid").alias("_vpid"), *[F.col(a).alias(f"v_{a}") for a in ATTRS])
    )
    p = (products.select(F.col("pid").alias("_pid"), *[F.col(a).alias(f"p_{a}") for a in ATTRS]))
    j = ev.join(v, ev["vid"] == v["_vid"], "left")
    j = j.withColumn("pid", F.when(F.col("pid").isNull() & F.col("vid").isNotNull(), F.col("_vpid")).otherwise(F.col("pid")))
    j = j.join(p, j["pid"] == p["_pid"], "left")
    # second stage overrides every attribute when the vertical is still NULL
    use_variant = F.col("p_vertical").isNull() & F.col("_vid").isNotNull()
    attrs = {a: F.when(use_variant, F.col(f"v_{a}")).when(F.col("_pid").isNotNull(), F.col(f"p_{a}")) for a in ATTRS}
    out = j.select(
        "event_name",
        "user_id",
        F.col("pid").alias("product_id"),
        F.col("vid").alias("variant_id"),
        "event_date",
        "event_timestamp",
        attrs["vertical"].alias("vertical"),
        attrs["cat1"].alias("category_level1"),
        attrs["deepest_category"].alias("deepest_category"),
        attrs["shop_name"].alias("shop_name"),
        attrs["seller_code"].alias("seller_code"),
        attrs["product_link"].alias("product_link"),
    )
    return out.dropna(how="all", subset=["product_id", "variant_id"])


# ------------------------------------------------------------------ T01
def watermark_state(target: DataFrame | None, source: DataFrame, as_of: str, lookback_days: int = 30,
                    target_ts: str = "event_timestamp", source_ts: str = "event_timestamp") -> DataFrame:
    """One row: the watermark (target's max timestamp, or ``as_of`` minus
    the lookback on a first run / empty target), the source's max
    timestamp, whether there is nothing new, and whether it is a first run.
    Both maxima are distributed aggregates; nothing is collected."""
    src_max = source.agg(F.max(F.try_to_timestamp(F.col(source_ts).cast("string"))).alias("source_max"))
    default = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {lookback_days} DAYS")
    if target is None:
        wm = src_max.select(default.alias("watermark"), F.lit(True).alias("is_first_run"))
    else:
        wm = target.agg(F.max(F.col(target_ts).cast("timestamp")).alias("_t")).select(
            F.coalesce("_t", default).alias("watermark"), F.lit(False).alias("is_first_run")
        )
    j = wm.crossJoin(src_max)
    skip = F.col("source_max").isNull() | (F.col("source_max") <= F.col("watermark"))
    return j.select("watermark", "source_max", skip.alias("skip"), "is_first_run")


# ------------------------------------------------------------------ T02 / S03
def window_slice(raw: DataFrame, lo, hi, ts_col: str = "event_timestamp") -> DataFrame:
    """Raw events with ``lo < ts <= hi`` and at least one id present.  On a
    typed ``ts_col`` the range reaches the scan, so a window reads the files
    and row groups of its time; text is parsed row by row."""
    kind = raw.schema[ts_col].dataType
    ts = F.col(ts_col)
    if isinstance(kind, T.StringType):
        ts, kind = F.try_to_timestamp(ts), T.TimestampType()
    return raw.filter(
        (F.col("product_id").isNotNull() | F.col("product_variant_id").isNotNull())
        & (ts > F.lit(lo).cast(kind))
        & (ts <= F.lit(hi).cast(kind))
    )


def windows(lo: str, hi: str, hours: int):
    """The (start, end] windows from ``lo`` to ``hi`` (driver-side list of
    bounds only - no data)."""
    import datetime as dt

    start = dt.datetime.fromisoformat(lo)
    stop = dt.datetime.fromisoformat(hi)
    out = []
    while start < stop:
        end = min(start + dt.timedelta(hours=hours), stop)
        out.append((start.isoformat(sep=" "), end.isoformat(sep=" ")))
        start = end
    return out


# ------------------------------------------------------------------ T03 / S10
def incremental_append(raw: DataFrame, products: DataFrame, variants: DataFrame, path: str, lo: str, hi: str,
                       window_hours: int = 24, ts_col: str = "event_timestamp") -> int:
    """Load ``(lo, hi]`` window by window into ``path``; each window is its
    own ``batch_id`` folder, named by the window's start, so later runs add
    to it and re-running a window replaces just that window (also by no
    rows).  Returns the number of windows."""
    from souk.sources.io import incremental_append as append

    ws = windows(lo, hi, window_hours)
    for a, b in ws:
        batch = "from-" + "".join(c if c.isdigit() else "-" for c in a)
        append(event_enrich(window_slice(raw, a, b, ts_col), products, variants), path, batch_id=batch)
    return len(ws)


# ------------------------------------------------------------------ T04
def late_event_policy(raw: DataFrame, watermark: str) -> DataFrame:
    """Batch rule of the source: an event at or before the watermark is
    never read again (exclusive lower bound)."""
    return raw.filter(F.try_to_timestamp(F.col("event_timestamp")) > F.lit(watermark).cast("timestamp"))


EVENT_KEY = ["event_name", "user_id", "product_id", "product_variant_id", "event_timestamp"]


def late_tolerant_dedupe(stream: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Streaming variant: accept events up to ``lateness`` behind the latest
    one seen, and drop repeats of an event (equal in ``EVENT_KEY``) inside
    that horizon.  The state holds one key per event of the horizon only.
    Events whose time can't be read have no place in it and are left out."""
    keyed = stream.withColumn("event_ts", F.try_to_timestamp(F.col("event_timestamp"))).filter(F.col("event_ts").isNotNull())
    return keyed.withWatermark("event_ts", lateness).dropDuplicatesWithinWatermark(EVENT_KEY)


def stream_dedupe(spark: SparkSession, src: str, out: str, ckpt: str, lateness: str = "1 hour") -> None:
    """File stream of raw events -> ``late_tolerant_dedupe`` -> parquet sink.
    Takes the files that are there as one batch and stops; watermark and seen
    keys are in the checkpoint, so the next run goes on with both."""
    stream = spark.readStream.schema(RAW_EVENT_SCHEMA).option("recursiveFileLookup", True).parquet(src)
    query = (
        late_tolerant_dedupe(stream, lateness).drop("event_ts")
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


# ------------------------------------------------------------------ T05
def stream_enrich(spark: SparkSession, src: str, allsku: DataFrame, out: str, ckpt: str,
                  max_files_per_trigger: int = 8) -> None:
    """File stream of raw events -> enrichment (stream-static joins) ->
    parquet sink partitioned by event day.  ``availableNow`` processes
    what is there in bounded micro-batches and stops; the checkpoint makes
    a restart continue where it left off (exactly-once file sink).  The
    look-up tables are written once per run beside the checkpoint, so the
    micro-batches don't de-duplicate the catalogue again."""
    lookups = []
    for name, table in zip(("products", "variants"), catalog_lookup(allsku)):
        folder = f"{ckpt.rstrip('/')}-lookup/{name}"
        table.write.mode("overwrite").parquet(folder)
        lookups.append(spark.read.parquet(folder))
    products, variants = lookups
    stream = (
        spark.readStream.schema(RAW_EVENT_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(src)
    )
    enriched = event_enrich(stream, products, variants)
    q = (
        enriched.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", ckpt)
        .partitionBy("event_date")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


# ------------------------------------------------------------------ T06 / S14
def enrichment_stats(enriched: DataFrame) -> DataFrame:
    """Rows, enriched rows and enriched share of a load (one row)."""
    return enriched.agg(
        F.count(F.lit(1)).alias("rows_inserted"),
        F.count_if(F.col("vertical").isNotNull()).alias("rows_enriched"),
    ).withColumn(
        "enriched_pct",
        F.round(F.col("rows_enriched") * 100.0 / F.greatest(F.col("rows_inserted"), F.lit(1)), 1),
    )


def observe_load(enriched: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """Attach the run metrics to the write itself (no second pass):
    ``Observation`` is filled when the frame is written."""
    obs = Observation(name)
    return enriched.observe(
        obs, F.count(F.lit(1)).alias("rows_inserted"), F.count_if(F.col("vertical").isNotNull()).alias("rows_enriched")
    ), obs


def load_metrics(enriched: DataFrame, path: str) -> dict:
    """Writes ``enriched`` to ``path`` and returns ``rows_inserted``,
    ``rows_enriched``, ``seconds`` and ``rows_per_second`` of that write."""
    frame, seen = observe_load(enriched, f"load-{uuid.uuid4().hex}")
    began = time.monotonic()
    frame.write.parquet(path)
    seconds = time.monotonic() - began
    rows = seen.get.get("rows_inserted", 0)
    return {"rows_inserted": rows, "rows_enriched": seen.get.get("rows_enriched", 0), "seconds": seconds, "rows_per_second": rows / seconds}


def stream_rates(spark: SparkSession, query) -> DataFrame:
    """Rows, seconds and rows a second of every micro-batch of a stream, from its own progress reports."""
    rows = [(p["batchId"], p["numInputRows"], p["durationMs"].get("triggerExecution", 0) / 1000) for p in query.recentProgress]
    return spark.createDataFrame(rows, "batch_id long, rows long, seconds double").withColumn(
        "rows_per_second", F.try_divide("rows", "seconds")
    )


# ------------------------------------------------------------- S07 / T07
def stream_new_files(spark: SparkSession, folder: str, schema: T.StructType, fn, ckpt: str, fmt: str = "csv") -> None:
    """Process every new file dropped into ``folder`` once: a file-source
    stream whose micro-batches are handed to ``fn(batch_df, batch_id)``.
    Run with ``availableNow`` for a catch-up pass; a long-running trigger
    turns it into the folder watcher.  ``foreachBatch`` is at-least-once,
    so ``fn`` should write idempotently per ``batch_id`` (for example with
    ``souk.sources.io.incremental_append(df, path, batch_id=...)``)."""
    reader = spark.readStream.schema(schema).option("header", True) if fmt == "csv" else spark.readStream.schema(schema)
    stream = reader.format(fmt).load(folder)
    q = stream.writeStream.foreachBatch(fn).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
