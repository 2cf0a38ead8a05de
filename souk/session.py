"""Session helper: the few settings every job in this package relies on.

* UTC session time zone (the source system never converts zones).
* ANSI mode on: bad casts raise, so every lenient parse is an explicit
  ``try_*`` call.
* AQE on, with partition coalescing and skew-join splitting, so shuffle
  sizes adapt to the data at run time.
* The Spark UI is off (no server is started by these jobs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast only what the planner can prove small; explicit hints are
    # used for dimension tables whose size is bounded by construction.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}

#: Spark deletes a query's shuffle files as the query ends, not as the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(
    app: str = "souk",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster ``master`` stays ``None`` and the submitting environment
    decides; tests pass ``local[*]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is
    unset (local tests) fall back to a fresh scratch folder."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        # a machine-local folder is not visible to other executors
        raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for cluster runs")
    local = tempfile.mkdtemp(prefix="souk-ckpt-", dir=os.environ.get("SOUK_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return local


@contextmanager
def _tidy(spark: SparkSession):
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder of ``spark.checkpoint.dir``, read back: a lost executor costs no work before it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    with _tidy(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
