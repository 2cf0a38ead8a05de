"""The corpus pipeline: documents in, sharded training documents out.

Each stage calls one operator of ``souk.llm`` on all rows that the stage
before it kept.  ``run`` writes every stage's rows as Parquet in the shared
folder of ``spark.checkpoint.dir`` and reads them again for the next stage,
so a lost executor costs one stage at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import decontam, langid, mixing, sharding, simhash
from souk.llm.text import remainder
from souk.session import ensure_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or far from every language learned, go."""
    model = langid.fit(docs.filter(remainder("doc_id", 5) != 0))
    return langid.predict(docs, model).filter(~F.col("rejected")).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id."""
    return simhash.keep_one(docs)


def remove_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay with the probability of their fitted rate; a rate of one or more always stays."""
    rated, _ = mixing.mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rated.filter(mixing.keep(F.col("rate"), F.col("doc_id"))).select(*docs.columns)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and place in it."""
    return sharding.assign(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark_text),
    ("mixing", mix_to_targets),
    ("sharding", assign_shards),
]

#: Fingerprints, k-means and fitted rates are not SQL; tests compare run() with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last one's rows."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
