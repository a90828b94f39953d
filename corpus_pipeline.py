"""The corpus pipeline: toxicity filter, near-duplicate removal, benchmark decontamination, source mix, shards.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last return the columns
of ``documents``.  ``run`` writes what a stage returns to the shared checkpoint folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.llm import decontaminate, mixing, near_dedup, sharding, toxicity
from arealis.llm.common import staged

REJECT_AT = 0.7
SHARDS = 8
ORACLE_SQL = None  # learned scores and random draws are beyond SQL


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that score below ``REJECT_AT``; the model learns from two thirds of the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_on_table(docs, labels, keep="crc32(cast(cast(doc_id as string) as binary)) % 3 != 1")
    return toxicity.score_toxicity(docs, model).where(F.col("toxicity") < REJECT_AT).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates at 80 %: the one of the least id."""
    return near_dedup.drop_near_duplicates(docs, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The readings of the mix in training order: a row per reading; a text that its source's target ends is cut there."""
    read = mixing.lay_out(mixing.plan_mix(docs))
    return read.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def deal_to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in shards of equal counts, in uniform random order."""
    return sharding.shard_uniformly(docs, SHARDS, seed=11)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", deal_to_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
