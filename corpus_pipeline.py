"""The corpus pipeline: toxic documents go, one of each group of near duplicates stays,
sources are mixed to their weights, and what is taken is packed into batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievewright.llm import mixing, near_dup, packing, toxicity
from sievewright.llm.common import written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labels (outside its held-out fold) does not call toxic."""
    return toxicity.reject(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id."""
    return near_dup.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document taken."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dup", near_dup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Models and hashes have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
