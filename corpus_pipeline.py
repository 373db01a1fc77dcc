"""The corpus pipeline: the documents pass its stages one after the other.

Each stage is written as Parquet to the shared folder and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.stages import pack, remove_near_copies, remove_passages, remove_toxic, sample_mix
from tallyloom.sources.tables import stage

STAGES = [
    ("toxicity", remove_toxic),
    ("near_dedup", remove_near_copies),
    ("substring_dedup", remove_passages),
    ("mixing", sample_mix),
    ("packing", pack),
]

# Hash fingerprints, learned scores and greedy packing have no SQL; the tests hold
# each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
