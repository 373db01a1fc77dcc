"""The stages of the corpus pipeline, each one operator with its decisions applied."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.mixing import label_quality, mixed_documents
from tallyloom.llm.packing import pack_documents
from tallyloom.llm.simhash import one_of_each
from tallyloom.llm.substring import without_repeats


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity model does not reject."""
    from tallyloom.llm.toxicity import clean_documents

    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that a document with a smaller id has."""
    return without_repeats(docs)


def sample_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixed_documents(docs, label_quality(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their bins."""
    return pack_documents(docs)
