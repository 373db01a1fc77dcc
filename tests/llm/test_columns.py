"""Stages return the user's columns, whatever their names."""

import pytest
from pyspark.sql import functions as F

from tallyloom.llm.mixing import mixed_documents
from tallyloom.llm.simhash import one_of_each
from tallyloom.llm.substring import without_repeats

NAMES = ["__id", "__key", "__ranges", "__new", "__source", "__copy", "__copies", "user0"]


@pytest.fixture(scope="module")
def docs(spark):
    long = " ".join(f"word{i}" for i in range(80))
    rows = [(1, f"first {long}", "a"), (2, f"second {long} end", "b"), (3, "short text", None), (4, None, "a"), (5, "short text", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text"))


@pytest.mark.parametrize("stage", [one_of_each, without_repeats, mixed_documents])
def test_columns_with_the_names_of_inner_ones(docs, stage):
    more = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in NAMES])
    found, plain = stage(more), stage(docs)
    assert found.columns == more.columns
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted((tuple(r) for r in found.select(docs.columns).collect()), key=key) == sorted((tuple(r) for r in plain.collect()), key=key)
    assert all(r[n] == f"{n}{r['doc_id']}" for r in found.collect() for n in NAMES)


@pytest.mark.parametrize("stage", [one_of_each, without_repeats, mixed_documents])
def test_empty_tables(docs, stage):
    empty = docs.limit(0).withColumn("__id", F.lit("x"))
    found = stage(empty)
    assert found.columns == empty.columns and found.count() == 0
