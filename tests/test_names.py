"""Columns of the user that are named like those the operators make for themselves."""

import pytest
from pyspark.sql import functions as F

import tallyloom as tl
from tallyloom.learning.features import with_class_weight

NAMES = ["x", "n", "bin", "point", "q1", "_g", "_x", "_n", "_label", "_salt", "_group", "column", "value", "total", "c0"]


@pytest.fixture(scope="module")
def rows(spark):
    x = F.pmod(F.xxhash64("id"), F.lit(40)).cast("double") + F.when(F.col("id") % 50 == 0, 900).otherwise(0)
    return spark.range(600).select((F.col("id") % 3).cast("string").alias("g"), x.alias("v")).cache()


@pytest.mark.parametrize("chart", [tl.histogram, tl.density_curve, tl.box_plot, tl.outliers])
def test_charts_of_a_group_with_any_name(rows, chart):
    def contents(df):
        return sorted(tuple(round(c, 9) if isinstance(c, float) else c for c in r) for r in df.collect())

    expect = chart(rows, "v", "g")
    want = contents(expect)
    for name in (n for n in NAMES if n in expect.columns or n in ("_g", "_x", "_salt")):
        found = chart(rows.withColumnRenamed("g", name), "v", name)
        others = [f"_{c}" if c == name else c for c in expect.columns[1:]]
        assert found.columns == [name, *others]
        assert contents(found) == want, name


def test_a_value_column_with_any_name(rows):
    want = sorted(tuple(r) for r in tl.outliers(rows, "v", "g").collect())
    for name in ("x", "n", "_g"):
        assert sorted(tuple(r) for r in tl.outliers(rows.withColumnRenamed("v", name), name, "g").collect()) == want


@pytest.mark.parametrize("key", [None, ["_h1", "_copy"]])
def test_the_split_keeps_columns_with_any_name(spark, key):
    names = ["_h1", "_copy", "_n", "_label", "_salt", "_chunk", "_c1", "_order", "c0"]
    df = spark.range(200).select(*[(F.col("id") + i).alias(n) for i, n in enumerate(names)], (F.col("id") % 2).cast("string").alias("y"), F.lit("old").alias("is_test"))
    split = tl.stratified_split(df, "y", 0.25, key=key)
    assert split.columns == [*names, "y", "is_test"]
    assert split.where("is_test").count() == 50
    assert split.drop("is_test").exceptAll(df.drop("is_test")).isEmpty() and split.count() == 200


def test_weights_and_copies_beside_columns_with_any_name(spark):
    df = spark.createDataFrame([("a", 1, 7), ("a", 1, 7), ("b", 2, 8)], "_label string, _n int, _salt int")
    assert tl.duplicate_count(df).first()[0] == 1
    weighted = with_class_weight(df, "_label")
    assert weighted.columns == ["_label", "_n", "_salt", "weight"]
    assert {tuple(r) for r in weighted.collect()} == {("a", 1, 7, 0.75), ("b", 2, 8, 1.5)}
