"""Level encoding through tables: many levels, odd names, rows in place."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tallyloom.learning.features import (
    CategoryLevels,
    FeatureVector,
    feature_names,
    feature_stages,
    feature_table,
    vector_places,
)


def rows_of(spark):
    values = [("a", "x\x00y")] * 12 + [("b", "x")] * 11 + [("rare1", "infrequent")] * 3 + [("rare2", None)] * 2 + [(None, "z" * 500)] * 10
    return spark.createDataFrame(values, "k string, m string")


@pytest.mark.parametrize("head", [50_000, 2, 0])
def test_places_do_not_depend_on_what_is_broadcast(spark, tmp_path, head):
    rows = rows_of(spark)
    slots = ["slot__k", "slot__m"]
    levels = CategoryLevels(inputCols=["k", "m"], outputCols=slots, minFrequency=10, headLevels=head)
    model = Pipeline(stages=[levels, FeatureVector(slots=slots, outputCol="features")]).fit(rows)
    new = spark.createDataFrame(
        [(0, "a", "x"), (1, "rare1", "x\x00y"), (2, None, "z" * 500), (3, "never", "never"), (4, "rare2", "infrequent"), (5, "b", None), (5, "b", None)],
        "id int, k string, m string",
    )
    # The mode of k is a, that of m the one with a NUL; the rare levels of m are "infrequent" itself.
    want = [(0, [0, 3]), (1, [2, 4]), (2, [0, 5]), (3, []), (4, [2, 6]), (5, [1, 4]), (5, [1, 4])]
    names = ["cat__k_a", "cat__k_b", "cat__k_infrequent", "cat__m_x", "cat__m_x\x00y", f"cat__m_{'z' * 500}", "cat__m_infrequent"]
    model.write().overwrite().save(str(tmp_path / "m"))
    for one in (model, PipelineModel.load(str(tmp_path / "m"))):
        encoded = one.transform(new)
        assert sorted((r[0], list(r[1])) for r in encoded.select("id", vector_places(F.col("features"))).collect()) == want
        assert feature_names(encoded) == names
    assert model.stages[0].slots()["m"][1] == "x\x00y"


def test_numbers_come_first_and_zeros_take_no_place(spark):
    rows = spark.range(40).select((F.col("id") % 4).cast("double").alias("x"), (F.col("id") % 2).cast("string").alias("k"), F.lit(1.0).alias("c0"))
    encoded = Pipeline(stages=feature_stages(["x", "c0"], ["k"])).fit(rows).transform(rows)
    assert [f.name for f in encoded.schema][:3] == ["x", "k", "c0"]
    for r in encoded.collect():
        vector = r["features"].toArray().tolist()
        assert vector == [r["num__x"], 0.0, float(r["k"] == "0"), float(r["k"] == "1")]
    assert [tuple(r) for r in feature_table(encoded).orderBy("position").collect()] == list(enumerate(["num__x", "num__c0", "cat__k_0", "cat__k_1"]))


def test_columns_named_like_the_inner_ones(spark):
    rows = spark.createDataFrame([("a", 1, "p", 5)] * 12 + [("b", 2, "q", 6)] * 12, "_value string, _row int, _s0 string, pos int")
    slots = ["one", "two"]
    for head in (50_000, 1):
        fitted = CategoryLevels(inputCols=["_value", "_s0"], outputCols=slots, headLevels=head).fit(rows)
        out = fitted.transform(rows)
        assert out.columns == [*rows.columns, *slots]
        assert {tuple(r) for r in out.collect()} == {("a", 1, "p", 5, 0.0, 0.0), ("b", 2, "q", 6, 1.0, 1.0)}


def test_a_hot_level_and_many_rare_ones(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("k"))
    fitted = CategoryLevels(inputCols=["k"], outputCols=["s"], minFrequency=1, headLevels=100).fit(rows)
    counts = fitted.transform(rows).groupBy("s").count()
    assert counts.count() == 20_001 and counts.agg(F.max("count")).first()[0] == 10_000
    assert counts.agg(F.max("s")).first()[0] == 20_000
