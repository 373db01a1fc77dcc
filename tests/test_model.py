import math

import pytest
from census import people
from pyspark.ml import PipelineModel
from pyspark.sql import Observation
from pyspark.sql import functions as F

import tallyloom as tl
from tallyloom.learning.features import (
    CategoryLevels,
    CategoryLevelsModel,
    class_weights,
    feature_names,
)
from tallyloom.learning.split import class_quotas, numbered_copies
from tallyloom.spec import CENSUS_INCOME

SMALL = tl.ForestSize(trees=5, depth=4)


def quotas(spark, sizes, test_size):
    table = spark.createDataFrame(list(sizes.items()), "label string, n long")
    return {r["label"]: r["n_test"] for r in class_quotas(table, test_size).collect()}


@pytest.fixture(scope="module")
def cleaned(spark):
    return tl.stage(tl.clean(people(spark, CENSUS_INCOME.schema.names), "income").table)


@pytest.fixture(scope="module")
def fitted(cleaned):
    return tl.fit_model(cleaned, CENSUS_INCOME, SMALL)


def expand(spark, cells, schema):
    return spark.createDataFrame(cells, schema).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))


CONFUSION = [("<=50K", "<=50K", 3937), ("<=50K", ">50K", 1003), (">50K", "<=50K", 185), (">50K", ">50K", 1383)]


def test_published_scores(spark):
    df = expand(spark, CONFUSION, "y string, p string, n long")
    cells = tl.confusion(df, "y", "p")
    assert {(r["actual"], r["predicted"], r["n"]) for r in cells.collect()} == set(CONFUSION)
    row = tl.rounded(tl.scores(cells, ">50K"), 4).first()
    assert tuple(row) == (0.8175, 0.7842, 0.6995)
    report = tl.rounded(tl.classification_report(cells), 3).orderBy("position", "label").collect()
    assert [tuple(r)[1:] for r in report] == [
        ("<=50K", 0.955, 0.797, 0.869, 4940),
        (">50K", 0.580, 0.882, 0.700, 1568),
        ("accuracy", None, None, 0.817, 6508),
        ("macro avg", 0.767, 0.839, 0.784, 6508),
        ("weighted avg", 0.865, 0.817, 0.828, 6508),
    ]


def test_class_that_is_never_right_scores_zero(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("a", "c")], "y string, p string")
    rows = {r["label"]: r for r in tl.per_class(tl.confusion(df, "y", "p")).collect()}
    assert (rows["b"]["precision"], rows["b"]["recall"], rows["b"]["f1"]) == (0.0, 0.0, 0.0)
    assert rows["c"]["support"] == 0


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)], "s double, y int")
    assert tl.roc_auc(df, "s", F.col("y") == 1).first()["roc_auc"] == pytest.approx(3.5 / 4)
    alone = tl.roc_auc(df.where("y = 1"), "s", F.col("y") == 1).first()
    assert alone["roc_auc"] is None


def test_auc_wants_scores_and_labels(spark):
    for row in ((None, 1), (float("nan"), 1), (0.5, None)):
        df = spark.createDataFrame([(0.1, 0), row], "s double, y int")
        with pytest.raises(Exception, match="missing"):
            tl.roc_auc(df, "s", F.col("y") == 1).collect()


def test_auc_of_one_hot_score(spark):
    # A third of the rows share one score.
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("s"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0).alias("y"),
    )
    got = tl.roc_auc(df, "s", F.col("y")).first()["roc_auc"]
    rows = df.toPandas()
    ranks = rows["s"].rank()
    n1 = rows["y"].sum()
    expect = (ranks[rows["y"]].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(rows) - n1))
    assert got == pytest.approx(expect, rel=1e-12)


def test_published_quotas(spark):
    assert quotas(spark, {"<=50K": 24698, ">50K": 7839}, 0.2) == {"<=50K": 4940, ">50K": 1568}
    with pytest.raises(ValueError):
        quotas(spark, {"a": 1, "b": 50}, 0.2)
    many = {f"c{i:05d}": 2 + i % 7 for i in range(3000)}
    found = quotas(spark, many, 0.3)
    assert sum(found.values()) == math.ceil(0.3 * sum(many.values()))
    assert all(abs(found[c] - 0.3 * n) < 1 for c, n in many.items())


def test_split_is_exact_and_independent_of_partitions(spark):
    df = spark.range(30_000).select("id", F.when(F.pmod(F.xxhash64("id"), F.lit(4)) == 0, "p").otherwise("n").alias("y"))
    one = tl.stratified_split(df.repartition(1), "y", 0.2, key=["id"])
    many = tl.stratified_split(df.repartition(8), "y", 0.2, key=["id"])
    counts = {r["y"]: r["count"] for r in one.where("is_test").groupBy("y").count().collect()}
    sizes = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    assert counts == quotas(spark, sizes, 0.2)
    assert sum(counts.values()) == math.ceil(0.2 * 30_000)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    other = tl.stratified_split(df, "y", 0.2, seed=1, key=["id"])
    assert not one.exceptAll(other).isEmpty()


def test_split_parts_copies(spark):
    # A third of the rows are copies of one row.
    df = spark.range(3000).select(F.when(F.col("id") < 1000, -1).otherwise(F.col("id")).alias("v"), (F.col("id") % 2).cast("string").alias("y"))
    split = tl.stratified_split(df, "y", 0.25)
    assert split.where("is_test").count() == 750
    assert split.count() == 3000 and split.columns == ["v", "y", "is_test"]
    assert 0 < split.where("is_test AND v = -1").count() < 1000
    with pytest.raises(ValueError, match="does not identify rows"):
        tl.stratified_split(df.withColumn("v", F.lit(1)), "y", 0.25, key=["v"])


def test_split_without_a_key_is_repeatable(spark):
    rows = spark.range(3000).select((F.col("id") % 700).alias("v"), F.when(F.col("id") % 5 == 0, "p").otherwise("n").alias("y"))
    splits = [tl.stratified_split(rows.repartition(n), "y", 0.2) for n in (1, 2, 7)]
    first = sorted(tuple(r) for r in splits[0].collect())
    assert all(sorted(tuple(r) for r in s.collect()) == first for s in splits[1:])
    assert sum(r[2] for r in first) == 600 and len(first) == 3000


def test_split_cuts_in_several_steps(spark):
    # All hashes share their leading bits, so the cut lies deep.
    df = spark.range(5000).select("id", (F.col("id") % 3).cast("string").alias("y"))
    split = tl.stratified_split(df, "y", 0.3, key=["id"], order=F.col("id"))
    counts = split.where("is_test").groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in counts} == quotas(spark, {"0": 1667, "1": 1667, "2": 1666}, 0.3)
    top = split.where("is_test").groupBy("y").agg(F.max("id").alias("m")).collect()
    assert all(r["m"] < 1510 for r in top)


def test_split_of_many_classes(spark):
    df = spark.range(6000).select("id", (F.col("id") % 1500).cast("string").alias("y"))
    split = tl.stratified_split(df, "y", 0.25, key=["id"])
    assert {r["n"] for r in split.where("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()} == {1}


def levels(spark):
    values = ["a"] * 20 + ["b"] * 12 + ["c"] * 3 + ["d"] * 2 + [None] * 4
    return spark.createDataFrame([(v,) for v in values], "k string")


def test_rare_levels_are_pooled_and_unseen_ones_dropped(spark, tmp_path):
    fitted = CategoryLevels(inputCols=["k"], outputCols=["slot"]).fit(levels(spark))
    assert fitted.slots() == {"k": ["a", "b", "infrequent"]}
    new = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("zzz",), (None,)], "k string")
    expect = {"a": 0.0, "b": 1.0, "c": 2.0, "d": 2.0, "zzz": 3.0, None: 0.0}
    assert {r["k"]: r["slot"] for r in fitted.transform(new).collect()} == expect
    fitted.write().overwrite().save(str(tmp_path / "levels"))
    loaded = CategoryLevelsModel.load(str(tmp_path / "levels"))
    assert {r["k"]: r["slot"] for r in loaded.transform(new).collect()} == expect
    # Joined by shuffle, the mode split by salt.
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert {r["k"]: r["slot"] for r in fitted.transform(new).collect()} == expect
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_balanced_weights(spark):
    classes = spark.createDataFrame([("a", 30), ("b", 10)], "label string, n long")
    assert {r["label"]: r["weight"] for r in class_weights(classes).collect()} == {"a": 40 / 60, "b": 2.0}


def test_models_of_one_type_class(spark):
    rows = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"), F.when(F.col("id") % 20 < 8, "lo").otherwise("hi").alias("k"), F.when(F.col("id") % 20 < 8, "n").otherwise("p").alias("y"))
    base = dict(schema=rows.schema, target="y", positive_label="p", ttest_value="x", chi2_column="k", histogram_column="x", bar_column="k")
    for numeric, categorical in ((("x",), ()), ((), ("k",))):
        spec = tl.TableSpec(numeric=numeric, categorical=categorical, **base)
        assert tl.train_and_evaluate(rows, spec, size=SMALL).scores.first()["accuracy"] == 1.0


def test_scores_follow_the_predicted_label(cleaned, fitted):
    both = [tl.predict(fitted, cleaned, label) for label in (">50K", "<=50K")]
    rich, poor = ({tuple(r)[:-2]: r for r in b.collect()} for b in both)
    assert len(rich) == cleaned.distinct().count() and tl.predict(fitted, cleaned, ">50K").count() == cleaned.count()
    for k, r in rich.items():
        assert r["score"] + poor[k]["score"] == pytest.approx(1)
        assert r["predicted"] == (">50K" if r["score"] > 0.5 else "<=50K") or r["score"] == pytest.approx(0.5)


def test_predict_needs_no_label(cleaned, fitted):
    assert tl.predict(fitted, cleaned.select(*CENSUS_INCOME.features).limit(3), ">50K").count() == 3


def test_feature_names_and_importance(cleaned, fitted):
    names = feature_names(fitted.transform(cleaned.limit(0)))
    assert names[0] == "num__age" and "cat__native-country_Peru" in names
    top = tl.feature_importance(fitted, cleaned, 5).collect()
    assert len(top) == 5
    assert all(a["importance"] >= b["importance"] for a, b in zip(top, top[1:]))


def test_training_wants_target_and_features(cleaned):
    with pytest.raises(ValueError, match="target column not found"):
        tl.train_and_evaluate(cleaned.drop("income"), CENSUS_INCOME)
    with pytest.raises(ValueError, match="age"):
        tl.train_and_evaluate(cleaned.drop("age"), CENSUS_INCOME)


def test_missing_labels_are_refused(spark, cleaned):
    gap = cleaned.withColumn("income", F.when(F.col("sex") == "Male", F.col("income")))
    with pytest.raises(ValueError, match="missing values"):
        tl.train_and_evaluate(gap, CENSUS_INCOME)


def test_a_saved_model_answers_as_before(cleaned, fitted, tmp_path):
    place = tl.save_model(fitted, str(tmp_path / "kept"))
    assert tl.verify_reload(place, fitted, cleaned.drop("income"), ">50K")
    assert not tl.verify_reload(f"{place}-elsewhere", fitted, cleaned, ">50K")
    back = tl.predict(PipelineModel.load(place), cleaned, ">50K")
    assert back.exceptAll(tl.predict(fitted, cleaned, ">50K")).isEmpty()


def test_reload_notices_another_model(cleaned, fitted, tmp_path):
    other = tl.fit_model(cleaned.where("age < 40"), CENSUS_INCOME, SMALL)
    path = tl.save_model(other, str(tmp_path / "other"))
    assert tl.verify_reload(path, fitted, cleaned, ">50K") is False


def test_a_learnable_label_is_learnt(spark):
    df = people(spark, CENSUS_INCOME.schema.names, 2000)
    signal = F.when(F.col("hours-per-week") + F.when(F.col("sex") == "Male", 25).otherwise(0) > 60, ">50K").otherwise("<=50K")
    found = tl.train_and_evaluate(df.withColumn("income", signal), CENSUS_INCOME, size=tl.ForestSize(20, 5))
    row = found.scores.first()
    assert row["accuracy"] > 0.8 and row["roc_auc"] > 0.9
    sizes = found.sizes.first()
    assert sizes["n_test"] == math.ceil(0.2 * 2008) and sizes["n_train"] == 2008 - sizes["n_test"]
    assert found.predictions.count() == sizes["n_test"]
    assert "num__hours-per-week" in {r["feature"] for r in found.importance.limit(3).collect()}


def test_whole_run_from_text(spark, tmp_path):
    source = people(spark, CENSUS_INCOME.schema.names)
    text = source.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("?")).alias(c) for c in source.columns])
    path = tl.write_delimited(text, str(tmp_path / "census"))
    done = tl.run(spark, CENSUS_INCOME, path, str(tmp_path / "out"), size=SMALL)
    report = spark.read.parquet(str(tmp_path / "out" / "report"))
    sections = {r["section"] for r in report.select("section").distinct().collect()}
    assert {"reconcile", "nulls", "history", "impact", "welch_t", "chi2", "scores", "confusion", "model"} <= sections
    assert done.reload_ok is True
    agreed = report.where("section = 'reconcile' AND metric = 'equal'").select("value_str").distinct()
    assert [r[0] for r in agreed.collect()] == ["true"]
    assert tl.total_nulls(done.cleaned).first()[0] == 0


def test_numbered_copies_are_many_tasks(spark):
    # 80 chunks of two rows' copies: joined to one partition they would be one task's rows.
    df = spark.range(80_000).select((F.col("id") % 2).cast("string").alias("a"))
    numbered = numbered_copies(df)
    assert numbered.agg(F.count("*"), F.max("_copy"), F.countDistinct("a", "_copy")).first() == (80_000, 39_999, 80_000)
    assert numbered.select(F.spark_partition_id()).distinct().count() > 1


def test_split_by_a_column_of_few_values_in_one_class(spark):
    # The cut lies among rows of one first hash, parted by the second.
    rows = spark.range(4_000).select("id", F.lit("a").alias("label"), (F.col("id") % 3).alias("o"))
    split = tl.stratified_split(rows, "label", key=["id"], order=F.col("o"))
    assert split.where("is_test").groupBy("o").count().collect() == [(0, 800)]


def test_levels_that_are_not_broadcast_are_not_copied(spark):
    rows = spark.range(12_000).select(F.when(F.col("id") % 6 != 0, F.col("id").cast("string")).alias("a"))
    fitted = CategoryLevels(inputCols=["a"], outputCols=["slot"], minFrequency=1, headLevels=5).fit(rows)
    assert fitted.getOrDefault("tailLevels") == 9_995 and fitted.getOrDefault("fills") == ["1"]
    got = fitted.transform(rows)
    assert "explode(" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.agg(F.count("*"), F.countDistinct("slot")).first() == (12_000, 10_000)
    assert got.where("a IS NULL OR a = '1'").agg(F.min("slot"), F.max("slot")).first() == (0.0, 0.0)


def test_a_model_predicts_where_something_was_observed(spark):
    # An observed session can't be sent to tasks, so the model may not hold it.
    rows = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"), F.when(F.col("id") % 20 < 8, "n").otherwise("p").alias("y"))
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 400
    spec = tl.TableSpec(schema=rows.schema, target="y", positive_label="p", numeric=("x",), categorical=(), ttest_value="x", chi2_column="y", histogram_column="x", bar_column="y")
    assert tl.predict(tl.fit_model(rows, spec, SMALL), rows, "p").where("predicted = y").count() == 400


def test_whole_run_of_a_table_with_copies(spark, tmp_path):
    # Copies of rows with text are found by an observed count, before the model is asked again.
    rows = spark.range(300).select(
        (F.col("id") % 100).cast("double").alias("x"), (F.col("id") % 7).cast("string").alias("k"), F.when(F.col("id") % 100 < 40, "n").otherwise("p").alias("y")
    )
    rows = rows.unionAll(rows.limit(20))
    spec = tl.TableSpec(schema=rows.schema, target="y", positive_label="p", numeric=("x",), categorical=("k",), ttest_value="x", chi2_column="k", histogram_column="x", bar_column="k")
    done = tl.run(spark, spec, rows, str(tmp_path / "out"), size=SMALL)
    assert done.reload_ok is True and done.cleaned.count() == 300
    model = spark.read.parquet(done.report_path).where("section = 'model' AND metric = 'reload_ok'")
    assert [r["value_str"] for r in model.collect()] == ["true"]
