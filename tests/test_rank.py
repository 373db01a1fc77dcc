import numpy as np
import pytest
from pyspark.sql import functions as F

import tallyloom as tl
from tallyloom.operators.rank import row_numbers, with_stats
from tallyloom.sources.tables import stage

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def samples():
    rng = np.random.default_rng(7)
    n = 20_000
    heavy = np.where(rng.random(n) < 0.4, 5.0, rng.normal(0, 1, n))
    return {
        "normal": rng.normal(0, 1, n),
        "heavy": heavy,
        "tail": rng.pareto(0.7, n),
        "few": rng.integers(0, 4, n).astype(float),
        "same": np.full(n, 3.25),
        "inf": np.where(rng.random(n) < 0.02, np.inf, rng.random(n)),
    }


@pytest.fixture(scope="module")
def table(spark):
    import pandas as pd

    return spark.createDataFrame(pd.DataFrame(samples())).repartition(7).cache()


def test_quantiles_are_exact(spark, table):
    found = tl.quantiles(table, table.columns, PROBS).collect()
    assert len(found) == len(table.columns)
    for row in found:
        with np.errstate(invalid="ignore"):
            expect = np.quantile(samples()[row["column"]], PROBS)
        expect[np.isnan(expect)] = np.inf  # between two infinities numpy has no answer
        assert np.allclose(list(row)[1:], expect, rtol=1e-12), row["column"]


def test_values_of_all_sizes_and_signs(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.choice([-1, 1], 3000) * 10.0 ** rng.uniform(-320, 308, 3000), [0.0, -0.0, 5e-324, 1.7e308, -1.7e308, -np.inf]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5)
    found = list(tl.quantiles(df, ["x"], [0.1, 0.4999, 0.5, 0.7, 1.0]).first())[1:]
    assert np.allclose(found, np.quantile(x, [0.1, 0.4999, 0.5, 0.7, 1.0]), rtol=1e-12)


def test_quantiles_by_a_hot_group(spark, table):
    # One group holds most rows and most of those share one value.
    grouped = table.withColumn("value", F.when(F.col("few") > 0, "hot").otherwise("cold"))
    grouped = grouped.unionByName(table.limit(1).withColumn("value", F.lit(None).cast("string")))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (limit, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            found = tl.quantiles(grouped, ["heavy"], PROBS, by=["value"]).collect()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        assert {r["value"] for r in found} == {"hot", "cold"}
        data = samples()
        for row in found:
            part = data["heavy"][(data["few"] > 0) == (row["value"] == "hot")]
            assert np.allclose(list(row)[2:], np.quantile(part, PROBS), rtol=1e-12)


def test_many_groups_beside_a_large_one(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 1500).alias("g"), F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("x"))
    frame = df.toPandas().groupby("g")["x"].quantile([0.25, 0.9]).unstack()
    found = tl.quantiles(df, ["x"], [0.25, 0.9], by=["g"]).collect()
    assert len(found) == len(frame) > 1000
    assert all(np.allclose([r["p25"], r["p90"]], frame.loc[r["g"]], rtol=1e-12) for r in found)


def test_answers_do_not_depend_on_the_partitions(spark, table):
    one = tl.quantiles(table.repartition(1), table.columns, PROBS).orderBy("column").collect()
    many = tl.quantiles(table.repartition(8), table.columns, PROBS).orderBy("column").collect()
    assert one == many


def test_quantiles_without_values_columns_or_rows(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "x double, y double")
    assert [tuple(r) for r in tl.quantiles(df, ["x", "y"], [0.5]).collect()] == [("x", 2.0)]
    assert tl.quantiles(df.limit(0), ["x"], [0.5]).count() == 0
    none = tl.quantiles(df, [], [0.5], by=["x"])
    assert none.columns == ["x", "column", "p50"] and none.count() == 0


def test_row_numbers_and_salted_statistics(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("v")).repartition(6)
    assert all(r["v"] == r["rank"] for r in row_numbers(df, [F.col("v").asc()]).collect())
    stats = df.groupBy((F.col("v") % 3).alias("k")).agg(F.count("*").alias("n"))
    met = with_stats(df.withColumn("k", F.col("v") % 3), stats, ["k"])
    assert met.count() == 5000 and met.columns == ["k", "v", "n"]


def test_top_per_group_breaks_ties(spark):
    df = spark.createDataFrame([("g", "b", 2), ("g", "a", 2), ("g", "c", 1)], "g string, k string, n long")
    out = tl.top_per_group(df, ["g"], "n", ["k"], 2).orderBy("rank").collect()
    assert [r["k"] for r in out] == ["a", "b"]


@pytest.mark.parametrize("small, gathered", [(4_096, 1_000_000), (100, 1_000_000), (1, 30), (1, 0)])
def test_what_a_row_may_hold_changes_no_quantile(spark, table, small, gathered):
    # Brackets for all groups, for the small ones only, and radix selection for the rest.
    expect = tl.quantiles(table, table.columns, PROBS).orderBy("column").collect()
    found = tl.quantiles(table, table.columns, PROBS, small=small, gathered=gathered)
    assert found.orderBy("column").collect() == expect
    by = tl.quantiles(table, ["heavy"], [0.5], by=["few"], small=small, gathered=gathered).collect()
    data = samples()
    assert {r["few"]: r["p50"] for r in by} == {k: np.median(data["heavy"][data["few"] == k]) for k in range(4)}


def test_group_columns_named_like_the_inner_ones(spark):
    df = spark.range(60).select(*[(F.col("id") % 3).alias(n) for n in ("column", "value", "total", "_salt", "_g0", "_few", "_lo0")], F.col("id").cast("double").alias("x"))
    names = [c for c in df.columns if c not in ("x", "column")]
    found = tl.quantiles(df, ["x"], [0.5], by=names)
    assert found.columns == [*names, "column", "p50"]
    assert {(r["value"], r["p50"]) for r in found.collect()} == {(0, 28.5), (1, 29.5), (2, 30.5)}


def test_many_statistics_are_not_broadcast(spark):
    # Of a small file, whose rows are many: Spark would take it for small and hold it in the driver.
    rows = spark.range(60_000).select((F.col("id") % 20_000).alias("k"), F.col("id").alias("v"))
    stats = stage(spark.range(20_000).select(F.col("id").alias("k"), F.when(F.col("id") == 7, 3).otherwise(1).alias("n")))
    for few, hot_rows, plain in ((10_000, 3, True), (10_000, 2, False), (20_000, 2, True)):
        met = with_stats(rows, stats, ["k"], "n", few, hot_rows)
        plan = met._jdf.queryExecution().executedPlan().toString()
        # All statistics, or but the key that is split.
        assert ("BroadcastHashJoin" in plan) == (few == 20_000 or hot_rows == 2)
        assert ("SortMergeJoin" in plan) == (few == 10_000)
        assert ("explode" in plan) == (not plain)
        assert met.columns == ["k", "v", "n"]
        assert met.agg(F.count("*"), F.countDistinct("v"), F.sum("n")).first() == (60_000, 60_000, 60_006)


def test_statistics_of_long_texts_are_not_broadcast(spark):
    stats = stage(spark.range(50).select(F.concat(F.col("id"), F.repeat(F.lit("x"), 100_000)).alias("k"), F.lit(1).alias("n")))
    met = with_stats(stats.select("k"), stats, ["k"], "n")
    assert "BroadcastHashJoin" not in met._jdf.queryExecution().executedPlan().toString() and met.count() == 50
