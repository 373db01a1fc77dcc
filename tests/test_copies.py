"""Rows are parted into those without a copy and those that may have one."""

import pytest
from pyspark.sql import functions as F

import tallyloom as tl
from tallyloom.learning.split import numbered_copies
from tallyloom.operators.copies import split_repeated


def wide(spark, rows, columns=12):
    """``rows`` rows that differ in their text columns."""
    return spark.range(rows).select(*[F.sha2((F.col("id") * 31 + i).cast("string"), 256).alias(f"t{i}") for i in range(columns)])


@pytest.fixture(scope="module")
def repeated(spark):
    """1,000 rows that occur once, ten that occur twice, one that occurs 5,000 times."""
    rows = wide(spark, 1000)
    twice, often = rows.orderBy("t0").limit(10), rows.orderBy(F.desc("t0")).limit(1)
    return rows.unionAll(twice).unionAll(often.crossJoin(spark.range(4999)).drop("id")).cache()


def test_each_part_holds_what_it_says(repeated):
    once, others = split_repeated(repeated)
    assert once.groupBy(*once.columns).count().where("count > 1").isEmpty()
    assert once.intersect(others).isEmpty()
    assert once.count() + others.count() == repeated.count()
    # 11 repeated hashes in 256 bits or more: few rows without a copy come along
    assert others.count() < 20 + 5000 + 60


def test_dedupe_count_and_numbers(repeated):
    assert tl.duplicate_count(repeated).first()[0] == 10 + 4999
    unique = tl.dedupe(repeated)
    assert unique.count() == 1000 and unique.exceptAll(repeated.dropDuplicates()).isEmpty()
    copies = numbered_copies(repeated)
    assert copies.drop("_copy").exceptAll(repeated).isEmpty() and copies.count() == repeated.count()
    ranges = copies.groupBy(*repeated.columns).agg(F.count("_copy").alias("n"), F.max("_copy").alias("last"), F.countDistinct("_copy").alias("d"))
    assert ranges.where("last <> n - 1 OR d <> n").isEmpty()


def test_a_full_filter_lets_rows_through_and_keeps_the_answer(spark):
    rows = wide(spark, 3000, 3)
    twice = rows.unionAll(rows.where("t0 < '8'")).cache()
    once, others = split_repeated(twice, most_words=1)
    assert once.count() + others.count() == twice.count() and others.count() > 3000
    assert tl.dedupe(twice).count() == 3000


def test_missing_values_in_different_columns_are_different_rows(spark):
    rows = [("a", None, "t" * 40), (None, "a", "t" * 40), (None, "a", "t" * 40), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    assert tl.duplicate_count(df).first()[0] == 2
    assert sorted(map(tuple, tl.dedupe(df).collect()), key=str) == sorted(set(rows), key=str)
    once, _ = split_repeated(df)
    assert [tuple(r) for r in once.collect()] in ([rows[0]], [])


def test_zeros_gaps_and_nested_values(spark):
    nan = float("nan")
    rows = [(0.0, [1, None], ("a", -0.0)), (-0.0, [1, None], ("a", 0.0)), (nan, [None], ("b", nan)), (None, [None], ("b", nan)), (1.0, [], ("c", 1.0))]
    df = spark.createDataFrame(rows, "x double, l array<int>, s struct<k: string, v: double>")
    assert tl.dedupe(df).count() == 3 and tl.duplicate_count(df).first()[0] == 2


def test_nothing_is_repeated(spark):
    df = wide(spark, 500)
    once, others = split_repeated(df)
    assert others is None and once.count() == 500
    assert tl.duplicate_count(df).first()[0] == 0 and tl.dedupe(df).count() == 500
    empty = df.limit(0)
    assert tl.duplicate_count(empty).first()[0] == 0 and tl.dedupe(empty).count() == 0


def test_texts_that_another_collation_holds_equal(spark):
    df = spark.createDataFrame([("a" * 40,), ("A" * 40,)], "t string").select(F.expr("t COLLATE UTF8_LCASE").alias("t"))
    assert tl.dedupe(df).count() == 1


def test_random_columns_are_drawn_once(spark):
    df = wide(spark, 200, 2).select(F.floor(F.rand() * 100).alias("r"), F.lit("x" * 50).alias("t"))
    found = tl.dedupe(df)
    assert found.count() == found.distinct().count() <= 100


def test_columns_with_any_name(spark):
    df = wide(spark, 300, 4).toDF("h", "n", "word", "a.b")
    twice = df.unionAll(df.limit(5))
    assert tl.dedupe(twice).columns == ["h", "n", "word", "a.b"] and tl.dedupe(twice).count() == 300


def test_rows_without_copies_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = wide(spark, 5000, 20)
    rows.unionAll(rows.limit(3)).write.parquet(path)
    once, others = split_repeated(spark.read.parquet(path))
    assert others.count() < 60  # all that dropDuplicates shuffles
    plan = once._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main


def test_hardly_any_row_occurs_once(spark):
    df = spark.range(4_000).select(F.when(F.col("id") < 3, F.col("id") + 100).otherwise(F.col("id") % 9).cast("string").alias("a"))
    once, repeated = split_repeated(df)
    assert once is None and repeated.count() == 4_000
    assert tl.dedupe(df).count() == 12
