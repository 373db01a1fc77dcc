"""Measures from confusion cells with and without the empty ones."""

from pyspark.sql import functions as F

import tallyloom as tl


def test_measures_need_no_empty_cells(spark):
    i = F.col("id")
    actual = F.when(i % 11 > 0, F.concat(F.lit("c"), i % 7))
    guess = F.when(i % 13 > 0, F.concat(F.lit("c"), F.when(i % 5 > 0, i % 7).otherwise(i % 9)))
    df = spark.range(400).select(actual.alias("a"), guess.alias("p"))
    full, few = tl.confusion(df, "a", "p"), tl.confusion(df, "a", "p", zeros=False)
    assert few.columns == full.columns and few.exceptAll(full).isEmpty()
    assert full.exceptAll(few).where("n <> 0").isEmpty() and few.count() < full.count()

    def shown(table):
        return sorted((tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in table.collect()), key=repr)

    assert shown(tl.classification_report(few)) == shown(tl.classification_report(full))
    assert shown(tl.scores(few, "c1")) == shown(tl.scores(full, "c1"))


def test_many_labels_stay_sparse(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("a"), (F.col("id") + 1).cast("string").alias("p"))
    cells = tl.confusion(df, "a", "p", zeros=False)
    assert cells.count() == 20000
    assert tl.scores(cells, "1").first()["accuracy"] == 0.0
