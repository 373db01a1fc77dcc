"""Evaluation of labelled predictions: confusion matrix, report, F1, ROC-AUC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.rank import in_ranges
from tallyloom.spec import col, require_columns


def confusion(df: DataFrame, actual: str, predicted: str, zeros: bool = True) -> DataFrame:
    """``(actual, predicted, n)`` over all labels seen on either side, zeros included.

    With ``zeros`` every pair of labels has a row. Leave them out where the labels are many:
    the measures of a class are the same without them.
    """
    require_columns(df, [actual, predicted])
    cells = df.groupBy(
        col(actual).cast("string").alias("actual"), col(predicted).cast("string").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))
    if not zeros:
        return cells
    # The filter keeps the count in both uses of this table, so that one shuffle serves both.
    cells = cells.where("n > 0")
    labels = (
        cells.select(F.explode(F.array("actual", "predicted")).alias("label"))
        .where("label IS NOT NULL")
        .distinct()
        .agg(F.collect_list("label").alias("labels"))
    )
    zeros = labels.select(F.explode("labels").alias("actual"), "labels").select(
        "actual", F.explode("labels").alias("predicted"), F.lit(0).cast("long").alias("n")
    )
    return cells.unionByName(zeros).groupBy("actual", "predicted").agg(F.sum("n").alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def per_class(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of each class, from the confusion cells."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("actual").alias("label"), hit.alias("tp"), F.col("n").alias("support"), none.alias("guessed")),
        F.struct(F.col("predicted").alias("label"), none.alias("tp"), none.alias("support"), F.col("n").alias("guessed")),
    )
    sums = (
        cells.select(F.inline(sides))
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "guessed")])
    )
    return sums.select(
        "label",
        _ratio(F.col("tp"), F.col("guessed")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("support") + F.col("guessed")).alias("f1"),
        "support",
        "tp",
    )


def classification_report(cells: DataFrame) -> DataFrame:
    """One row per class, then accuracy, macro average and weighted average."""
    classes = per_class(cells)
    measures = ("precision", "recall", "f1")
    whole = classes.agg(
        F.sum("support").alias("support"),
        F.sum("tp").alias("tp"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[F.sum(F.col(m) * F.col("support")).alias(f"weighted_{m}") for m in measures],
    )
    accuracy = _ratio(F.col("tp"), F.col("support"))
    blank = F.lit(None).cast("double")

    def line(position: int, name: str, values: list[Column]) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("label"),
            *[v.alias(m) for v, m in zip(values, measures)],
            F.col("support"),
        )

    summary = F.array(
        line(1, "accuracy", [blank, blank, accuracy]),
        line(2, "macro avg", [F.col(f"macro_{m}") for m in measures]),
        line(3, "weighted avg", [_ratio(F.col(f"weighted_{m}"), F.col("support")) for m in measures]),
    )
    return classes.select(F.lit(0).alias("position"), "label", *measures, "support").unionByName(
        whole.select(F.inline(summary))
    )


def scores(cells: DataFrame, positive: str) -> DataFrame:
    """Accuracy, macro F1 and F1 of the positive class, one row."""
    return per_class(cells).agg(
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        F.coalesce(F.max(F.when(F.col("label") == positive, F.col("f1"))), F.lit(0.0)).alias("f1_positive"),
    )


def roc_auc(df: DataFrame, score: str, is_positive: Column) -> DataFrame:
    """Exact area under the ROC curve, tied scores counting half; null with one class only.

    A score or label that is missing is an error. Scores are counted first and sorted over
    ranges: pairs inside a range by a window over it, pairs between ranges from their
    totals.
    """
    require_columns(df, [score])
    value = col(score).cast("double")
    missing = F.raise_error(F.lit("a score or label is missing"))
    counts = (
        df.select(
            F.when(value.isNull() | F.isnan(value), missing.cast("double")).otherwise(value).alias("score"),
            F.when(is_positive.isNull(), missing.cast("boolean")).otherwise(is_positive).alias("positive"),
        )
        .groupBy("score")
        .agg(
            F.count_if(F.col("positive")).cast("double").alias("pos"),
            F.count_if(~F.col("positive")).cast("double").alias("neg"),
        )
    )
    placed = in_ranges(counts, F.col("score").asc())
    inside = Window.partitionBy("_range").orderBy("score")
    won = F.col("pos") * (F.sum("neg").over(inside) - F.col("neg") / 2)
    ranges = (
        placed.withColumn("won", won)
        .groupBy("_range")
        .agg(F.sum("won").alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    # As many rows as shuffle partitions from here on.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("neg").over(earlier), F.lit(0.0))
    return (
        ranges.withColumn("before", before)
        .agg(
            F.sum(F.col("won") + F.col("pos") * F.col("before")).alias("won"),
            F.coalesce(F.sum("pos"), F.lit(0.0)).alias("n_pos"),
            F.coalesce(F.sum("neg"), F.lit(0.0)).alias("n_neg"),
        )
        .select(
            F.try_divide("won", F.col("n_pos") * F.col("n_neg")).alias("roc_auc"),
            F.col("n_pos").cast("long").alias("n_pos"),
            F.col("n_neg").cast("long").alias("n_neg"),
        )
    )
