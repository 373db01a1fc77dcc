"""Correlation, Welch's t-test and the chi-square test of independence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.tails import chi2_tail, p_text, t_tail, verdict
from tallyloom.operators.comoments import pair_correlations
from tallyloom.operators.rank import drop_null_keys, empty_table, with_stats
from tallyloom.operators.reshape import crosstab_long
from tallyloom.sources.tables import stage
from tallyloom.spec import as_double, col, numeric_columns, require_columns

ALPHA = 0.05


def _upper(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """``(i, j, column_a, column_b, r)`` of the pairs ``i <= j``."""
    columns = numeric_columns(df) if columns is None else list(columns)
    require_columns(df, columns)
    if not columns:
        return empty_table(df, "i int, j int, column_a string, column_b string, r double")
    names = F.array(*[F.lit(c) for c in columns])
    return pair_correlations(df, [as_double(df, c) for c in columns]).select(
        "i", "j", names[F.col("i")].alias("column_a"), names[F.col("j")].alias("column_b"), "r"
    )


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson's r over jointly known rows, one row per pair ``i < j``.

    Null if undefined: fewer than two such rows, a column constant in them, infinities.
    """
    return _upper(df, columns).where(F.col("i") < F.col("j"))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """All cells of the matrix in long form, diagonal and mirrored half included."""
    upper = _upper(df, columns)
    cell = ["i", "j", "column_a", "column_b", "r"]
    mirrored = F.array(
        F.struct(*cell),
        F.struct(
            F.col("j").alias("i"),
            F.col("i").alias("j"),
            F.col("column_b").alias("column_a"),
            F.col("column_a").alias("column_b"),
            "r",
        ),
    )
    both = F.when(F.col("i") < F.col("j"), mirrored).otherwise(F.array(F.struct(*cell)))
    return upper.select(F.inline(both))


def top_correlations(pairs: DataFrame, top_n: int = 5, digits: int = 3) -> DataFrame:
    """Strongest pairs by the rounded coefficient, ties in column order."""
    r = F.bround("r", digits)
    return pairs.orderBy(F.abs(r).desc_nulls_last(), "i", "j").limit(top_n)


def _moments(df: DataFrame, value: str, group: str, by: Sequence[str]) -> DataFrame:
    """Count, mean and variance of the value per label, labels without values included."""
    v = as_double(df, value)
    return (
        drop_null_keys(df, [group])
        .groupBy(*[col(b) for b in by], col(group).alias("_label"))
        .agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_samp(v).alias("var"))
    )


def group_moments(df: DataFrame, value: str, group: str) -> DataFrame:
    require_columns(df, [value, group])
    return _moments(df, value, group, ()).withColumnRenamed("_label", group)


def welch_t(
    df: DataFrame, value: str, group: str, by: Sequence[str] = (), alpha: float = ALPHA
) -> DataFrame:
    """Two-sided t-test with unequal variances between the two labels of ``group``.

    One row, or one per ``by`` segment. The labels take part in sorted order. More or
    fewer than two labels is an error; in a segment it leaves the statistics null.
    """
    require_columns(df, [value, group, *by])
    # One row per label from here on.
    first, last = F.struct("_label", "n", "mean", "var"), F.col("_label")
    sides = (
        _moments(df, value, group, by)
        .groupBy(*[col(b) for b in by])
        .agg(
            F.count(F.lit(1)).alias("n_labels"),
            F.min_by(first, last).alias("a"),
            F.max_by(first, last).alias("b"),
        )
    )
    if not by:
        wrong = F.concat(F.lit("a t-test takes two groups, found "), F.col("n_labels").cast("string"))
        checked = F.when(F.col("n_labels") != 2, F.raise_error(wrong)).otherwise(F.col("n_labels"))
        sides = sides.withColumn("n_labels", checked.cast("long"))
    two = F.col("n_labels") == 2
    ea, eb = F.try_divide("a.var", "a.n"), F.try_divide("b.var", "b.n")
    df_w = F.try_divide(
        F.pow(ea + eb, 2.0), F.try_divide(ea * ea, F.col("a.n") - 1) + F.try_divide(eb * eb, F.col("b.n") - 1)
    )
    tested = sides.select(
        *[col(b) for b in by],
        F.lit("Welch's independent t-test").alias("test"),
        F.lit(value).alias("value_col"),
        F.lit(group).alias("group_col"),
        F.col("a._label").cast("string").alias("group_a"),
        F.when(two, F.col("b._label").cast("string")).alias("group_b"),
        F.col("a.mean").alias("mean_a"),
        F.when(two, F.col("b.mean")).alias("mean_b"),
        F.col("a.n").alias("n_a"),
        F.when(two, F.col("b.n")).alias("n_b"),
        "n_labels",
        F.when(two, F.try_divide(F.col("a.mean") - F.col("b.mean"), F.sqrt(ea + eb))).alias("t_stat"),
        F.when(two, df_w).alias("df"),
    )
    claim = F.concat(
        F.lit(f"the mean of {value} differs between '"), F.col("group_a"),
        F.lit("' and '"), F.col("group_b"), F.lit("'"),
    )
    return _judged(tested, t_tail("t_stat", "df"), alpha, claim)


def chi2_independence(df: DataFrame, a: str, b: str, alpha: float = ALPHA) -> DataFrame:
    """Chi-square test of independence of two columns, one row.

    Yates' correction applies with one degree of freedom. Only cells that hold rows are
    visited: what the empty ones add follows from the margins, so a large sparse table
    needs no grid of all pairs of values.
    """
    cells = stage(crosstab_long(df, a, b).toDF("a", "b", "o"), "cells")
    rows = cells.groupBy("a").agg(F.sum("o").alias("row_n"), F.count(F.lit(1)).alias("row_cells"))
    cols = cells.groupBy("b").agg(F.sum("o").alias("col_n"), F.count(F.lit(1)).alias("col_cells"))
    row_side = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("row_n").alias("n"),
        F.sum(F.try_divide(F.lit(1.0), "row_n")).alias("row_inverse"),
    )
    total = F.struct("n_rows", "n", "row_inverse")
    side = row_side.select(total).scalar()
    col_side = cols.agg(
        F.count(F.lit(1)).alias("n_cols"), F.sum(F.try_divide(F.lit(1.0), "col_n")).alias("col_inverse")
    ).select(F.struct("n_cols", "col_inverse")).scalar()

    o = F.col("o").cast("double")
    e = F.col("row_n") / F.col("n") * F.col("col_n")
    summed = (
        with_stats(with_stats(cells, rows, ["a"], "row_cells"), cols, ["b"], "col_cells")
        .withColumn("n", side.getField("n"))
        .agg(
            F.count(F.lit(1)).alias("n_cells"),
            F.sum((o - e) * (o - e) / e).alias("seen"),
            F.sum(e).alias("expected"),
            F.max(F.abs(o - e)).alias("gap"),
        )
        .withColumn("r", side)
        .withColumn("c", col_side)
        .select("n_cells", "seen", "expected", "gap", "r.*", "c.*")
    )
    dof = (F.col("n_rows") - 1) * (F.col("n_cols") - 1)
    full = F.col("n_cells") == F.col("n_rows") * F.col("n_cols")
    empty = F.when(full, 0.0).otherwise(F.col("n") - F.col("expected"))
    shrunk = F.greatest(F.col("gap") - 0.5, F.lit(0.0))
    yates = shrunk * shrunk * F.col("n") * F.col("row_inverse") * F.col("col_inverse")
    tested = summed.select(
        F.lit("Chi-square test of independence").alias("test"),
        F.lit(a).alias("col_a"),
        F.lit(b).alias("col_b"),
        F.when(dof == 0, 0.0).when(dof == 1, yates).otherwise(F.col("seen") + empty).alias("chi2"),
        dof.cast("long").alias("dof"),
    )
    return _judged(tested, chi2_tail("chi2", F.col("dof").cast("double")), alpha,
                   F.lit(f"{a} and {b} are related"))


def _judged(tested: DataFrame, p: Column, alpha: float, claim: Column) -> DataFrame:
    """Add p, the significance flag, p as text and the sentence."""
    judged = tested.withColumn("p_value", p).withColumn("p_text", p_text("p_value"))
    return judged.withColumn("significant", F.coalesce(F.col("p_value") < alpha, F.lit(False))).withColumn(
        "interpretation", verdict(F.col("p_value"), F.col("p_text"), alpha, claim)
    )
