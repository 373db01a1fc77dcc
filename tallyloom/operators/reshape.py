"""Crosstabs and unpivoting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.rank import drop_null_keys, with_stats
from tallyloom.sources.tables import stage
from tallyloom.spec import col, q, require_columns


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of the non-empty cells: ``(a, b, n)``; a null in either key is left out."""
    require_columns(df, [a, b])
    return drop_null_keys(df, [a, b]).groupBy(col(a), col(b)).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, a: str, b: str, values: Sequence | None = None) -> DataFrame:
    """Counts with one row per value of ``a`` and one column per value of ``b``, zeros included.

    Pass ``values`` to fix the columns; without it Spark reads the distinct values first
    and refuses more than ``spark.sql.pivotMaxValues`` of them.
    """
    require_columns(df, [a, b])
    known = drop_null_keys(df, [a, b])
    return known.groupBy(col(a)).pivot(q(b), values).count().na.fill(0)


def crosstab_pct(df: DataFrame, a: str, b: str, zeros: bool = True) -> DataFrame:
    """Share of each cell in its row, long form ``(a, b, pct)``.

    From counts and row totals. With ``zeros`` every pair of values has a row; leave them
    out where the values are many.
    """
    cells = stage(crosstab_long(df, a, b).toDF("_a", "_b", "_n"), "cells")
    totals = cells.groupBy("_a").agg(F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_cells"))
    if zeros:
        values = cells.agg(F.collect_set("_b")).scalar()
        none = totals.select("_a", F.explode(values).alias("_b"), F.lit(0).cast("long").alias("_n"))
        cells = cells.unionByName(none).groupBy("_a", "_b").agg(F.sum("_n").alias("_n"))
    return with_stats(cells, totals, ["_a"], "_cells").select(
        F.col("_a").alias(a), F.col("_b").alias(b), (F.col("_n") * 100 / F.col("_total")).alias("pct")
    )


def melt(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str, value: str
) -> DataFrame:
    """Wide to long: one row per id row and value column."""
    require_columns(df, [*ids, *values])
    return df.unpivot([col(c) for c in ids], [col(c) for c in values], variable, value)
