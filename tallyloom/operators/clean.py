"""Duplicate removal, mode and median fills, and what the fills did to the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import clean_label
from tallyloom.operators.copies import split_repeated
from tallyloom.operators.profile import modes, null_cells
from tallyloom.operators.rank import medians, top_rows
from tallyloom.sources.tables import stage
from tallyloom.spec import as_double, col, nan_to_null, numeric_columns, present, string_columns


@dataclass(frozen=True)
class Fills:
    """Fill values of the columns that have nulls, and how many each has."""

    modes: dict[str, str]
    medians: dict[str, float]
    n_null: dict[str, int]


@dataclass(frozen=True)
class Cleaned:
    table: DataFrame
    history: DataFrame


def dedupe(df: DataFrame) -> DataFrame:
    """One row of each group of identical rows; missing equals missing.

    Only rows that may have a copy are shuffled (``copies.split_repeated``).
    """
    once, repeated = split_repeated(nan_to_null(df))
    if repeated is None:
        return once
    unique = repeated.dropDuplicates()
    return unique if once is None else once.unionAll(unique)


def fit_fills(
    df: DataFrame,
    categorical: Sequence[str] | None = None,
    numeric: Sequence[str] | None = None,
) -> Fills:
    """Mode of the string and median of the numeric columns that have nulls.

    Reads one row per column. A column without any value gets no fill.
    """
    categorical = string_columns(df) if categorical is None else list(categorical)
    numeric = numeric_columns(df) if numeric is None else list(numeric)
    picked = df.select(*[col(c) for c in [*categorical, *numeric]])
    n_null = {r["column"]: r["n_null"] for r in null_cells(picked).where("n_null > 0").collect()}
    strings = [c for c in categorical if c in n_null]
    numbers = [c for c in numeric if c in n_null]
    return Fills(
        modes={r["column"]: r["mode"] for r in modes(df, strings).collect()} if strings else {},
        medians=(
            {r["column"]: r["median"] for r in medians(df, numbers).collect()} if numbers else {}
        ),
        n_null=n_null,
    )


def apply_fills(df: DataFrame, fills: Fills) -> DataFrame:
    """Fill nulls; a numeric column is cast to double before it takes a median."""

    def filled(name: str) -> Column:
        if name in fills.modes:
            return F.coalesce(col(name), F.lit(fills.modes[name])).alias(name)
        if name in fills.medians:
            return F.coalesce(as_double(df, name), F.lit(fills.medians[name])).alias(name)
        return col(name)

    return df.select(*[filled(c) for c in df.columns])


def clean(df: DataFrame, target: str | None = None) -> Cleaned:
    """Dedupe, fill by mode and median of the deduped table, then tidy the label.

    The deduped table is written to the shared folder: the statistics then read single
    columns of it, and the full-row shuffle runs once.
    """
    unique = stage(dedupe(df), "deduped")
    fills = fit_fills(unique)
    table = apply_fills(unique, fills)
    if target in table.columns:
        table = table.withColumn(target, clean_label(col(target).cast("string")))

    def filled_cells(names: dict) -> Column:
        return F.lit(sum(fills.n_null[c] for c in names)).cast("long")

    dropped = (
        df.agg(F.count(F.lit(1)).alias("n"))
        .unionAll(unique.agg((-F.count(F.lit(1))).alias("n")))
        .agg(F.sum("n").alias("dropped_duplicates"))
    )
    history = dropped.withColumns(
        {
            "filled_categorical": filled_cells(fills.modes),
            "filled_numeric": filled_cells(fills.medians),
        }
    )
    return Cleaned(table, history)


def imputation_impact(raw: DataFrame, filled: DataFrame) -> DataFrame:
    """How far the mode fill raised the share of the mode, per string column with nulls.

    ``(position, column, mode, n_filled, before_pct, after_pct, delta_pp)``. The modes
    are read first, one row per column; both tables are then counted without a shuffle.
    """
    shared = [c for c in string_columns(raw) if c in filled.columns]
    empty = "position int, `column` string, mode string, n_filled bigint, before_pct double"
    if not shared:
        empty += ", after_pct double, delta_pp double"
        return raw.sparkSession.createDataFrame([], empty)
    found = {r["column"]: r for r in modes(raw, shared).collect()}
    known = [c for c in shared if c in found]
    rows = raw.count()
    before = raw.sparkSession.createDataFrame(
        [
            (i, c, found[c]["mode"], rows - found[c]["n_known"], found[c]["mode_n"] / found[c]["n_known"] * 100)
            for i, c in enumerate(known)
            if rows > found[c]["n_known"]
        ],
        empty,
    )
    counted = filled.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.count_if(col(c) == F.lit(found[c]["mode"])).alias(f"c{i}")
            for i, c in enumerate(known)
        ],
        F.lit(0).alias("none"),
    )
    shares = [
        F.struct(
            F.lit(c).alias("column"), (F.col(f"c{i}") / F.col("n_rows") * 100).alias("after_pct")
        )
        for i, c in enumerate(known)
    ] or [F.struct(F.lit("").alias("column"), F.lit(0.0).alias("after_pct"))]
    after = counted.select(F.inline(F.array(*shares)))
    # One row per column on both sides.
    return before.join(F.broadcast(after), "column").select(
        "position",
        "column",
        "mode",
        "n_filled",
        "before_pct",
        "after_pct",
        (F.col("after_pct") - F.col("before_pct")).alias("delta_pp"),
    )


def worst_impact(impact: DataFrame, digits: int = 2) -> DataFrame:
    """The column that the fill shifted most; the first one on a tie after rounding."""
    return top_rows(impact, F.bround("delta_pp", digits), ["position"], 1)
