"""Profiles: shape, nulls, types, value counts, descriptive statistics, group means."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.copies import split_repeated
from tallyloom.operators.rank import drop_null_keys, empty_table, quantiles, top_per_group
from tallyloom.sources.tables import stage
from tallyloom.spec import as_double, col, numeric_columns, present, require_columns, string_columns

# Aggregates of more columns would outgrow a compiled stage. Each part of a wide table
# scans its own columns only.
CHUNK = 50


def per_chunk(build: Callable[[list[str]], DataFrame], columns: Sequence[str]) -> DataFrame:
    parts = [build(list(columns[i : i + CHUNK])) for i in range(0, max(1, len(columns)), CHUNK)]
    return reduce(DataFrame.unionByName, parts)


def column_list(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The column names as a table ``(position, column)``, one row each."""
    rows = list(enumerate(columns))
    return df.sparkSession.createDataFrame(rows, "position int, `column` string")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("long")
    )


def dtypes(df: DataFrame) -> DataFrame:
    rows = [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, `column` string, dtype string")


def null_cells(df: DataFrame) -> DataFrame:
    """Null count of every column: ``(column, n_null, n_rows)``."""

    def count(columns: list[str]) -> DataFrame:
        counted = df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count_if(present(df, c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)],
        )
        cells = [
            F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("n_null"))
            for i, c in enumerate(columns)
        ]
        return counted.select("n_rows", F.inline(F.array(*cells))).select("column", "n_null", "n_rows")

    if not df.columns:
        return empty_table(df, "`column` string, n_null bigint, n_rows bigint")
    return per_chunk(count, df.columns)


MOMENTS = ("count", "mean", "std", "min", "max")


def column_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls of every column and moments of the numeric ones, from one aggregate over the
    table: ``(position, column, n_rows, n_null, numeric, count, mean, std, min, max)``."""
    columns = df.columns if columns is None else list(columns)
    numeric = set(numeric_columns(df))

    def stats(part: list[str]) -> DataFrame:
        aggs: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
        cells = []
        for i, c in enumerate(part):
            aggs.append(F.count(present(df, c)).alias(f"known{i}"))
            moments = [F.lit(None).cast("double").alias(m) for m in MOMENTS[1:]]
            if c in numeric:
                v = as_double(df, c)
                found = zip(MOMENTS[1:], (F.avg(v), F.stddev_samp(v), F.min(v), F.max(v)))
                aggs += [a.alias(f"{m}{i}") for m, a in found]
                moments = [F.col(f"{m}{i}").alias(m) for m in MOMENTS[1:]]
            cells.append(
                F.struct(
                    F.lit(columns.index(c)).alias("position"), F.lit(c).alias("column"), F.col("n_rows"),
                    (F.col("n_rows") - F.col(f"known{i}")).alias("n_null"), F.lit(c in numeric).alias("numeric"),
                    F.col(f"known{i}").alias("count"), *moments,
                )
            )
        return df.agg(*aggs).select(F.inline(F.array(*cells)))

    return per_chunk(stats, columns)


def null_profile(df: DataFrame) -> DataFrame:
    """Count and share of nulls, for the columns that have any."""
    return (
        null_cells(df)
        .where(F.col("n_null") > 0)
        .select("column", "n_null", (F.col("n_null") / F.col("n_rows") * 100).alias("null_pct"))
    )


def total_nulls(df: DataFrame) -> DataFrame:
    return null_cells(df).agg(F.sum("n_null").alias("n_null"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of identical rows; only rows that may have a copy
    are shuffled."""
    repeated = split_repeated(df.select(*[present(df, c).alias(f"c{i}") for i, c in enumerate(df.columns)]))[1]
    if repeated is None:
        return empty_table(df, "n bigint").agg(F.count("n").alias("n_duplicates"))
    groups = repeated.groupBy(*repeated.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"))


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Frequencies of the non-null values of string columns: ``(column, value, n)``."""
    columns = string_columns(df) if columns is None else list(columns)
    require_columns(df, columns)
    if not columns:
        return empty_table(df, "`column` string, value string, n bigint")
    wide = df.select(*[col(c).cast("string").alias(c) for c in columns])
    return (
        wide.unpivot([], [col(c) for c in columns], "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column, the smallest on a tie, with its count.

    ``(column, mode, mode_n, n_known)``; no row for a column without values.
    """
    return modes_of(value_counts(df, columns))


def modes_of(counts: DataFrame) -> DataFrame:
    """The same of a table of counts, as ``value_counts`` returns it."""
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"),
        F.max("n").alias("mode_n"),
        F.sum("n").alias("n_known"),
    )


def categorical_profile(
    df: DataFrame, top_n: int = 3, columns: Sequence[str] | None = None
) -> DataFrame:
    """Distinct values per string column and its ``top_n`` values.

    One row per listed value: ``(position, column, n_unique, rank, value, n, pct)`` with
    the share of non-null rows; a column without values keeps one row without a value.
    """
    columns = string_columns(df) if columns is None else list(columns)
    counts = value_counts(df, columns)
    per_column = counts.groupBy("column").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_unique")
    )
    top = top_per_group(counts, ["column"], "n", ["value"], top_n)
    # The two sides to broadcast have one row per column of the table.
    return (
        column_list(df, columns)
        .join(F.broadcast(per_column), "column", "left")
        .join(top, "column", "left")
        .select(
            "position",
            "column",
            F.coalesce("n_unique", F.lit(0)).alias("n_unique"),
            "rank",
            "value",
            "n",
            (F.col("n") / F.col("total") * 100).alias("pct"),
        )
    )


def target_share(df: DataFrame, target: str) -> DataFrame:
    """Rows and share of each non-null label; empty without the target column."""
    if target not in df.columns:
        return df.sparkSession.createDataFrame([], "label string, n bigint, pct double")
    counts = (
        df.where(col(target).isNotNull())
        .groupBy(col(target).cast("string").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") / total * 100)


def majority_share(df: DataFrame, target: str) -> DataFrame:
    """Share of the largest class: the accuracy of always guessing it."""
    return target_share(df, target).agg((F.max("pct") / 100).alias("majority_share"))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    columns = numeric_columns(df) if columns is None else list(columns)
    require_columns(df, columns)
    if not columns:
        measures = ("mean", "std", "min", "q1", "median", "q3", "max")
        return empty_table(df, "position int, `column` string, count bigint, " + ", ".join(f"{m} double" for m in measures))

    return _described(column_stats(df, columns), df, columns)


def _described(stats: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    quartiles = per_chunk(
        lambda part: quantiles(df, part, [0.25, 0.5, 0.75], names=["q1", "median", "q3"]), columns
    )
    # One row per column of the table.
    return stats.join(F.broadcast(quartiles), "column", "left").select(
        "position", "column", "count", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def group_summary(df: DataFrame, keys: Sequence[str], means: Mapping[str, str]) -> DataFrame:
    """Row count and means per group; rows with a null key are left out."""
    require_columns(df, [*keys, *means.values()])
    return (
        drop_null_keys(df, keys)
        .groupBy(*[col(k) for k in keys])
        .agg(
            F.count(F.lit(1)).alias("count"),
            *[F.avg(as_double(df, c)).alias(name) for name, c in means.items()],
        )
    )


def by_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Order by ``count`` descending, ties by key."""
    return df.orderBy(F.col("count").desc(), *[col(k) for k in keys])


def long_rows(
    df: DataFrame, section: str, item: Column, metrics: Sequence[str]
) -> DataFrame:
    """Reshape one stage result to report rows, one per item and metric."""
    types = dict(df.dtypes)
    parts = []
    for m in metrics:
        text = types[m] in ("string", "boolean")
        parts.append(
            F.struct(
                F.lit(m).alias("metric"),
                (F.lit(None) if text else col(m)).cast("double").alias("value_num"),
                (col(m) if text else F.lit(None)).cast("string").alias("value_str"),
            )
        )
    return df.select(
        F.lit(section).alias("section"),
        item.cast("string").alias("item"),
        F.inline(F.array(*parts)),
    )


def eda_summary(df: DataFrame, target: str) -> DataFrame:
    """Shape, duplicates, types, nulls, label counts and statistics in the long form."""
    table = F.lit("table")
    stats = stage(column_stats(df), "column_stats")
    width = F.lit(len(df.columns)).cast("long").alias("n_cols")
    size = stats.agg(F.max("n_rows").alias("n_rows")).select("n_rows", width)
    nulls = stats.where("n_null > 0").select("column", "n_null", (F.col("n_null") / F.col("n_rows") * 100).alias("null_pct"))
    numeric = numeric_columns(df)
    described = _described(stats.where("numeric"), df, numeric) if numeric else describe_numeric(df)
    return (
        long_rows(size, "shape", table, ["n_rows", "n_cols"])
        .unionByName(long_rows(duplicate_count(df), "duplicates", table, ["n_duplicates"]))
        .unionByName(long_rows(dtypes(df), "dtypes", F.col("column"), ["dtype"]))
        .unionByName(long_rows(nulls, "nulls", F.col("column"), ["n_null", "null_pct"]))
        .unionByName(long_rows(target_share(df, target), "target", F.col("label"), ["n", "pct"]))
        .unionByName(
            long_rows(
                described,
                "describe",
                F.col("column"),
                ["count", "mean", "std", "min", "q1", "median", "q3", "max"],
            )
        )
    )
