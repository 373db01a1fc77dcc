"""Whether two loads of the same data agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.spec import col, present


def _facts(df: DataFrame, side: str) -> DataFrame:
    """Row, column and null counts and an order-free fingerprint, long form."""
    cells = [present(df, c) for c in df.columns]
    nulls = [F.count_if(c.isNull()) for c in cells]

    def fact(position: int, metric: str, value: Column) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(metric).alias("metric"),
            value.cast("decimal(38,0)").alias("value"),
        )

    # Summed as decimals: a long sum would overflow, and xor would lose pairs of copies.
    hashed = F.coalesce(F.sum(F.xxhash64(*cells).cast("decimal(38,0)")), F.lit(0))
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[n.alias(f"c{i}") for i, n in enumerate(nulls)],
        hashed.alias("fingerprint"),
    )
    total = sum((F.col(f"c{i}") for i in range(1, len(cells))), F.col("c0"))
    facts = [
        fact(0, "n_rows", F.col("n_rows")),
        fact(1, "n_cols", F.lit(len(cells))),
        fact(2, "n_null", total),
        fact(3, "fingerprint", F.col("fingerprint")),
        *[fact(4 + i, f"n_null:{c}", F.col(f"c{i}")) for i, c in enumerate(df.columns)],
    ]
    return counted.select(F.lit(side).alias("side"), F.inline(F.array(*facts)))


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """Compare two loads: ``(metric, left_value, right_value, equal)``.

    Equal counts do not prove equal data, so a hash of all rows takes part. Compare
    tables of the same column types; the same value in two types hashes differently.
    """
    facts = _facts(left, "left").unionByName(_facts(right, "right"))

    def of(side: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col("value")))

    return (
        facts.groupBy("metric")
        .agg(F.min("position").alias("position"), of("left").alias("left_value"), of("right").alias("right_value"))
        .withColumn("equal", F.col("left_value").eqNullSafe(F.col("right_value")))
    )
