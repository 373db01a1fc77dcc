"""The data behind the charts: histograms, density curves, box plots.

A result column that has the group column's name gets an underscore before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.rank import drop_null_keys, quantiles, with_stats
from tallyloom.sources.tables import stage
from tallyloom.spec import as_double, col, require_columns

# Groups whose curves a task holds before it passes on its sums.
HELD_GROUPS = 1_000
# Moments of a cell from which the kernels of its values are summed.
MOMENTS = 20


def _by_group(df: DataFrame, value: str, group: str) -> DataFrame:
    """``(_g, x)``: the group and the value as a double, under names of their own."""
    require_columns(df, [value, group])
    return drop_null_keys(df, [group]).select(col(group).alias("_g"), as_double(df, value).alias("x"))


def _named(out: DataFrame, group: str) -> DataFrame:
    """The group under its name again; a result of the same name gets an underscore before it."""
    others = [F.col(c).alias(f"_{c}" if c == group else c) for c in out.columns if c != "_g"]
    return out.select(F.col("_g").alias(group), *others)


def histogram(df: DataFrame, value: str, group: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins over the range of all rows, per group.

    ``(group, bin, bin_start, bin_end, n)``, empty bins included; the last bin holds its
    right edge. The range is read first, two numbers.
    """
    known = _by_group(df, value, group).where("x IS NOT NULL")
    low, high = known.agg(F.min("x"), F.max("x")).first()
    if low is None:
        low, high = 0.0, 1.0
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.lit(high)).otherwise(F.lit(low) + i * F.lit(width))

    x = F.col("x")
    guess = F.least(F.floor((x - low) / width), F.lit(bins - 1)).cast("int")
    # Division may land one bin off at an edge; the edges decide.
    bin_of = (
        F.when(x < edge(guess), guess - 1)
        .when((x >= edge(guess + 1)) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )
    counts = known.groupBy("_g", bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # Every group gets a zero row per bin, added up with its counts in one aggregate. The
    # filter keeps the count in both uses of this table, so that one shuffle serves both.
    counts = counts.where("n > 0")
    zeros = (
        counts.select("_g")
        .distinct()
        .select("_g", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .withColumn("n", F.lit(0).cast("long"))
    )
    binned = (
        counts.unionByName(zeros)
        .groupBy("_g", "bin")
        .agg(F.sum("n").alias("n"))
        .select(
            "_g", "bin", edge(F.col("bin")).alias("bin_start"),
            edge(F.col("bin") + 1).alias("bin_end"), "n",
        )
    )
    return _named(binned, group)


def density_curve(df: DataFrame, value: str, group: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density per group with Scott's bandwidth: ``(group, point, x, density)``.

    The grid runs from the smallest to the largest value of the group. A group without spread,
    or with infinite values, has no curve.

    Rows only add to the moments of cells one bandwidth wide; kernels are evaluated once for
    each cell and grid point. With ``u`` from grid point and ``t`` from value to the centre of
    the cell, in bandwidths, ``exp(-(u - t)^2 / 2) = exp(-u^2 / 2) * sum of He_k(u) t^k / k!``.
    As ``|He_k(u)| exp(-u^2 / 4) <= 1.09 sqrt(k!)`` and ``|t| <= 1 / 2``, the terms left out after
    ``MOMENTS`` add up to less than 1e-15 of the height of a kernel.
    """
    known = _by_group(df, value, group).toDF("_group", "_x").where("_x IS NOT NULL")
    stats = (
        known.groupBy("_group")
        .agg(
            F.count("_x").alias("total"),
            F.stddev_samp("_x").alias("spread"),
            F.min("_x").alias("low"),
            F.max("_x").alias("high"),
        )
        .where(F.expr("total > 1 AND spread > 0 AND spread < double('inf') AND low < high"))
        .withColumn("bandwidth", F.col("spread") * F.pow(F.col("total").cast("double"), F.lit(-0.2)))
        .withColumn("step", (F.col("high") - F.col("low")) / (points - 1))
    )
    place = (F.col("_x") - F.col("low")) / F.col("bandwidth")
    cells = (
        with_stats(known, stage(stats.drop("spread", "high"), "density"), ["_group"], "total")
        .withColumn("cell", F.floor(place))
        .withColumn("t", place - F.col("cell") - 0.5)
        .groupBy("_group", "total", "low", "bandwidth", "step", "cell")
        .agg(*[F.sum(p).alias(f"m{k}") for k, p in enumerate(_powers(F.col("t"), MOMENTS))])
    )
    kind = known.schema["_group"].dataType.simpleString()
    curves = (
        cells.mapInPandas(_kernel_sums(points), f"_group {kind}, point int, x double, density double")
        .groupBy("_group", "point")
        .agg(F.max("x").alias("x"), F.greatest(F.sum("density"), F.lit(0.0)).alias("density"))
        .select(F.col("_group").alias("_g"), "point", "x", "density")
    )
    return _named(curves, group)


def _powers(t: Column, number: int) -> list[Column]:
    """``t^0`` to ``t^(number - 1)``, each a product of two earlier ones."""
    out = [F.lit(1.0), t]
    while len(out) < number:
        half = len(out) // 2
        out.append(out[half] * out[len(out) - half])
    return out


def _kernel_sums(points: int):
    """Kernel sums of cells at the grid points of their groups, added up in the tasks."""
    steps = np.arange(points)
    factorials = np.cumprod([1.0, *range(1, MOMENTS)])

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}

        def passed_on() -> pd.DataFrame:
            found = [(g, i, float(x), float(d)) for g, (grid, sum_) in held.items() for i, (x, d) in enumerate(zip(grid, sum_))]
            held.clear()
            return pd.DataFrame(found, columns=["_group", "point", "x", "density"])

        for batch in batches:
            for g, part in batch.groupby("_group", sort=False):
                first = part.iloc[0]
                if g not in held:
                    held[g] = [first["low"] + steps * first["step"], np.zeros(points)]
                grid, sum_ = held[g]
                terms = part[[f"m{k}" for k in range(MOMENTS)]].to_numpy(float) / factorials
                centres = part["cell"].to_numpy(float) + 0.5
                scale = first["total"] * first["bandwidth"] * np.sqrt(2 * np.pi)
                for at in range(0, len(part), 4096):
                    u = (grid[:, None] - first["low"]) / first["bandwidth"] - centres[at : at + 4096]
                    # exp(-u^2 / 2) He_k(u) by the recurrence of the Hermite polynomials
                    last, now = np.zeros_like(u), np.exp(-u * u / 2)
                    for k in range(MOMENTS):
                        sum_ += now @ terms[at : at + 4096, k] / scale
                        last, now = now, u * now - k * last
            if len(held) > HELD_GROUPS:
                yield passed_on()
        if held:
            yield passed_on()

    return sums


def box_plot(df: DataFrame, value: str, group: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers and outlier counts per group.

    Whiskers end at the furthest values within ``reach`` times the quartile distance.
    """
    return _named(_boxes(_by_group(df, value, group), reach), group)


def _boxes(known: DataFrame, reach: float) -> DataFrame:
    quartiles = quantiles(
        known, ["x"], [0.25, 0.5, 0.75], by=["_g"], names=["q1", "median", "q3"], count="_size"
    ).drop("column")
    placed = with_stats(known.where("x IS NOT NULL"), quartiles, ["_g"], "_size").withColumn("n", F.lit(1).cast("long"))
    low = F.col("q1") - (F.col("q3") - F.col("q1")) * reach
    high = F.col("q3") + (F.col("q3") - F.col("q1")) * reach
    x = F.col("x")
    inner = placed.groupBy("_g", "q1", "median", "q3").agg(
        F.sum("n").alias("n"),
        F.min(F.when(x >= low, x)).alias("inner_low"),
        F.max(F.when(x <= high, x)).alias("inner_high"),
        F.coalesce(F.sum(F.when(x < low, F.col("n"))), F.lit(0)).alias("n_below"),
        F.coalesce(F.sum(F.when(x > high, F.col("n"))), F.lit(0)).alias("n_above"),
    )
    # With interpolated quartiles the furthest inner value can fall inside the box.
    return inner.select(
        "_g",
        "n",
        F.least("inner_low", "q1").alias("whisker_low"),
        "q1",
        "median",
        "q3",
        F.greatest("inner_high", "q3").alias("whisker_high"),
        "n_below",
        "n_above",
    )


def outliers(df: DataFrame, value: str, group: str, reach: float = 1.5) -> DataFrame:
    """The distinct values beyond the whiskers with their counts: ``(group, x, n)``."""
    rows = _by_group(df, value, group)
    box = stage(_boxes(rows, reach).where("n_below + n_above > 0").select("_g", "n", "whisker_low", "whisker_high"), "boxes")
    beyond = (F.col("x") < F.col("whisker_low")) | (F.col("x") > F.col("whisker_high"))
    far = with_stats(rows, box, ["_g"], "n").where(beyond)
    return _named(far.groupBy("_g", "x").agg(F.count(F.lit(1)).alias("n")), group)
