"""Exact ranks and prefix sums without a single-task sort, and top-k.

Quantiles take two passes. The first merges a quantile summary per group, whose rank error is
bounded, and reads from it a bracket around each wanted rank. The second counts the distinct
values inside the brackets, and what lies between brackets as one: inside there are, but for
equal values, only the summary's share of the rows.

Groups so large that this share is too much for one task, or whose bracket the counts show to
be wrong, go on by radix selection: values are counted by their order-preserving leading
digits, first sign and power of two, then 4096 steps of the interval that holds a wanted
rank, until an interval is one value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources.tables import stage
from tallyloom.spec import as_double, col, columns_of, q

STEPS = 4096
# The summary's rank error is a share of 1 / ACCURACY of the rows; brackets allow three times it.
ACCURACY = 10_000
MARGIN = 3.0 / ACCURACY
SMALL = 4_096  # groups of so few rows need no bracket
GATHERED = 1_000_000  # distinct values inside a bracket that one task may put in order
# Statistics of so many groups, whose texts have so many bytes, are broadcast.
FEW_GROUPS, FEW_BYTES = 10_000, 4 << 20
# A group of more rows than this meets its statistics in so many parts where they are joined by
# shuffle, so that it is more than one task.
HOT_ROWS = 1_000_000
SALTS = 16


def melt_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form ``(*by, column, value)`` of numeric columns as doubles, no nulls."""
    wide = df.select(*[col(b) for b in by], *[as_double(df, c).alias(c) for c in columns])
    return wide.unpivot(
        [col(b) for b in by], [col(c) for c in columns], "column", "value"
    ).where(F.col("value").isNotNull())


def empty_table(df: DataFrame, schema: str, by: Sequence[str] = ()) -> DataFrame:
    """No rows of the columns ``by`` of a table and those of ``schema``."""
    none = df.sparkSession.createDataFrame([], schema)
    return df.select(*[col(b) for b in by]).limit(0).join(none) if by else none


def with_stats(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    size: str | None = None,
    few: int = FEW_GROUPS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join rows to the statistics of their key.

    The statistics are counted first, so they should be cheap to read. Few are broadcast and
    rows stay in place. Others are never broadcast, whatever Spark takes a compressed file of
    them to be; both sides are shuffled then. ``size`` names the statistic that tells how many
    rows a key has: only keys of more than ``hot_rows`` are split by salt.
    """
    hot = F.coalesce(F.col(size) > hot_rows, F.lit(False)) if size else F.lit(False)
    texts = [F.coalesce(F.octet_length(col(c)), F.lit(0)) for c in columns_of(stats, T.StringType, T.BinaryType)]
    width = reduce(lambda a, b: a + b, texts, F.lit(0).cast("long"))
    number, length, n_hot = stats.agg(F.count(F.lit(1)), F.sum(width), F.count_if(hot)).first()
    if number <= few and (length or 0) <= FEW_BYTES:
        return rows.join(F.broadcast(stats), list(keys))
    if not n_hot:
        return rows.join(stats.hint("merge"), list(keys))
    # Hot keys are fewer than one in hot_rows rows.
    split = stats.where(hot).select(*[col(k) for k in keys], F.lit(True).alias("_hot")).distinct()
    part = F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).otherwise(0)
    salted = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(hot, SALTS - 1).otherwise(0))))
    return (
        rows.join(F.broadcast(split), list(keys), "left")
        .withColumn("_salt", part)
        .drop("_hot")
        .join(salted.hint("merge"), [*keys, "_salt"])
        .drop("_salt")
    )


def in_ranges(df: DataFrame, *order: Column) -> DataFrame:
    """The table in the shared folder, sorted over numbered ranges (``_range``, from 0),
    of which there are as many as Spark makes shuffle partitions."""
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(sorted_.withColumn("_range", F.spark_partition_id()), "ranges")


def row_numbers(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Number all rows from 0 in an order that leaves no ties."""
    held = in_ranges(df, *order)
    sizes = held.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return (
        held.withColumn("_inside", inside)
        .join(before, "_range")
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_range", "_before", "_inside")
    )


def _octave(x: Column) -> Column:
    """Sign and power of two of a value, in the order of the values."""
    power = F.least(F.floor(F.log2(F.abs(x))), F.lit(1030).cast("long"))
    return F.when(x == 0, 0).otherwise(F.signum(x).cast("int") * (power + 1100).cast("int"))


def _select(long: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The values next to each wanted rank: ``(*keys, total, i, high, value)``.

    ``i`` is the number of the probability; ``high`` marks the upper neighbour. One pass
    over the values for each digit.
    """
    key_cols, x = [col(k) for k in keys], F.col("value")

    def counted(rows: DataFrame, within: Sequence[str], digit: Column) -> DataFrame:
        counts = (
            rows.groupBy(*key_cols, *within, digit.alias("_bin"))
            .agg(F.count(F.lit(1)).alias("_n"), F.min(x).alias("_lo"), F.max(x).alias("_hi"))
        )
        # At most STEPS rows in a group of these.
        whole = Window.partitionBy(*[q(k) for k in [*keys, *within]])
        return counts.withColumns(
            {"_start": F.sum("_n").over(whole.orderBy("_bin")) - F.col("_n"), "_total": F.sum("_n").over(whole)}
        )

    ranks = []
    for i, p in enumerate(probs):
        low = F.floor((F.col("_total") - 1) * F.lit(float(p)))
        for high in (False, True):
            ranks.append(F.struct(F.lit(i).alias("i"), F.lit(high).alias("high"), (low + int(high)).alias("rank")))
    first = (
        counted(long, [], _octave(x))
        .withColumn("_want", F.explode(F.filter(F.array(*ranks), lambda w: (w["rank"] >= F.col("_start")) & (w["rank"] < F.col("_start") + F.col("_n")))))
        .select(*key_cols, F.col("_total").alias("total"), "_want.i", "_want.high", (F.col("_want.rank") - F.col("_start")).alias("_place"), "_n", "_lo", "_hi")
    )
    found, picked = [], stage(first, "picked")
    known = (F.col("_lo") == F.col("_hi")) | (F.col("_place") == 0) | (F.col("_place") == F.col("_n") - 1)
    while True:
        value = F.when(F.col("_place") == 0, F.col("_lo")).otherwise(F.col("_hi"))
        found.append(picked.where(known).select(*key_cols, "total", "i", "high", value.alias("value")))
        open_ = picked.where(~known).select(
            *key_cols, "total", "i", "high", "_place", F.col("_lo").alias("_from"), F.col("_hi").alias("_to")
        )
        if open_.isEmpty():
            break
        spans = open_.select(*key_cols, F.col("total").alias("_size"), "_from", "_to").distinct()
        inside = with_stats(long, spans, keys, "_size").where((x >= F.col("_from")) & (x <= F.col("_to")))
        share = (x - F.col("_from")) / (F.col("_to") - F.col("_from"))
        digit = F.least(F.floor(share * STEPS), F.lit(STEPS - 1).cast("long"))
        finer = counted(inside, ["_from", "_to"], digit).drop("_total")
        met = open_.join(finer, [*keys, "_from", "_to"]).where(
            (F.col("_place") >= F.col("_start")) & (F.col("_place") < F.col("_start") + F.col("_n"))
        )
        picked = stage(met.withColumn("_place", F.col("_place") - F.col("_start")).select(*picked.columns), "picked")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _bracketed(long: DataFrame, keys: Sequence[str], probs: Sequence[float], small: int, gathered: int) -> tuple[DataFrame, DataFrame]:
    """The values next to each wanted rank, ``(*keys, total, low_i, high_i)``, of the groups
    where a bracket finds them, and ``(*keys, total)`` of the others."""
    key_cols, x = [col(k) for k in keys], F.col("value")
    around = [min(1.0, max(0.0, p + side)) for p in probs for side in (-MARGIN, MARGIN)]
    sketch = stage(
        long.groupBy(*key_cols).agg(
            F.count(F.lit(1)).alias("total"), F.min(x).alias("_min"), F.max(x).alias("_max"),
            F.percentile_approx(x, around or [0.5], ACCURACY).alias("_at"),
        ),
        "quantile_summary",
    )
    few, total = F.col("total") <= small, F.col("total")
    ends = []
    for i, p in enumerate(probs):
        low = F.when(few | F.lit(p <= MARGIN), F.col("_min")).otherwise(F.col("_at")[2 * i])
        high = F.when(few | F.lit(p >= 1 - MARGIN), F.col("_max")).otherwise(F.col("_at")[2 * i + 1])
        ends += [low.alias(f"_lo{i}"), high.alias(f"_hi{i}")]
    # Twice the margin, and the summary's own error at both ends.
    narrow = few | (total * F.lit(2 * MARGIN + 2.0 / ACCURACY) <= gathered)
    brackets = sketch.where(narrow).select(*key_cols, "total", *ends)
    los, his = ([F.col(f"_{end}{i}") for i in range(len(probs))] for end in ("lo", "hi"))
    inside = reduce(lambda a, b: a | b, [(x >= lo) & (x <= hi) for lo, hi in zip(los, his)])
    passed = reduce(lambda a, b: a + b, [(x > hi).cast("int") for hi in his])
    # Values outside the brackets are counted together by the brackets they lie beyond; within
    # one of these counts they come before all values inside.
    counts = (
        with_stats(long, brackets, keys, "total")
        .groupBy(*key_cols, "total", passed.alias("_passed"), F.when(inside, x).alias("_x"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    order = Window.partitionBy(*[q(k) for k in keys]).orderBy("_passed", F.col("_x").asc_nulls_first())
    placed = counts.withColumn("_end", F.sum("_n").over(order))
    values = []
    for i, p in enumerate(probs):
        low = F.floor((total - 1) * F.lit(float(p)))
        for side, rank in (("low", low), ("high", F.least(low + 1, total - 1))):
            here = (F.col("_end") > rank) & (F.col("_end") - F.col("_n") <= rank)
            values.append(F.max(F.when(here, F.col("_x"))).alias(f"_{side}{i}"))
    found = stage(placed.groupBy(*key_cols, "total").agg(*values), "quantile_values")
    sure = F.lit(True)
    for i in range(len(probs)):
        sure = sure & F.col(f"_low{i}").isNotNull() & F.col(f"_high{i}").isNotNull()
    rest = found.where(~sure).select(*key_cols, "total").unionByName(sketch.where(~narrow).select(*key_cols, "total"))
    return found.where(sure), rest


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    small: int = SMALL,
    gathered: int = GATHERED,
    count: str | None = None,
) -> DataFrame:
    """Exact, linearly interpolated quantiles: one row per ``(*by, column)``.

    Rows with a null in ``by`` are left out, nulls and NaN are skipped. ``small`` and
    ``gathered`` bound what a task of the second pass sorts; the results do not depend on them.
    ``count`` names a further column for the number of values.
    """
    names = list(names or [f"p{round(p * 100, 6):g}" for p in probs])
    if not columns or not probs:
        return empty_table(df, "`column` string, " + ", ".join([*[f"{q(n)} double" for n in names], *([f"{q(count)} long"] if count else [])]), by)
    groups = [f"_g{i}" for i in range(len(by))]
    keys = [*groups, "column"]
    known = drop_null_keys(df, by).select(
        *[col(b).alias(g) for b, g in zip(by, groups)], *[as_double(df, c).alias(c) for c in columns]
    )
    long = melt_numeric(known, columns, groups)
    found, rest = _bracketed(long, keys, probs, small, gathered)
    if not rest.isEmpty():
        sides = [
            F.max(F.when((F.col("i") == i) & (F.col("high") == high), F.col("value"))).alias(f"_{side}{i}")
            for i in range(len(probs))
            for side, high in (("low", False), ("high", True))
        ]
        near = _select(with_stats(long, rest, keys, "total").drop("total"), keys, probs)
        more = near.groupBy(*[col(k) for k in keys]).agg(F.max("total").alias("total"), *sides)
        found = found.unionByName(more)

    def interpolate(i: int, p: float) -> Column:
        at = (F.col("total") - 1) * F.lit(float(p))
        share = at - F.floor(at)
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        return F.when((share == 0) | (low == high), low).otherwise(low + (high - low) * share)

    return found.select(
        *[F.col(g).alias(b) for b, g in zip(by, groups)], "column", *[interpolate(i, p).alias(n) for i, (p, n) in enumerate(zip(probs, names))],
        *([F.col("total").alias(count)] if count else []),
    )


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=[q(k) for k in keys]) if keys else df


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return quantiles(df, columns, [0.5], names=["median"])


def first_rows(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in key order (a bare limit picks any rows)."""
    return df.orderBy(*[col(k) for k in keys]).limit(n)


def top_rows(df: DataFrame, measure: Column, ties: Sequence[str], n: int) -> DataFrame:
    """Top ``n`` by a measure, descending, with a full tie-break."""
    return df.orderBy(measure.desc(), *[col(t) for t in ties]).limit(n)


def top_per_group(df: DataFrame, group: Sequence[str], measure: str, ties: Sequence[str], n: int) -> DataFrame:
    """Top ``n`` rows per group with their ``rank``."""
    order = Window.partitionBy(*[q(g) for g in group]).orderBy(
        col(measure).desc(), *[col(t) for t in ties]
    )
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
