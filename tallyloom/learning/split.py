"""Exact stratified split by the order of a row hash."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.learning.features import class_table
from tallyloom.operators.copies import split_repeated
from tallyloom.operators.rank import row_numbers, with_stats
from tallyloom.sources.tables import stage
from tallyloom.spec import col, require_columns

COPIES_AT_ONCE = 1_000
_STEP_BITS = 12


def class_quotas(classes: DataFrame, test_size: float) -> DataFrame:
    """``(label, n, n_test)`` of a table of classes: training rows are shared out by
    largest remainder, ties in the order of the labels."""
    total, smallest, number = classes.agg(F.sum("n"), F.min("n"), F.count(F.lit(1))).first()
    n_test = math.ceil(test_size * (total or 0))
    n_train = (total or 0) - n_test
    if not number or smallest < 2 or min(n_test, n_train) < number:
        raise ValueError("every class needs two rows and a place on both sides of the split")
    product = F.col("n").cast("decimal(18,0)") * F.lit(n_train).cast("decimal(18,0)")
    shares = classes.withColumns(
        {"_rest": (product % F.lit(total).cast("decimal(18,0)")).cast("long"), "_all": product}
    ).withColumn("_whole", ((F.col("_all") - F.col("_rest")) / F.lit(total).cast("decimal(18,0)")).cast("long"))
    left = n_train - shares.agg(F.sum("_whole")).first()[0]
    ranked = row_numbers(shares.drop("_all"), [F.col("_rest").desc(), F.col("label").asc()], "_rank")
    train = F.col("_whole") + F.when(F.col("_rank") < left, 1).otherwise(0)
    return ranked.select("label", "n", (F.col("n") - train).alias("n_test"))


def numbered_copies(df: DataFrame) -> DataFrame:
    """All rows with the number of each among its copies (``_copy``), whatever the order or
    the partitions of the table. Rows that may have copies are counted, and dealt out again in
    chunks; the others are not shuffled."""
    once, repeated = split_repeated(df)
    parts = [] if once is None else [once.withColumn("_copy", F.lit(0).cast("long"))]
    parts += [] if repeated is None else [_numbered(repeated)]
    return reduce(DataFrame.unionByName, parts)


def _numbered(df: DataFrame) -> DataFrame:
    counted = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    chunks = counted.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES_AT_ONCE))))
    # By number: rows are few before they are dealt out, and Spark would join partitions so small.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartition(parts, F.xxhash64(*[col(c) for c in df.columns], F.col("_chunk")))
    first = F.col("_chunk") * COPIES_AT_ONCE
    last = F.least(first + COPIES_AT_ONCE, F.col("_n")) - 1
    return dealt.withColumn("_copy", F.explode(F.sequence(first, last))).select(*[col(c) for c in df.columns], "_copy")


def stratified_split(
    df: DataFrame,
    label: str,
    test_size: float = 0.2,
    seed: int = 42,
    key: Sequence[str] | None = None,
    order: Column | None = None,
) -> DataFrame:
    """Add ``is_test``: per class, the rows with the smallest hashes, in exact numbers.

    ``key`` names columns that identify a row. Without it copies of a row are numbered, as
    they have to part, and the table is written to the shared folder. Either way the split
    does not depend on how the table is partitioned. The cut is found by counting hash
    prefixes, so rows are not sorted; ``order`` replaces the hash with a long column of the
    caller. A column ``is_test`` of the table is replaced.
    """
    require_columns(df, [label, *(key or [])])
    quotas = stage(class_quotas(class_table(df, label), test_size), "quotas")
    # Under names of their own, so that no column of the table meets one of the split.
    inner = {c: f"c{i}" for i, c in enumerate(df.columns)}
    given = [order.alias("_order")] if order is not None else []
    rows = df.select(*[col(c).alias(n) for c, n in inner.items()], *given)
    if key is None:
        numbered = stage(numbered_copies(rows), "numbered")
        identity = [F.col(c) for c in numbered.columns if c != "_order"]
    else:
        numbered, identity = rows, [F.col(inner[c]) for c in key]
    first = F.col("_order") if order is not None else F.xxhash64(F.lit(seed), *identity)
    hashed = numbered.withColumns(
        {"_label": F.col(inner[label]).cast("string"), "_h1": first, "_h2": F.xxhash64(F.lit(seed + 1), *identity)}
    )
    cuts = _cuts(hashed.select("_label", "_h1", "_h2"), quotas)
    below = (F.col("_h1") < F.col("_c1")) | ((F.col("_h1") == F.col("_c1")) & (F.col("_h2") <= F.col("_c2")))
    marked = with_stats(hashed, cuts, ["_label"], "_size").withColumn("is_test", F.coalesce(below, F.lit(False)))
    return marked.select(*[F.col(n).alias(c) for c, n in inner.items() if c != "is_test"], "is_test")


def _prefix(hash_: str, bits: int) -> Column:
    """Leading bits of the hash, in the order of its signed value."""
    if not bits:
        return F.lit(0).cast("long")
    unsigned = F.col(hash_).bitwiseXOR(F.lit(-(1 << 63)))
    # All bits stay signed, so that they compare as the hash does.
    return F.col(hash_) if bits == 64 else F.shiftrightunsigned(unsigned, 64 - bits)


def _cuts(pool: DataFrame, quotas: DataFrame) -> DataFrame:
    """Per class the largest hash pair that still belongs to the test rows; null where
    none does, and its rows: ``(_label, _size, _c1, _c2)``."""
    zero = F.lit(0).cast("long")
    names = F.col("label").alias("_label"), F.col("n").alias("_size")
    todo = quotas.where("n_test > 0").select(*names, zero.alias("_p1"), zero.alias("_p2"), F.col("n_test").alias("_need"))
    none = F.lit(None).cast("long")
    found = quotas.where("n_test = 0").select(*names, none.alias("_c1"), none.alias("_c2"))
    widths = [*range(_STEP_BITS, 64, _STEP_BITS), 64]
    steps = [(b, 0) for b in widths] + [(64, b) for b in widths]
    held = (0, 0)
    for bits in steps:
        inside = with_stats(pool, todo, ["_label"], "_size").where(
            (_prefix("_h1", held[0]) == F.col("_p1")) & (_prefix("_h2", held[1]) == F.col("_p2"))
        )
        # Smallest and largest of each hash: those of a pair would have the rows sorted.
        ends = [end(h).alias(f"_{name}{h[-1]}") for h in ("_h1", "_h2") for name, end in (("lo", F.min), ("hi", F.max))]
        counts = inside.groupBy(
            "_label", "_size", "_need", _prefix("_h1", bits[0]).alias("_q1"), _prefix("_h2", bits[1]).alias("_q2")
        ).agg(F.count(F.lit(1)).alias("_n"), *ends)
        upto = F.sum("_n").over(Window.partitionBy("_label").orderBy("_q1", "_q2"))  # at most 4096 prefixes
        hit = stage(
            counts.withColumn("_upto", upto)
            .where("_need <= _upto AND _need > _upto - _n")
            .withColumn("_left", F.col("_need") - F.col("_upto") + F.col("_n")),
            "cuts",
        )
        done = F.col("_left") == F.col("_n")
        # While the second hash does not part rows, all rows of the largest first hash are in.
        second = F.col("_hi2") if bits[1] else F.lit((1 << 63) - 1)
        found = found.unionByName(hit.where(done).select("_label", "_size", F.col("_hi1").alias("_c1"), second.alias("_c2")))
        todo = hit.where(~done).select("_label", "_size", F.col("_q1").alias("_p1"), F.col("_q2").alias("_p2"), F.col("_left").alias("_need"))
        held = bits
        one = F.col("_lo1").eqNullSafe(F.col("_hi1")) & F.col("_lo2").eqNullSafe(F.col("_hi2"))
        open_, stuck = hit.agg(F.count_if(~done), F.count_if(~done & one)).first()
        if stuck:
            raise ValueError("the split key does not identify rows: rows at the cut share one hash")
        if not open_:
            break
    return stage(found, "cuts")
