"""Mixing of sources to target weights by exponential keys.

A document's key is an exponential draw divided by its quality weight; the smallest
keys are a weighted sample without replacement. Complete epochs of a source come
first; the rest of its budget is filled in the order of the keys, by running sums.
Keys of one source are cut into buckets, so no source is sorted by one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyloom.llm.common import columns_kept, id_back, id_of, text_of, word_count
from tallyloom.sources.tables import stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BUCKET_ROWS = 4000


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the md5 of the parts, the same in every run."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / 2.0**52


def numbered(df: DataFrame, by: str) -> DataFrame:
    """A column ``rank`` from 0 in the order of ``by``, nulls last, without one task
    that sorts all rows."""
    ranged = stage(
        df.repartitionByRange(F.col(by).asc_nulls_last())
        .sortWithinPartitions(F.col(by).asc_nulls_last())
        .withColumn("row", F.monotonically_increasing_id()),
        "ranged",
    ).withColumns({"slot": F.shiftright("row", 33), "row": F.col("row").bitwiseAND((1 << 33) - 1)})
    before = ranged.groupBy("slot").count().select(
        "slot", (F.sum("count").over(W.orderBy("slot")) - F.col("count")).alias("base")
    )
    return ranged.join(before, "slot").withColumn("rank", F.col("base") + F.col("row")).drop("slot", "row", "base")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, rows, target of each source; ``sizes`` has source and size.

    Sources in the order of their code points, null last, take the weights in turn.
    Budgets stop at ``most`` times the source; what is over goes to the others by
    weight, until none is above.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    held = stage(numbered(totals, "source").withColumn("weight", turn).drop("rank"), "sources")
    full = F.lit(most) * F.col("source_size")
    total = share * (held.agg(F.sum("source_size")).first()[0] or 0)
    level = -1.0
    while True:
        above = full <= F.lit(level) * F.col("weight")
        used, open_ = held.agg(
            F.sum(F.when(above, full).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))
        ).first()
        new = (total - used) / open_ if open_ else math.inf
        if new == level or not open_:
            break
        level = new
    target = full if math.isinf(new) else F.least(full, F.lit(level) * F.col("weight"))
    return held.select("source", "source_size", "rows", target.alias("target"))


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 42,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Words that a mix takes of every document.

    ``quality`` has doc_id and quality (positive weight, 1 where missing). Returns
    doc_id, size, source_size, target, taken, text_key, source, epochs (complete
    copies) and part (words of the fractional selection) of every row. The fractional
    selection ends inside the document that meets the target, so sources meet theirs to
    the word. Ties of the key go by id and text; rows equal in all take their turns.
    Sources without words have target 0. An empty table gives no rows.
    """
    sized = docs.select(
        id_of().alias("doc_id"), F.col("source").cast("string").alias("source"), text_of().alias("text")
    ).select("doc_id", "source", F.xxhash64("text").alias("text_key"), word_count(F.col("text")).alias("size"))
    if quality is not None:
        one = quality.filter("doc_id IS NOT NULL AND quality > 0").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
        sized = sized.join(one, "doc_id", "left")
    else:
        sized = sized.withColumn("quality", F.lit(None).cast("double"))
    draw = -F.log(uniform(F.col("doc_id").cast("string"), F.lit(str(seed))))
    rows = stage(
        sized.withColumn("quality", F.coalesce("quality", F.lit(1.0))).withColumn("key", draw / F.col("quality")), "sized"
    )
    targets = stage(source_targets(rows, weights, share, most), "targets")
    # Hot sources meet their one row of targets by salt.
    salts = 64
    spread = targets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = (
        rows.withColumn("name", named("source"))
        .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
        .join(spread.withColumn("name", named("source")).drop("source"), ["name", "salt"])
    )
    buckets = F.ceil(F.col("rows") / bucket_rows)
    met = stage(
        met.withColumns(
            {
                "epochs": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
                "bucket": F.least(buckets - 1, F.floor(buckets * (1 - F.exp(-F.col("key"))))).cast("long"),
            }
        )
        .withColumn("budget", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
        .drop("salt", "rows"),
        "met",
    )
    before = (
        met.groupBy("name", "bucket")
        .agg(F.sum("size").alias("words"))
        .select("name", "bucket", (F.sum("words").over(W.partitionBy("name").orderBy("bucket")) - F.col("words")).alias("before"))
    )
    inside = F.sum("size").over(
        W.partitionBy("name", "bucket").orderBy("key", "doc_id", "text_key").rowsBetween(W.unboundedPreceding, 0)
    )
    left = F.col("budget") - (F.col("before") + F.col("inside") - F.col("size"))
    return (
        met.withColumn("inside", inside)
        .join(before, ["name", "bucket"])
        .withColumn("part", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left)))
        .select(
            id_back("doc_id").alias("doc_id"), "size", "source_size", "target",
            (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"), "text_key", "source", "epochs", "part",
        )
    )


def named(source: str) -> Column:
    """The source as a key that null has, too."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def label_quality(labels: DataFrame) -> DataFrame:
    """Weight 2 for documents labelled good, 0.5 for bad ones."""
    return labels.filter("quality IS NOT NULL").select(
        "doc_id", F.when(F.col("quality") == 1, 2.0).otherwise(0.5).alias("quality")
    )


@columns_kept
def mixed_documents(docs: DataFrame, quality: DataFrame | None = None, **how) -> DataFrame:
    """The documents as often as the mix takes them, all columns as they are.

    A document is returned once for every complete epoch, and once more if at least
    half of it lies inside the fractional selection; texts are not cut. Rows that are
    equal in id and text are taken alike, each as often as the mean of their shares.
    """
    drawn = (
        mix(docs, quality, **how)
        .withColumn("copies", F.col("epochs") + ((F.col("part") > 0) & (2 * F.col("part") >= F.col("size"))).cast("long"))
        .groupBy(F.coalesce("doc_id", F.lit(-(2**63))).alias("__id"), F.col("text_key").alias("__key"), named("source").alias("__source"))
        .agg(F.round(F.avg("copies")).cast("int").alias("__copies"))
        .filter("__copies > 0")
    )
    keyed = docs.withColumns(
        {
            "__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))),
            "__key": F.xxhash64(F.coalesce(F.col("text"), F.lit(""))),
            "__source": F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")),
        }
    )
    return (
        keyed.join(drawn, ["__id", "__key", "__source"])
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .drop("__id", "__key", "__source", "__copies", "__copy")
    )
