"""Documents in the order of their ids, dealt to ordered parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import bounded_batches, id_of, parts_by_order, text_of

PART_ROWS = 4096


def in_order(docs: DataFrame, part_rows: int = PART_ROWS, with_next: bool = False) -> DataFrame:
    """part, halo, doc_id, text; every Spark partition is sorted by these.

    With ``with_next`` the first documents of each part are in the part before it, too,
    marked as ``halo``, and those of the first part in the last one: the document that
    follows a part is then the first of its halo.
    """
    bounded_batches(docs.sparkSession)
    read = docs.select(id_of().alias("doc_id"), text_of().alias("text"))
    keyed, cuts, low = parts_by_order(read, "doc_id", part_rows)
    at = [F.struct(F.col("part").alias("part"), F.lit(False).alias("halo"))]
    if with_next:
        before = F.struct(
            F.when(F.col("doc_id") == F.lit(low), F.lit(len(cuts))).otherwise(F.col("part") - 1).alias("part"),
            F.lit(True).alias("halo"),
        )
        first = F.col("doc_id").isin([x for x in (low, *cuts) if x is not None])
        dealt = F.explode(F.when(first, F.array(at[0], before)).otherwise(F.array(at[0])))
    else:
        dealt = F.explode(F.array(at[0]))
    return (
        keyed.select(dealt.alias("at"), "doc_id", "text")
        .select("at.part", "at.halo", "doc_id", "text")
        # More partitions than parts, so that few hold two.
        .repartition(4 * (len(cuts) + 1), "part")
        .sortWithinPartitions("part", "halo", "doc_id", "text")
    )
