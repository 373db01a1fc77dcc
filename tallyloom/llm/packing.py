"""Best-fit packing of documents into bins, under conflicts.

Pieces of documents are dealt to shards by hash, so that any source and any group of
copies spreads over all of them, and each shard is packed by one task, largest pieces
first. Bins are kept in the order of what is left in them, with bitmaps of the sources
and groups of copies they hold. The search starts at the tightest bin that has room
and goes on to the next larger ones until one has no conflict.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import batch, id_back, id_of, text_of, word_count
from tallyloom.sources.tables import stage

CAPACITY = 4096
PER_SOURCE = 4
SHARD_ROWS = 4000


def best_fit(sizes: list[int], sources: list[int], groups: list[int], capacity: int, per_source: int) -> list[int]:
    """Bin number of each piece; pieces are taken in the order given.

    A bin takes at most one piece of a group (numbers below 0: none) and at most
    ``per_source`` pieces of a source. Of the bins with room and without conflict the
    one with the least room is taken, of equals the oldest.
    """
    order: list[tuple[int, int]] = []  # what is left, number
    held: list[list[int]] = []  # bitmap of groups, then of sources met once, twice, ...
    out = []
    for size, source, group in zip(sizes, sources, groups):
        group_bit, source_bit = 1 << group if group >= 0 else 0, 1 << source
        at = bisect_left(order, (size, -1))
        while at < len(order):
            bits = held[order[at][1]]
            if not bits[0] & group_bit and not bits[per_source] & source_bit:
                break
            at += 1
        if at < len(order):
            left, number = order.pop(at)
        else:
            left, number = capacity, len(held)
            held.append([0] * (per_source + 1))
        bits = held[number]
        bits[0] |= group_bit
        for level in range(1, per_source + 1):
            if not bits[level] & source_bit:
                bits[level] |= source_bit
                break
        if left > size:
            insort(order, (left - size, number))
        out.append(number)
    return out


def _with_clusters(sized: DataFrame, clusters: DataFrame) -> DataFrame:
    """The documents and what marks their copies: the cluster of a text, shared by all rows of
    the text, or else the text. Ids and texts meet in small rows, without the texts."""
    given = clusters.select(id_of().alias("doc_id"), F.xxhash64(F.lit("cluster"), "cluster").alias("copies"), F.col("cluster").isNull().alias("none"))
    marked = sized.join(given.where("NOT none").drop("none"), "doc_id", "left")
    return marked.withColumn("copies", F.coalesce("copies", "text_key"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_rows: int = SHARD_ROWS, clusters: DataFrame | None = None) -> DataFrame:
    """Pieces of all documents and the bins they go to.

    Returns doc_id, piece (from 0), first_word, n_words, bin (string), place (order in
    the bin), source. A text longer than ``capacity`` words is cut into full pieces and
    a rest; full pieces fill bins of their own. No bin holds more than ``capacity``
    words, two texts of equal content, or more than ``per_source`` pieces of a source
    (null is a source of its own). ``clusters`` (doc_id, cluster), one row for each id, widens
    equal content to groups of copies of any kind: no bin then holds two documents of a cluster
    either; an id that is missing there, or whose cluster is null, goes by its text. Texts without words get one piece of no words and no
    bin. Equal rows go to different bins. An empty table gives no rows.
    """
    sized = docs.select(
        id_of().alias("doc_id"), F.col("source").cast("string").alias("source"), text_of().alias("text")
    ).select("doc_id", "source", F.xxhash64("text").alias("text_key"), word_count(F.col("text")).alias("size"))
    sized = sized.withColumn("copies", F.col("text_key")) if clusters is None else _with_clusters(sized, clusters)
    last = F.greatest(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / capacity))
    pieces = stage(
        sized.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("first_word", F.col("piece") * capacity)
        .withColumn("n_words", F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("first_word"))),
        "pieces",
    )
    shards = max(1, -(-pieces.count() // shard_rows))
    shard = F.pmod(F.xxhash64("doc_id", "text_key", "piece"), F.lit(shards))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("bin", pa.string()), ("place", pa.int32()), ("source", pa.string())]
    )

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = pa.Table.from_batches(list(rows)).sort_by(
            [("n_words", "descending"), ("doc_id", "ascending"), ("text_key", "ascending"), ("piece", "ascending"), ("source", "ascending")]
        )
        size = shown.column("n_words").to_numpy()
        names = shown.column("source").to_pylist()
        number = {s: i for i, s in enumerate(dict.fromkeys(names))}
        # Only copies that occur more than once in the shard can be in conflict.
        _, group, times = np.unique(shown.column("copies").to_numpy(), return_inverse=True, return_counts=True)
        groups = np.where(times[group] > 1, (np.cumsum(times > 1) - 1)[group], -1)
        some = int((size > 0).sum())  # pieces without words come last
        bins = np.array(best_fit(size[:some].tolist(), [number[s] for s in names[:some]], groups[:some].tolist(), capacity, per_source), np.int64)
        by_bin = np.argsort(bins, kind="stable")
        place = np.empty(some, np.int64)
        place[by_bin] = np.arange(some) - np.searchsorted(bins[by_bin], bins[by_bin])
        shard, none = shown.column("shard")[0].as_py(), [None] * (len(size) - some)
        yield batch(
            schema, doc_id=shown.column("doc_id").combine_chunks(), piece=shown.column("piece").combine_chunks(),
            first_word=shown.column("first_word").combine_chunks(), n_words=size,
            bin=[f"{shard}-{b}" for b in bins.tolist()] + none, place=place.tolist() + none, source=names,
        )

    return (
        pieces.withColumn("shard", shard)
        .select("shard", "doc_id", "text_key", "copies", "piece", "first_word", "n_words", "source")
        .groupBy("shard")
        .applyInArrow(lambda t: pa.Table.from_batches(list(run(t.to_batches()))), "doc_id long, piece long, first_word long, n_words long, bin string, place int, source string")
        .withColumn("doc_id", id_back("doc_id"))
    )
