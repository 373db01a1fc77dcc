"""What several operators share: words, ids, batches, ordered parts and components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.tables import stage

WORD = r"[^\x20\x09-\x0D]+"
# Stands for a null id inside the operators: smaller than any other.
NO_ID = -(2**63)
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that workers get by bytes, as texts may be long."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(2**31 - 1)).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def text_of(name: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_of(name: str = "doc_id") -> Column:
    """The id with a value in place of null."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def id_back(name: str) -> Column:
    """The id as it was."""
    return F.nullif(F.col(name), F.lit(NO_ID))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, the text: what the operators read of documents."""
    bounded_batches(docs.sparkSession)
    return docs.select(id_of().alias("doc_id"), text_of().alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_key"), "text"
    )


def byte_list(column: pa.Array) -> list[bytes]:
    """The strings of an Arrow column as UTF-8."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )


def parts_by_order(df: DataFrame, key: str, rows_per_part: int) -> tuple[DataFrame, list[int], int | None]:
    """Number ordered parts of about ``rows_per_part`` rows in the column ``part``; also
    the keys at which parts begin, but for the first, and the smallest key.

    Only the key column is read to find the cuts, of which there are at most
    ``MOST_PARTS``, whatever the table's size. Each part has rows.
    """
    rows, low = df.agg(F.count("*"), F.min(key)).first()
    parts = int(min(MOST_PARTS, max(1, -(-rows // rows_per_part))))
    cuts: list[int] = []
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        found = df.agg(F.percentile_approx(key, at, 100 * parts).alias("q")).first()["q"]
        cuts = sorted(set(found) - {low})
    return df.withColumn("part", part_of(F.col(key), cuts)), cuts, low


MOST_PARTS = 10_000


def part_of(key: Column, cuts: list[int]) -> Column:
    """How many cuts lie at or below the key, found by halving."""
    if not cuts:
        return F.lit(0).cast("int")

    @F.pandas_udf("int")
    def place(values):
        import pandas as pd

        return pd.Series(np.searchsorted(np.array(cuts), values.to_numpy(), side="right").astype("int32"))

    return place(key)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes joined by the edges (a, b) that are not the smallest of their component,
    and the smallest one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(nodes))
    left, right = at[: len(a)], at[len(a) :]
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        np.minimum.at(root, before[left], low)
        np.minimum.at(root, before[right], low)
        root = root[root]
        if (root == before).all():
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


SALTS = 64


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Smallest reachable node (``component``) of every ``node`` that has an edge
    (columns a and b, long, no nulls).

    Alternates the two star operations that hang each node's neighbours on its
    smallest neighbour, until nothing moves. Nodes with many edges are split by salt,
    and each round is written to the shared folder.
    """
    held = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), label
    )
    state = None
    while True:
        both = held.unionByName(held.select(F.col("b").alias("a"), F.col("a").alias("b")))
        held = stage(_hang(_hang(both, larger=True), larger=False), label)
        now = held.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    nodes = held.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())


def _hang(edges: DataFrame, larger: bool) -> DataFrame:
    """Large star (edges in both directions given) or small star (larger end first)."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    part = salted.groupBy("a", "salt").agg(F.min("b").alias("low"))
    least = part.groupBy("a").agg(F.least(F.min("low"), F.col("a")).alias("low"))
    spread = part.select("a", "salt").join(least, "a")
    met = salted.join(spread, ["a", "salt"])
    if larger:
        out = met.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select("a", F.col("low").alias("b"))
        )
    return out.filter("a > b").distinct()


def columns_kept(function):
    """For a function of documents that returns their columns: those that begin with two
    underscores, as its own do, go by other names inside and come back as they were."""

    @wraps(function)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        hidden = [c for c in docs.columns if c.startswith("__")]
        if not hidden:
            return function(docs, *args, **options)
        free = "user"
        while any(c.startswith(free) for c in docs.columns):
            free += "_"
        inner = {c: f"{free}{i}" for i, c in enumerate(hidden)}
        given = docs.select(*[F.col(f"`{c}`").alias(inner.get(c, c)) for c in docs.columns])
        out = function(given, *args, **options)
        return out.select(*[F.col(f"`{inner.get(c, c)}`").alias(c) for c in docs.columns])

    return run


def batches_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (r for r in rows if r.num_rows)
