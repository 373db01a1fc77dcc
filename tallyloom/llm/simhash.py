"""Near copies by SimHash: fingerprints of word shingles, linked at few differing bits.

Two fingerprints that differ in at most 3 bits agree in one of their four 16-bit
blocks, so fingerprints are dealt out by block and value. Values that very many
fingerprints share are dealt out once more by a 12-bit block of the other 48 bits.
Inside such a group the fingerprints are sorted by Gray rank, which puts those that
differ little side by side, and a tree is built over them: a node keeps the bits in
which all below it agree (a mask and their pattern). Pairs of nodes are compared from
the root down; a pair goes when the bits both keep already differ too much, or when
all below it is known to be linked. A group returns the edges of a forest and not its
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import batch, byte_list, columns_kept, components, id_back, signed, texts
from tallyloom.sources.tables import stage

SHINGLE = 3
DIFFER = 3
SEED = 42
CROWDED = 1_000_000
FAN = 16
PAIRS = 1 << 20
SLICE = 1 << 17


def shingle_hashes(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle; of the whole word sequence if it is shorter."""
    words = text.lower().split()
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(line, SEED)] if words else [], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    begin = (end - size)[: len(words) - width + 1]
    return np.array(
        [digest(line[a:b], SEED) for a, b in zip(begin.tolist(), end[width - 1 :].tolist())], np.uint64
    )


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; zero without any."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLICE):
        bits = np.unpackbits(hashes[at : at + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, print (the 64 bits as a signed number) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("print", pa.int64())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows:
            found = [fingerprint(shingle_hashes(t)) for t in byte_list(r.column(2))]
            yield batch(schema, doc_id=r.column(0), text_key=r.column(1), print=signed(np.array(found, np.uint64)))

    return texts(docs).mapInArrow(run, "doc_id long, text_key long, print long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    for step in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(step))
    return x


class GrayTree:
    """Trees over the Gray-ordered fingerprints of several groups."""

    def __init__(self, groups: np.ndarray, prints: np.ndarray) -> None:
        order = np.lexsort((gray_rank(prints), groups))
        self.order = order
        group, pattern = groups[order], prints[order]
        mask = np.full(len(pattern), ~np.uint64(0))
        leaf = np.arange(len(pattern) + 1)
        self.levels = [(mask, pattern, None, leaf)]
        while True:
            new = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            if len(new) == len(group):
                break
            rank = np.arange(len(group)) - np.repeat(new, np.diff(np.append(new, len(group))))
            cut = np.flatnonzero(rank % FAN == 0)
            every, some = np.bitwise_and.reduceat(pattern, cut), np.bitwise_or.reduceat(pattern, cut)
            mask = np.bitwise_and.reduceat(mask, cut) & ~(every ^ some)
            pattern, group = every & mask, group[cut]
            child = np.append(cut, len(rank))
            leaf = leaf[child]
            self.levels.append((mask, pattern, child, leaf))
        self.root = np.arange(len(prints))

    def link(self, differ: int) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs (in the order given) of a forest over the linked fingerprints."""
        top = len(self.levels) - 1
        if top:
            everything = np.arange(len(self.levels[top][0]))
            todo = [(top, everything, everything)]
        else:
            todo = []
        while todo:
            level, a, b = todo.pop()
            if len(a) > PAIRS // FAN:
                half = len(a) // 2
                todo += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
                continue
            low, high = self._labels(level)
            apart = (low[a] != high[a]) | (low[b] != high[b]) | (low[a] != low[b])
            a, b = self._children(level, a[apart], b[apart], differ)
            if not len(a):
                continue
            if level == 1:
                self._unite(a, b)
                continue
            own = a == b  # first, so that the others may turn out to be linked already
            todo += [(level - 1, a[~own], b[~own]), (level - 1, a[own], b[own])]
        moved = np.flatnonzero(self.root != np.arange(len(self.root)))
        return self.order[moved], self.order[self.root[moved]]

    def _labels(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        cut = self.levels[level][3][:-1]
        return np.minimum.reduceat(self.root, cut), np.maximum.reduceat(self.root, cut)

    def _children(self, level: int, a: np.ndarray, b: np.ndarray, differ: int):
        child = self.levels[level][2]
        mask, pattern = self.levels[level - 1][:2]
        wide, high = child[b + 1] - child[b], child[a + 1] - child[a]
        total = wide * high
        pair = np.repeat(np.arange(len(a)), total)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(total) - total, total)
        c, d = child[a][pair] + k // wide[pair], child[b][pair] + k % wide[pair]
        good = (a[pair] != b[pair]) | (c < d if level == 1 else c <= d)
        c, d = c[good], d[good]
        near = np.bitwise_count((pattern[c] ^ pattern[d]) & mask[c] & mask[d]) <= differ
        return c[near], d[near]

    def _unite(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up


def print_links(prints: DataFrame, differ: int = DIFFER) -> DataFrame:
    """Edges a, b that join the nodes of fingerprints with at most ``differ`` (3 or
    fewer) differing bits. ``prints`` has print and node, each print once."""
    if not 0 <= differ <= 3:
        raise ValueError("the blocks find up to 3 differing bits")
    keyed = prints.select(
        "print", "node", F.explode(F.expr("transform(sequence(0, 3), j -> struct(j, (shiftrightunsigned(print, 16 * j) & 65535) + 65536 * j AS key))")).alias("at")
    ).select("print", "node", "at.j", "at.key")
    crowded = keyed.groupBy("key").count().filter(F.col("count") > CROWDED).select("key", F.lit(True).alias("crowded"))
    rest = "((shiftrightunsigned(print, 16 * (j + 1)) | shiftleft(print, 48 - 16 * j)) & 281474976710655)"
    dealt = keyed.join(crowded, "key", "left").select(
        "key", "print", "node",
        F.explode(F.expr(f"IF(crowded, transform(sequence(0, 3), i -> (shiftrightunsigned({rest}, 12 * i) & 4095) + 4096 * i), array(-1L))")).alias("sub"),
    )

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in whole_groups(rows):
            key, sub, bits, node = columns
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])])
            group = np.cumsum(new)
            many = np.bincount(group)[group] > 1
            if many.any():
                node = node[many]
                a, b = GrayTree(group[many], bits[many].view(np.uint64)).link(differ)
                yield batch(schema, a=node[a], b=node[b])

    return (
        dealt.select("key", "sub", "print", "node")
        .repartition("key", "sub")
        .sortWithinPartitions("key", "sub")
        .mapInArrow(run, "a long, b long")
        .distinct()
    )


def whole_groups(rows: Iterator[pa.RecordBatch], least: int = 1 << 16) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, cut only where the first two columns change."""
    held: list[np.ndarray] | None = None
    for r in rows:
        new = [c.to_numpy() for c in r.columns]
        held = [np.concatenate(x) for x in zip(held, new)] if held else new
        if len(held[0]) >= least:
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            cut = int(np.argmax(last))
            if cut:
                yield [x[:cut] for x in held]
                held = [x[cut:] for x in held]
    if held and len(held[0]):
        yield held


def grouped(docs: DataFrame, differ: int = DIFFER) -> DataFrame:
    """doc_id, text_key, print, component of every row, written to the shared folder."""
    rows = stage(fingerprints(docs), "fingerprints")
    prints = stage(rows.groupBy("print").agg(F.min("doc_id").alias("node"), F.max("doc_id").alias("other")), "prints")
    links = print_links(prints.select("print", "node"), differ)
    # An id that stands for one fingerprint and has another one, too, links both.
    twice = rows.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).filter("low < high")
    shared = (
        rows.join(twice.select("doc_id"), "doc_id", "left_semi")
        .join(prints.select("print", "node"), "print")
        .filter("node <> doc_id")
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    )
    found = components(links.unionByName(shared), "components")
    label = prints.join(found, "node", "left").select("print", F.coalesce("component", "node").alias("component"))
    return rows.join(stage(label, "labels"), "print")


def simhash_groups(docs: DataFrame, differ: int = DIFFER) -> DataFrame:
    """Fingerprint of each text and the smallest doc_id its near copies lead to.

    Returns doc_id, fingerprint (16 hex digits), component_id. Texts without words,
    null ones too, have fingerprint zero and are linked like any other. Rows that share
    an id are one document: what either is linked to is linked to both. Copies are
    compared once. An empty table gives no rows.
    """
    return grouped(docs, differ).select(
        id_back("doc_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        id_back("component").alias("component_id"),
    )


@columns_kept
def one_of_each(docs: DataFrame, differ: int = DIFFER) -> DataFrame:
    """The documents without near copies: of each group the row with the smallest id
    stays, of rows that share this id one. All columns are returned as they are."""
    kept = (
        grouped(docs, differ)
        .filter("doc_id = component")
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.min("text_key").alias("__key"))
    )
    keyed = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), "__key": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    return keyed.join(stage(kept, "kept"), ["__id", "__key"]).dropDuplicates(["__id", "__key"]).drop("__id", "__key")
