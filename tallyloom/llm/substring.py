"""Removal of passages that repeat across documents: seed and extend over words.

Seeds are winnowed anchors: of the k-word sequences of every window of ``length``
words the one with the smallest hash is its anchor (the last one of equals), so equal
windows have equal anchors at equal places. An anchor's span is the stretch around it
that its windows cover, to the left and to the right. Anchors that occur in one
document only are dropped. Of the rest, documents are joined on anchor and span: all
but the smallest id of a span repeat it whole. Anchors that have several spans are
extended word by word to both sides: the windows of the smallest id of each span are
compared by hash, whatever the spans around them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import batch, byte_list, columns_kept, id_back, mixed, signed, texts
from tallyloom.sources.tables import stage

LENGTH = 50
ANCHOR = 16

BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class WordHashes(dict):
    """Hash of a word, remembered for the words met so far."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


class Powers:
    """Powers of an odd base modulo 2**64, and of its inverse."""

    def __init__(self, base: np.uint64) -> None:
        inverse = pow(int(base), -1, 1 << 64)
        self.bases = (base, np.uint64(inverse))
        self.held = tuple(np.ones(1, np.uint64) for _ in self.bases)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.held[0]) < n:
            size = max(n, 2 * len(self.held[0]))
            grown = []
            for b in self.bases:
                x = np.full(size, b)
                x[0] = 1
                grown.append(np.multiply.accumulate(x))
            self.held = tuple(grown)
        return self.held[0][:n], self.held[1][:n]


def sums_of(hashes: np.ndarray, powers: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers, out=sums[1:])
    return sums


def last_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value of every ``width`` neighbours, of equals the last."""
    at, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = at[:-step], at[step:]
        at = np.where(values[left] < values[right], left, right)
        size += step
    return at


class Extender:
    """Anchors, spans and windows of the word sequences of a batch of documents."""

    def __init__(self, length: int, anchor: int) -> None:
        self.length, self.k = length, anchor
        self.hashes = WordHashes()
        self.powers = [Powers(b) for b in BASES]

    def load(self, words: list[list[bytes]]) -> None:
        get = self.hashes.__getitem__
        self.counts = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        h = np.concatenate(
            [np.fromiter(map(get, w), np.uint64, len(w)) for w in words] or [np.empty(0, np.uint64)]
        )
        self.n = len(h)
        self.sums = [sums_of(h, p.upto(self.n)[0]) for p in self.powers]

    def of(self, way: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the words from begin to end, wherever they stand."""
        inverse = self.powers[way].upto(self.n + 1)[1]
        return mixed((self.sums[way][end] - self.sums[way][begin]) * inverse[begin])

    def spans(self):
        """Document, first and last window start, anchor and span hash of each anchor."""
        length, k = self.length, self.k
        if self.n < length:
            return [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)] * 2
        places = np.arange(self.n - k + 1)
        grams = self.of(0, places, places + k)
        anchor = last_smallest(grams, length - k + 1)
        doc = np.repeat(np.arange(len(self.counts)), self.counts)
        starts = np.flatnonzero(doc[: self.n - length + 1] == doc[length - 1 :])
        if not len(starts):
            return [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)] * 2
        own = anchor[starts]
        new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        first, last, own = starts[new], starts[np.append(new[1:], len(starts)) - 1], own[new]
        shape = ((last - first) * length + (own - first)).astype(np.uint64)
        span = mixed(self.of(1, first, last + length) + shape)
        base = self.starts[doc[first]]
        return doc[first], first - base, last - base, grams[own], span


def seeds(length: int, anchor: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.int64()), ("anchor", pa.int64()), ("span", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]
    )

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extender = Extender(length, anchor)
        for r in rows:
            ids, keys = r.column(0).to_numpy(), r.column(1).to_numpy()
            extender.load([t.split() for t in byte_list(r.column(2))])
            doc, first, last, gram, span = extender.spans()
            yield batch(
                schema, doc_id=ids[doc], text_key=keys[doc], anchor=signed(gram), span=signed(span),
                first=first.astype(np.int32), last=last.astype(np.int32),
            )

    return run


def windows(length: int, anchor: int):
    """Hashes of the windows of the given spans."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.int64()), ("anchor", pa.int64()), ("window", pa.int64()), ("place", pa.int32())]
    )

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extender = Extender(length, anchor)
        for r in rows:
            todo = [i for i, x in enumerate(r.column(3).is_valid().to_pylist()) if x]
            if not todo:
                continue
            r = r.take(pa.array(todo))
            extender.load([t.split() for t in byte_list(r.column(2))])
            spans = r.column(3)
            doc = np.repeat(np.arange(len(todo)), spans.value_lengths().to_numpy())
            flat = spans.flatten()
            first, last, gram = (flat.field(i).to_numpy() for i in range(3))
            sizes = (last - first + 1).astype(np.int64)
            which = np.repeat(np.arange(len(sizes)), sizes)
            place = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            begin = extender.starts[doc[which]] + place
            found = extender.of(1, begin, begin + length)
            yield batch(
                schema, doc_id=r.column(0).to_numpy()[doc[which]], text_key=r.column(1).to_numpy()[doc[which]],
                anchor=gram[which], window=signed(found), place=place.astype(np.int32),
            )

    return run


def kept_words(words: list, ranges: list[tuple[int, int]], length: int) -> np.ndarray:
    """True for the words that no window of the ranges (first, last start) covers."""
    edge = np.zeros(len(words) + 1, np.int32)
    for first, last in ranges:
        edge[first] += 1
        edge[last + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def repeated_ranges(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """Window starts (first to last) of each text that also begin in a document with a
    smaller id: doc_id, text_key, first, last.

    Texts of fewer than ``length`` words have none. Windows that repeat only inside one
    document, or among rows of one id, are not reported.
    """
    read = texts(docs)
    seed = stage(
        read.mapInArrow(seeds(length, anchor), "doc_id long, text_key long, anchor long, span long, first int, last int"),
        "seeds",
    )
    shared = (
        seed.groupBy("anchor")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), (F.min("span") < F.max("span")).alias("several"))
        .filter("low < high")
        .select("anchor", "several")
    )
    hits = stage(seed.join(stage(shared, "anchors"), "anchor"), "hits")
    owner = stage(hits.groupBy("anchor", "span").agg(F.min("doc_id").alias("owner")), "owners")
    met = stage(hits.join(owner, ["anchor", "span"]), "met")
    whole = met.filter("doc_id > owner").select("doc_id", "text_key", "first", "last")
    unsure = (
        met.filter("several AND doc_id = owner")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("first", "last", "anchor")).alias("spans"))
    )
    rows = stage(
        read.join(unsure, ["doc_id", "text_key"])
        .select("doc_id", "text_key", "text", "spans")
        .mapInArrow(windows(length, anchor), "doc_id long, text_key long, anchor long, window long, place int"),
        "windows",
    )
    earliest = (
        rows.groupBy("anchor", "window")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low < high")
        .select("anchor", "window", "low")
    )
    part = (
        rows.join(stage(earliest, "earliest"), ["anchor", "window"])
        .filter("doc_id > low")
        .select("doc_id", "text_key", F.col("place").alias("first"), F.col("place").alias("last"))
    )
    return whole.unionByName(part)


def with_ranges(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """All columns of the documents, and the ranges of each as ``__ranges`` (null: none)."""
    found = (
        repeated_ranges(docs, length, anchor)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("first", "last")).alias("__ranges"))
        .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__ranges")
    )
    keyed = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), "__key": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    return keyed.join(found, ["__id", "__key"], "left")


def substring_dedup(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """Remove every word covered by a window of ``length`` words whose sequence also
    begins in a document with a smaller id.

    Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by one
    space) for every row. Empty or null texts have no words and the hash of nothing.
    Long texts are read whole; an empty table gives no rows.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    )

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows:
            found = []
            for text, ranges in zip(byte_list(r.column(1)), r.column(2).to_pylist()):
                words = text.split()
                kept = words
                if ranges:
                    mask = kept_words(words, [(x["first"], x["last"]) for x in ranges], length)
                    kept = [words[i] for i in np.flatnonzero(mask)]
                found.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            n, removed, digest = zip(*found) if found else ((), (), ())
            yield batch(schema, doc_id=r.column(0), n_words=n, n_removed=removed, kept_sha256=digest)

    rows = with_ranges(docs.select("doc_id", "text"), length, anchor).select("__id", F.coalesce("text", F.lit("")).alias("text"), "__ranges")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string").withColumn(
        "doc_id", id_back("doc_id")
    )


@columns_kept
def without_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """The documents, repeated passages cut out of their texts.

    Texts without one stay as they are, null included; of the others the kept words
    are joined by one space. A column n_chars follows the new text.
    """

    @F.pandas_udf("string")
    def cut(text, ranges):
        import pandas as pd

        out = []
        for t, found in zip(text, ranges):
            if t is not None and found is not None and len(found):
                words = t.encode().split()
                mask = kept_words(words, [(x["first"], x["last"]) for x in found], length)
                t = b" ".join(words[i] for i in np.flatnonzero(mask)).decode()
            out.append(t)
        return pd.Series(out, dtype=object)

    found = with_ranges(docs, length, anchor)
    new = F.when(F.col("__ranges").isNull(), F.col("text")).otherwise(cut(F.col("text"), F.col("__ranges")))
    out = found.withColumn("__new", new)
    changed = {"text": F.col("__new")}
    if "n_chars" in docs.columns:
        size = F.when(F.col("__ranges").isNull(), F.col("n_chars")).otherwise(F.length("__new"))
        changed["n_chars"] = size.cast(docs.schema["n_chars"].dataType)
    return out.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])
