"""Fill-in-middle: documents cut at two line ends and rearranged for infilling.

The line ends of all texts of a batch are one ``BoundarySet``: a compressed set of byte
positions in containers of 2**16 positions each, sorted arrays, bitmaps or runs, whichever
is smallest, with cumulative cardinalities before each. The cut after the k-th line of a
document is one selection: a search for the container, then a selection inside it.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import batch, batches_of, bounded_batches, byte_list, text_of

# The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
CONTAINER_BITS = 16
ARRAY_LIMIT = 4096  # beyond it a bitmap of 2**16 bits takes less room than an array


class BoundarySet:
    """A set of positions that answers rank (how many at or below) and select (the k-th)."""

    def __init__(self, positions: np.ndarray) -> None:
        """``positions`` ascend and are distinct."""
        highs, begin, counts = np.unique(positions >> CONTAINER_BITS, return_index=True, return_counts=True)
        self.highs = highs
        self.before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        low = (positions & ((1 << CONTAINER_BITS) - 1)).astype(np.uint16)
        self.containers = [_container(low[a : a + n]) for a, n in zip(begin, counts)]

    def __len__(self) -> int:
        return int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many positions lie at or below each of ``at``."""
        high = at >> CONTAINER_BITS
        c = np.searchsorted(self.highs, high, side="left")
        found = self.before[c].copy()
        inside = c < len(self.highs)
        inside[inside] = self.highs[c[inside]] == high[inside]
        for k in np.unique(c[inside]):
            here = inside & (c == k)
            found[here] += self.containers[k].rank((at[here] & ((1 << CONTAINER_BITS) - 1)).astype(np.int64))
        return found

    def select(self, k: np.ndarray) -> np.ndarray:
        """The positions of these numbers, counted from 0."""
        c = np.searchsorted(self.before, k, side="right") - 1
        found = np.empty(len(k), np.int64)
        for i in np.unique(c):
            here = c == i
            found[here] = (int(self.highs[i]) << CONTAINER_BITS) + self.containers[i].select(k[here] - self.before[i])
        return found


class ArrayContainer:
    def __init__(self, low: np.ndarray) -> None:
        self.low = low

    def rank(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, at, side="right")

    def select(self, k: np.ndarray) -> np.ndarray:
        return self.low[k].astype(np.int64)


class BitmapContainer:
    def __init__(self, low: np.ndarray) -> None:
        bits = np.zeros(1 << CONTAINER_BITS, np.uint8)
        bits[low] = 1
        self.bytes = np.packbits(bits, bitorder="little")
        # How many are set before each byte.
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bytes))]).astype(np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        upto = self.bytes[at >> 3] & ((2 << (at & 7)) - 1).astype(np.uint8)
        return self.before[at >> 3] + np.bitwise_count(upto)

    def select(self, k: np.ndarray) -> np.ndarray:
        byte = np.searchsorted(self.before, k, side="right") - 1
        bits = np.unpackbits(self.bytes[byte][:, None], axis=1, bitorder="little")
        bit = (np.cumsum(bits, axis=1) == (k - self.before[byte] + 1)[:, None]).argmax(axis=1)
        return byte * 8 + bit


class RunContainer:
    def __init__(self, starts: np.ndarray, lengths: np.ndarray) -> None:
        self.starts = starts.astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.starts, at, side="right") - 1
        inside = np.minimum(at - self.starts[run] + 1, self.before[run + 1] - self.before[run])
        return np.where(run < 0, 0, self.before[run] + inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, k, side="right") - 1
        return self.starts[run] + k - self.before[run]


def _container(low: np.ndarray):
    """The smallest container for these ascending 16-bit positions."""
    opens = np.flatnonzero(np.diff(low.astype(np.int32), prepend=-2) != 1)
    if 4 * len(opens) < min(2 * len(low), 1 << (CONTAINER_BITS - 3)):
        return RunContainer(low[opens], np.diff(np.append(opens, len(low))))
    return ArrayContainer(low) if len(low) <= ARRAY_LIMIT else BitmapContainer(low)


def line_ends(data: np.ndarray, ends: np.ndarray) -> BoundarySet:
    """Where lines end in texts that lie one after the other, given where texts end.

    A line ends behind its line feed, the last one of a text at the text's end.
    """
    feeds = np.flatnonzero(data == 10) + 1
    filled = ends[np.diff(ends, prepend=0) > 0]
    return BoundarySet(np.union1d(feeds, filled).astype(np.int64))


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """Each document cut after two of its lines: doc_id, n (lines), form, prefix_chars,
    middle_chars, output.

    The cuts lie after ``h1 % (n+1)`` and ``h2 % (n+1)`` lines, where h1 to h4 are the
    first 32-bit numbers of the SHA-256 of ``seed:doc_id``. ``h3 % 100 < rate`` decides
    whether a text is cut at all, ``h4 % 100 < spm_rate`` whether the suffix comes first
    (form spm) or the prefix (psm). Texts that are empty (null ones, too) or have one of
    the marks stay as they are: form plain, lengths null.

    One task each batch, no shuffle. Equal rows give equal rows. A null id hashes as an
    empty one and stays null. An empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
         ("middle_chars", pa.int64()), ("output", pa.string())]
    )
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches_of(rows):
            ids, texts = r.column(0).to_pylist(), byte_list(r.column(1))
            data = b"".join(texts)
            at = np.frombuffer(data, np.uint8)
            ends = np.cumsum([len(t) for t in texts])
            starts = ends - [len(t) for t in texts]
            lines = line_ends(at, ends)
            base = lines.rank(starts)
            n = lines.rank(ends) - base
            hashes = [
                struct.unpack(">4I", hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16])
                for i in ids
            ]
            h = np.array(hashes, np.int64)
            after = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
            cuts = np.repeat(starts[:, None], 2, axis=1)
            some = after > 0
            cuts[some] = lines.select((base[:, None] + after - 1)[some])
            plain = [not t or p in t or s in t or m in t for t in texts] | (h[:, 2] % 100 >= rate)
            first = h[:, 3] % 100 < spm_rate
            chars = np.concatenate([[0], np.cumsum((at & 0xC0) != 0x80)])
            a, b = cuts[:, 0], cuts[:, 1]
            output, form = [], []
            for text, whole, spm, x, y in zip(texts, plain.tolist(), first.tolist(), (a - starts).tolist(), (b - starts).tolist()):
                form.append("plain" if whole else "spm" if spm else "psm")
                if whole:
                    output.append(text)
                elif spm:
                    output.append(b"".join([s, text[y:], p, text[:x], m, text[x:y]]))
                else:
                    output.append(b"".join([p, text[:x], s, text[y:], m, text[x:y]]))
            yield batch(
                schema,
                doc_id=ids,
                n=n,
                form=form,
                prefix_chars=pa.array(chars[a] - chars[starts], mask=plain),
                middle_chars=pa.array(chars[b] - chars[a], mask=plain),
                output=pa.array(output, pa.binary()).cast(pa.string()),
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text that was cut, from the output and its form.

    Cut texts have no marks, and a mark cannot begin inside another, so each occurs once.
    """

    def between(opening: str, closing: str) -> Column:
        return F.split_part(F.split_part(output, F.lit(opening), F.lit(2)), F.lit(closing), F.lit(1))

    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
