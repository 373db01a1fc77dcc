"""Spelling variants: words that differ by one edit, grouped under the frequent form.

Two words are near if one inserted, deleted or replaced code point makes them equal. That
is so exactly if their common prefix and their common suffix together reach the longer
length less one. With the longer length m, the edit lies in one of ``SHAPES`` ranges of
places, and outside this range both words agree: they share a key of the range, m, and the
code points before and behind it. Words that share a key are compared as tiles: padded
matrices of code points, one of prefixes and one of suffixes, each row of one block with
each row of the other.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import batch, batches_of, bounded_batches, byte_list, text_of
from tallyloom.sources.tables import stage

LEAST_LENGTH, LEAST_COUNT = 7, 2
FACTOR = 10
SHAPES = 4
WORDS_HELD = 1 << 17
BLOCK_CELLS = 1 << 14  # code points of a block; larger groups are dealt to several
CELLS = 1 << 22  # of what is compared at once
ROWS_AT_ONCE = 1 << 15
PAIRS_AT_ONCE = 1 << 16


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, spoil: int | None = None) -> DataFrame:
    """How often each word occurs in all texts: word, n.

    Words are the longest runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case and
    at least ``least_length`` code points. ``spoil`` makes misspellings: of every word whose
    CRC-32 of ``doc_id:word`` it divides, the code point at this number modulo the length is
    left out. Null texts have no words; a null id is written as nothing. Counted in the
    tasks first, so a word that is everywhere is few rows. Empty tables give empty ones.
    """
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    # Shorter words cannot reach the length.
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % max(1, least_length))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for r in batches_of(rows):
            for i, text in zip(r.column(0).to_pylist(), byte_list(r.column(1))):
                found = pattern.findall(text.lower().decode("utf-8", "replace"))
                if spoil is None:
                    counts.update(found)
                else:
                    begin = zlib.crc32(f"{'' if i is None else i}:".encode())
                    for at, word in enumerate(found):
                        h = zlib.crc32(word.encode(), begin)
                        if h % spoil == 0:
                            k = h % len(word)
                            found[at] = word[:k] + word[k + 1 :]
                    counts.update(found)
                if len(counts) >= WORDS_HELD:
                    yield batch(schema, word=list(counts), n=list(counts.values()))
                    counts.clear()
        if counts:
            yield batch(schema, word=list(counts), n=list(counts.values()))

    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "word string, n long"
    )
    return parts.filter(F.length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n"))


def _outside(m: int | np.ndarray, shape: int | np.ndarray, shapes: int):
    """Lengths of the prefix and of the suffix that words with an edit in this range share."""
    return shape * m // shapes, m - (shape + 1) * m // shapes


def near_pairs(words: DataFrame, shapes: int = SHAPES, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """word, near, near_n: every ordered pair of near words of (word, n), once.

    A null word is near to none; repeated words count as one with all their counts. Groups
    that share a key are dealt to blocks by hash if they have more than ``block_cells`` code
    points, and each pair of blocks is a tile of its own: no task holds a group whole.
    """
    spark = words.sparkSession
    bounded_batches(spark)
    keys = []
    for longer in (0, 1):
        m = F.length("word") + F.lit(longer)
        for shape in range(shapes):
            before = F.floor(F.lit(shape) * m / F.lit(shapes)).cast("int")
            behind = (m - F.floor(F.lit(shape + 1) * m / F.lit(shapes))).cast("int")
            both = F.substring("word", F.lit(1), before), F.substring("word", F.length("word") - behind + 1, behind)
            keys.append(
                F.struct(
                    m.alias("m"),
                    F.lit(shape).alias("shape"),
                    F.lit(longer == 1).alias("shorter"),
                    F.xxhash64(F.lit(shape), m, *both).alias("key"),
                )
            )
    keyed = words.select("word", "n", F.explode(F.array(*keys)).alias("k")).select("k.*", "word", "n")
    # Few groups are large; the others need no count.
    sizes = keyed.groupBy("m", "shape", "key").agg(F.count("*").alias("rows"))
    cells = F.col("rows") * F.col("m")
    large = stage(
        sizes.filter(cells > block_cells).select(
            "m", "shape", "key", F.ceil(cells / F.lit(block_cells)).cast("int").alias("blocks")
        ),
        "large_groups",
    )
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("word", F.lit(1)), blocks).cast("int")
    tiles = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(
            F.least(F.col("own"), other).alias("i"), F.greatest(F.col("own"), other).alias("j")
        ),
    )
    dealt = (
        keyed.join(large, ["m", "shape", "key"], "left")
        .withColumn("own", own)
        .withColumn("tile", F.explode(tiles))
        .select("m", "shape", "key", "tile.i", "tile.j", "own", "shorter", "word", "n")
        .repartition("m", "shape", "key", "i", "j")
        .sortWithinPartitions("m", "shape", "key", "i", "j")
    )
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _whole_groups(rows):
            words, n = held.column("word").combine_chunks(), held.column("n").combine_chunks()
            for a, b in _near_rows(held, shapes):
                left, right = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
                yield pa.RecordBatch.from_arrays([words.take(left), words.take(right), n.take(right)], schema=schema)

    return dealt.mapInArrow(run, "word string, near string, near_n long")


GROUP = ("m", "shape", "key", "i", "j")


def _whole_groups(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted rows in tables of whole groups of about ``CELLS`` code points at most."""
    rest, size = [], 0
    for r in batches_of(rows):
        rest.append(r)
        size += r.num_rows
        if size < ROWS_AT_ONCE and size * int(r.column(0)[r.num_rows - 1].as_py()) < CELLS:
            continue
        held = pa.Table.from_batches(rest)
        opens = _opens(held)
        if len(opens) > 1:
            yield held.slice(0, int(opens[-1]))
        held = held.slice(int(opens[-1]))
        rest, size = held.to_batches(), held.num_rows
    if rest:
        yield pa.Table.from_batches(rest)


def _opens(held: pa.Table) -> np.ndarray:
    """Where groups begin."""
    new = np.zeros(held.num_rows, bool)
    new[0] = True
    for name in GROUP:
        values = held.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _near_rows(held: pa.Table, shapes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows with near words, compared within the groups."""
    opens = _opens(held)
    sizes = np.diff(np.append(opens, held.num_rows))
    many = sizes > 1
    if not many.any():
        return
    opens, sizes = opens[many], sizes[many]
    m = held.column("m").to_numpy().astype(np.int64)
    shape = held.column("shape").to_numpy().astype(np.int64)
    shorter = held.column("shorter").combine_chunks().to_numpy(zero_copy_only=False)
    own, i, j = (held.column(c).to_numpy() for c in ("own", "i", "j"))
    # Groups of alike size and length go together; a tile is at most twice as wide as needed.
    width = 1 << np.ceil(np.log2(sizes)).astype(int)
    split = i[opens] != j[opens]
    texts = held.column("word").combine_chunks()
    order = np.lexsort((m[opens], width, split))
    at = 0
    while at < len(order):
        c, one = int(width[order[at]]), not split[order[at]]
        longest = int(m[opens[order[at]]])
        # As many groups of this width as one step may compare.
        room = max(1, min(CELLS // (c * c * (longest + 1)), CELLS // (c * (longest + 1))))
        upto = at + 1
        while upto < len(order) and upto - at < room and width[order[upto]] == c and split[order[upto]] != one and m[opens[order[upto]]] <= longest + 3:
            upto += 1
        some = order[at:upto]
        at = upto
        rows = opens[some][:, None] + np.arange(c)
        valid = np.arange(c) < sizes[some][:, None]
        rows = np.where(valid, rows, opens[some][:, None])
        fore, back = _matrices(texts, rows.ravel())
        fore, back = (x.reshape(*rows.shape, -1) for x in (fore, back))
        step = max(1, CELLS // max(1, rows.size * fore.shape[-1]))
        for low in range(0, c, step):
            a = slice(low, min(c, low + step))
            prefix = _agreeing(fore[:, a], fore)
            suffix = _agreeing(back[:, a], back)
            longer = m[opens[some]][:, None, None]
            near = (prefix + suffix >= longer - 1) & (prefix < longer)
            near &= valid[:, a, None] & valid[:, None, :]
            short = shorter[rows]
            near &= ~(short[:, a, None] & short[:, None, :])
            mine = own[rows]
            # Inside a block each pair once, between two blocks those of both.
            apart = mine[:, a, None] < mine[:, None, :]
            upper = (np.arange(c)[a][:, None] < np.arange(c)[None, :])[None]
            near &= np.where(split[some][:, None, None], apart, upper)
            g, x, y = np.nonzero(near)
            if not len(g):
                continue
            left, right = rows[g, x + low], rows[g, y]
            p, s = prefix[g, x, y], suffix[g, x, y]
            keep = np.ones(len(g), bool)
            for other in range(shapes):
                before, behind = _outside(m[left], other, shapes)
                keep &= ~((other < shape[left]) & (before <= p) & (behind <= s))
            left, right = left[keep], right[keep]
            for k in range(0, len(left), PAIRS_AT_ONCE):
                yield left[k : k + PAIRS_AT_ONCE], right[k : k + PAIRS_AT_ONCE]


def _matrices(texts: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of these rows' words from the left, and from the right, padded with 0."""
    words = texts.take(pa.array(rows)).to_pylist()
    sizes = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    kind = np.uint8 if points.max(initial=0) < 255 else np.uint32
    row = np.repeat(np.arange(len(words)), sizes)
    column = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    fore = np.zeros((len(words), int(sizes.max(initial=0)) + 1), kind)
    back = np.zeros_like(fore)
    fore[row, column] = points + 1
    back[row, np.repeat(sizes, sizes) - 1 - column] = points + 1
    return fore, back


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many leading columns each row of a tile of ``a`` equals each of ``b``."""
    same = a[:, :, None, :] == b[:, None, :, :]
    first = same.argmin(axis=-1)
    first[(first == 0) & same[..., 0]] = same.shape[-1]
    return first


def spelling_variants(counts: DataFrame, least_count: int = LEAST_COUNT, factor: int = FACTOR, shapes: int = SHAPES, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words of (word, n) that occur often enough.

    A word's form is its near word of largest n (the smallest of equals), if that is at least
    ``factor`` times the word's own; else null. The root is where the forms lead in the end,
    the word itself without a form. Counts grow along the forms, so they never turn back.

    Repeated words are added up, null words left out; an empty table gives an empty one.
    A form has no more variants than one edit of it can make, so no key of the joins is hot.
    """
    totals = counts.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    words = stage(totals.filter(F.col("n") >= least_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_pairs(words, shapes, block_cells).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    formed = stage(
        words.join(near, "word", "left").select(
            "word",
            F.when(form_n >= factor * F.col("n"), F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(form_n >= factor * F.col("n"), form_n).alias("form_n"),
        ),
        "forms",
    )
    roots = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # Each step multiplies the count, so the largest bounds the steps; each round doubles them.
    most = words.agg(F.max("n")).first()[0] or 1
    steps = math.log(max(1, most / max(1, least_count)), factor) if factor > 1 else most
    for _ in range(math.ceil(math.log2(max(1, steps))) + 1):
        roots = stage(roots, "roots")
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
