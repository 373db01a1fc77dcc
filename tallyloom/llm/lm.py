"""Language-model scores from a hashed maximum-entropy model.

A word belongs to a class by its ending, inside the class to a slot by its hash, and
inside the slot to a leaf by more digits of its hash; the end of a text is a class of its
own. The model is the product of P(class | context), P(slot | class, context) and P(digit
| class, slot, digits before, context) for each digit, and P(word | leaf). All but the
last are softmaxes over sums of hashed weight rows, one row for each feature of the
context. For classes: the word before, the two words before, the classes of these, and the
words two and three back (skips); for slots the word before together with the class, the
classes before, and whether the word before was of this class and which slot it had; for
digits the word before together with class, slot and digits before. Without weights they
give the corpus shares. P(word | leaf) comes from the counts of all words of the training
texts, so that without weights a word has its corpus share.

What is learnt grows with the corpus: the counts with the distinct words, the number of
digits with their logarithm, the rows of weights with the cube root of the training
tokens. So does the stretch of text that a task trains on, so that the weights the tasks
send are a constant share of the corpus.

Texts are encoded once, in blocks with a dictionary each. Weights are trained in rounds
over parts of the training documents: every task takes gradient steps over its blocks from
the same weights, and its change is averaged with those of the others, row by row, by the
number of tokens that moved it. Counts of words are kept in shards by hash: every block
sends its distinct words with their counts to the shards, which add them up and send the
sums back.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import batch, byte_list, id_back, id_of, mixed, text_of, bounded_batches
from tallyloom.sources.tables import stage

CLASSES = 16  # the first one is the end of the text
SLOTS = 16
DIGIT = 16  # leaves of a slot are numbered by digits of this base
ROWS = 2048  # rows of weights of each hashed feature in a small corpus
DIGIT_ROWS = 4  # times as many for a digit
BLOCK_TOKENS = 1 << 20
WORKER_TOKENS = 4 << 20
ROUNDS = 2
RATE = 0.25
STEP_TOKENS = 8192
SEGMENTS = 16
END_WORD = b" "  # no word has a blank

SHARD_TOKENS = 1 << 19
# A row holds a block of some MB. Parquet would look at the size after a hundred of them only, and
# a row group is read at once; so it looks after each, and a row group holds one or two.
BLOCK_FILES = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}

CLASS_FEATURES = 5
CLASS_ROWS = CLASS_FEATURES * ROWS
SLOT_ROWS = 2 * ROWS + SLOTS + 1


class WordIndex(dict):
    """Numbers of the words of a block in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def outcome_of(word: bytes) -> int:
    """Class and slot of a word in one number."""
    if word == END_WORD:
        return 0
    ending = word.decode()[-2:].encode()
    own = 1 + xxhash.xxh32_intdigest(ending) % (CLASSES - 1)
    return own * SLOTS + xxhash.xxh32_intdigest(word, 1) % SLOTS


def growth(tokens: int) -> float:
    """How much larger weights and the stretches of a task are than in a small corpus."""
    return float(np.cbrt(1 + tokens / WORKER_TOKENS))


def depth_of(words: int) -> int:
    """Digits below a slot: leaves grow with the square root of the distinct words."""
    return max(2, int(np.log(max(words, 1)) / np.log(DIGIT) / 2) + 1)


def prefix_of(hashes: np.ndarray, digits: int) -> np.ndarray:
    """The first digits of the hashes as a number."""
    return (hashes >> np.uint64(64 - 4 * digits)).astype(np.int64) if digits else np.zeros(len(hashes), np.int64)


class Priors(NamedTuple):
    """Logarithms of the corpus shares, and what the words of a slot and of a leaf share.

    The shares of the last digit are not divided by their sum, which a softmax does: so they
    are what the words of a leaf share, too, and the largest array is there once.
    """

    classes: np.ndarray
    slots: np.ndarray  # (class, slot)
    mass: np.ndarray  # counts of the words of an outcome, smoothed
    digits: tuple = ()  # for each digit (outcome and digits before, digit); the last: smoothed counts of leaves

    @staticmethod
    def of(outcome: np.ndarray, count: np.ndarray, types: np.ndarray, leaf: np.ndarray | None = None, depth: int = 0) -> Priors:
        """From counts and distinct words of outcomes, or of their leaves."""
        mass = np.full(CLASSES * SLOTS, 0.5)
        np.add.at(mass, outcome, count + 0.5 * types)
        mass[0] = max(0.5, mass[0] - 1.0)  # the end has neither smoothing nor unknowns
        grid = mass.reshape(CLASSES, SLOTS)
        total = grid.sum(1)
        total[0] = mass[0]
        digits = []
        if leaf is not None:
            leaves = np.zeros(CLASSES * SLOTS * DIGIT**depth)
            leaves[outcome * DIGIT**depth + leaf] = count + 0.5 * types
            for k in range(depth - 1):
                held = leaves.reshape(CLASSES * SLOTS * DIGIT**k, DIGIT, -1).sum(2)
                share = held / np.maximum(held.sum(1), 1e-30)[:, None]
                digits.append(np.log(np.maximum(share, 1e-30)).astype(np.float32))
            np.log(np.maximum(leaves, 1e-30, out=leaves), out=leaves)
            digits.append(leaves.astype(np.float32).reshape(-1, DIGIT))
        return Priors(
            np.log(total / total.sum()).astype(np.float32), np.log(grid / grid.sum(1)[:, None]).astype(np.float32), mass,
            tuple(digits),
        )

    def of_words(self, hashes: np.ndarray, outcomes: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Logarithm of P(word | leaf) of words met in training, with that of being one of
        those; of the unknown word of their outcome for the others; 0 for the end."""
        depth = len(self.digits)
        leaf = self.digits[-1].ravel()[outcomes * DIGIT**depth + prefix_of(hashes, depth)]
        unknown = 0.5 / self.mass[outcomes]
        met = np.log(count + 0.5) - np.maximum(leaf, np.log(0.5)) + np.log1p(-np.minimum(unknown, 0.999))
        return np.where(outcomes > 0, np.where(count > 0, met, np.log(unknown)), 0.0)


class Contexts:
    """Rows of weights of each feature of the tokens of a stretch of documents."""

    def __init__(self, hashes: np.ndarray, outcomes: np.ndarray, begins: np.ndarray, rows: int = ROWS, depth: int = 0) -> None:
        """``begins``: place of each token in its document."""
        n = len(hashes)
        back = []
        classes = []
        slots = np.full(n, SLOTS)
        for k in (1, 2, 3):
            h, c = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            inside = begins >= k
            inside[:k] = False
            at = np.flatnonzero(inside)
            h[at] = hashes[at - k]
            c[at] = (outcomes[at - k] // SLOTS).astype(np.uint64) + np.uint64(1)
            if k == 1:
                slots[at] = outcomes[at - 1] % SLOTS
            back.append(h)
            classes.append(c)
        own = outcomes // SLOTS
        odd = np.uint64(0x9E3779B97F4A7C15)
        row = lambda x, among=rows: ((mixed(x) >> np.uint64(40)) * np.uint64(among) >> np.uint64(24)).view(np.int64)
        self.classes = [
            row(back[0]),
            rows + row(back[0] * odd + back[1]),
            2 * rows + row(classes[0] * np.uint64(CLASSES + 1) + classes[1]),
            3 * rows + row(back[1] + np.uint64(2)),
            4 * rows + row(back[2] + np.uint64(3)),
        ]
        same = classes[0].astype(np.int64) == own + 1
        self.slots = [
            row(back[0] * odd + own.astype(np.uint64)),
            rows + row(classes[0] * np.uint64(1 << 20) + classes[1] * np.uint64(1 << 10) + own.astype(np.uint64)),
            2 * rows + np.where(same, slots, SLOTS),
        ]
        self.digits = []  # of each digit: row, outcome with the digits before, the digit
        for k in range(depth):
            before = outcomes * DIGIT**k + prefix_of(hashes, k)
            at = row(back[0] * odd + before.astype(np.uint64) + np.uint64(k), DIGIT_ROWS * rows)
            self.digits.append((at, before, prefix_of(hashes, k + 1) & (DIGIT - 1)))


class Weights:
    """Rows of weights and the steps that train them.

    Rows are gathered into arrays that are kept: new ones of this size would be mapped by
    the system every time, which takes far longer than filling them.
    """

    def __init__(self, rows: int = ROWS, depth: int = 0, tables: list[np.ndarray] | None = None, trains: bool = True) -> None:
        """``trains``: the tables given are copied, as steps change them."""
        if tables is None:
            shapes = [(CLASS_FEATURES * rows, CLASSES), (2 * rows + SLOTS + 1, SLOTS), *[(DIGIT_ROWS * rows, DIGIT)] * depth]
            tables = [np.zeros(shape, np.float32) for shape in shapes]
        self.tables = [t.copy() for t in tables] if trains else tables
        self.classes, self.slots = self.tables[:2]
        widths = {t.shape[1]: [np.empty((STEP_TOKENS, t.shape[1]), np.float32) for _ in range(4)] for t in self.tables}
        self.kept = [widths[t.shape[1]] for t in self.tables]

    def prepare(self) -> None:
        self.squares = [np.full_like(t, 1.0) for t in self.tables]
        self.moved = [np.zeros(len(t), np.float32) for t in self.tables]

    def _shares(self, which: int, rows: list[np.ndarray], hit: np.ndarray, start: np.ndarray, own: np.ndarray | None):
        """Probabilities of all outcomes (an array that is kept) and the logarithm of that
        of the outcome that came."""
        n = len(hit)
        out, more = (x[:n] for x in self.kept[which][:2])
        np.take(self.tables[which], rows[0], axis=0, out=out, mode="clip")
        for r in rows[1:]:
            out += np.take(self.tables[which], r, axis=0, out=more, mode="clip")
        out += start if own is None else np.take(start, own, axis=0, out=more, mode="clip")
        # Rows are short: the largest of each is found faster across than along them.
        out -= np.maximum.reduce(np.ascontiguousarray(out.T), axis=0)[:, None]
        chosen = out[np.arange(n), hit]
        np.exp(out, out=out)
        total = np.einsum("ij->i", out)[:, None]
        return out, total, chosen - np.log(total[:, 0])

    def logs(self, c: Contexts, outcomes: np.ndarray, priors: Priors) -> np.ndarray:
        """Natural logarithm of P(class) P(slot) of each token."""
        out = np.empty(len(outcomes))
        for b in range(0, len(outcomes), STEP_TOKENS):
            at = slice(b, b + STEP_TOKENS)
            own, slot = outcomes[at] // SLOTS, outcomes[at] % SLOTS
            out[at] = self._shares(0, [r[at] for r in c.classes], own, priors.classes, None)[2]
            inner = self._shares(1, [r[at] for r in c.slots], slot, priors.slots, own)[2]
            out[at] += np.where(own > 0, inner, 0.0)
        return out

    def digit_logs(self, c: Contexts, known: np.ndarray, priors: Priors) -> np.ndarray:
        """Natural logarithm of P(digits | class, slot) of the known words, else 0."""
        out = np.zeros(len(known))
        at = np.flatnonzero(known)
        for b in range(0, len(at), STEP_TOKENS):
            part = at[b : b + STEP_TOKENS]
            for k, start in enumerate(priors.digits):
                rows, before, hit = (x[part] for x in c.digits[k])
                out[part] += self._shares(2 + k, [rows], hit, start, before)[2]
        return out

    def train(self, c: Contexts, outcomes: np.ndarray, priors: Priors) -> None:
        for b in range(0, len(outcomes), STEP_TOKENS):
            at = slice(b, b + STEP_TOKENS)
            own, slot = outcomes[at] // SLOTS, outcomes[at] % SLOTS
            self._learn(0, [r[at] for r in c.classes], own, priors.classes, None)
            words = np.flatnonzero(own > 0)  # the end has one slot
            self._learn(1, [r[at][words] for r in c.slots], slot[words], priors.slots, own[words])
            for k, start in enumerate(priors.digits):
                rows, before, hit = (x[at][words] for x in c.digits[k])
                self._learn(2 + k, [rows], hit, start, before)

    def _learn(self, which: int, rows: list[np.ndarray], hit: np.ndarray, start: np.ndarray, own: np.ndarray | None) -> None:
        if len(hit):
            miss, total, _ = self._shares(which, rows, hit, start, own)
            miss /= total
            miss[np.arange(len(hit)), hit] -= 1
            for r in rows:
                self._step(which, r, miss)

    def _step(self, which: int, rows: np.ndarray, miss: np.ndarray) -> None:
        _, more, sums, old = self.kept[which]
        low = rows.min()  # 16 bits sort faster
        order = np.argsort((rows - low).astype(np.uint16 if rows.max() - low < 1 << 16 else np.int64), kind="stable")
        ordered = rows[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        own = ordered[first]
        k = len(own)
        np.take(miss, order, axis=0, out=more[: len(rows)], mode="clip")
        gradient = np.add.reduceat(more[: len(rows)], first, axis=0, out=sums[:k])
        total = np.take(self.squares[which], own, axis=0, out=old[:k], mode="clip")
        total += np.multiply(gradient, gradient, out=more[:k])
        self.squares[which][own] = total
        np.sqrt(total, out=total)
        gradient /= total
        gradient *= RATE
        now = np.take(self.tables[which], own, axis=0, out=more[:k], mode="clip")
        now -= gradient
        self.tables[which][own] = now
        self.moved[which][own] += np.diff(np.append(first, len(rows)))


def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: their token numbers, and the words of the block."""
    task = TaskContext.get().partitionId()
    number = 0
    index, ids, held, tokens, total = WordIndex({END_WORD: 0}), [], [], [], 0

    def block() -> pa.RecordBatch:
        nonlocal number, index, ids, held, tokens, total
        sizes = np.array([len(t) for t in tokens], np.int32)
        flat = np.concatenate(tokens)
        out = np.repeat(np.array(held), sizes)
        words = list(index)
        found = batch(
            BLOCK_SCHEMA, block=[(task << 32) + number], ids=[ids], sizes=[sizes], held=[held], tokens=[flat],
            counts=[np.bincount(flat[~out], minlength=len(words))],
            outcomes=[np.array([outcome_of(w) for w in words], np.int32)],
            hashes=[np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64).view(np.int64)],
        )
        number += 1
        index, ids, held, tokens, total = WordIndex({END_WORD: 0}), [], [], [], 0
        return found

    for r in batches:
        for doc_id, out, text in zip(r.column(0).to_pylist(), r.column(1).to_pylist(), byte_list(r.column(2))):
            words = text.lower().split()
            words.append(END_WORD)
            tokens.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
            ids.append(doc_id)
            held.append(out)
            total += len(words)
            if total >= BLOCK_TOKENS:
                yield block()
    if ids:
        yield block()


BLOCK_SCHEMA = pa.schema(
    [("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("held", pa.list_(pa.bool_())), ("tokens", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64())), ("outcomes", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64()))]
)
SCORED = ["ids", "sizes", "held", "tokens", "outcomes", "hashes"]
BLOCK_DDL = "block long, ids array<long>, sizes array<int>, held array<boolean>, tokens array<int>, counts array<long>, outcomes array<int>, hashes array<long>"


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Each row's arrays (and numbers)."""
    for r in batches:
        for i in range(r.num_rows):
            yield [c[i].values.to_numpy(zero_copy_only=False) if pa.types.is_nested(c.type) else c[i].as_py() for c in r.columns]


def places(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def stretches(sizes: np.ndarray, least: int = 1 << 17) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about this many tokens."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        last = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + least)) + 1
        yield first, min(last, len(sizes))
        first = last


def packed(x: np.ndarray) -> bytes:
    """64-bit numbers byte by byte, as their high bytes are mostly equal."""
    return x.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(x: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view(kind).ravel()


def word_counts(blocks: DataFrame, tokens: int) -> DataFrame:
    """block, shard, n: the corpus counts of the words of each block, cut by shard, in the
    order of their hashes."""
    shards = max(1, tokens // SHARD_TOKENS)
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, counts, hashes in rows_of(batches):
            hashes = hashes.view(np.uint64)
            order = np.argsort(hashes)
            words, n = hashes[order], counts[order]
            shard = ((words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            own, first = np.unique(shard, return_index=True)
            cuts = list(zip(first, np.append(first[1:], len(shard))))
            yield batch(
                schema, shard=own.astype(np.int32), block=[block] * len(own),
                keys=[packed(np.diff(words[a:b], prepend=np.uint64(0))) for a, b in cuts], n=[packed(n[a:b]) for a, b in cuts],
            )

    def answer(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpacked(x, np.uint64), dtype=np.uint64) for x in table.column("keys").to_pylist()]
        n = np.concatenate([unpacked(x, np.int64) for x in table.column("n").to_pylist()])
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=n, minlength=len(distinct)).astype(np.int64)[at]
        cut = np.cumsum([len(k) for k in keys])[:-1]
        return pa.table(
            {c: table.column(c) for c in ("block", "shard")} | {"n": pa.array([packed(x) for x in np.split(total, cut)], pa.binary())}
        )

    return (
        blocks.select("block", "counts", "hashes")
        .mapInArrow(ask, "shard int, block long, keys binary, n binary")
        .groupBy("shard")
        .applyInArrow(answer, "block long, shard int, n binary")
    )


def trained(blocks: DataFrame, priors: Broadcast, tokens: int, depth: int, rounds: int, worker_tokens: int) -> Weights:
    """Weights after gradient steps of all tasks, averaged after each round."""
    spark = blocks.sparkSession
    size = int(ROWS * growth(tokens))
    weights = Weights(size, depth)
    workers = max(1, int(-(-tokens // (worker_tokens * growth(tokens)))))
    sqrt = max(1, int(np.sqrt(workers)))
    data = blocks.select("sizes", "held", "tokens", "outcomes", "hashes").coalesce(workers)
    schema = pa.schema([("segment", pa.int32()), ("salt", pa.int32()), ("moved", pa.binary()), ("change", pa.binary())])
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(weights.tables)

        def work(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            tables, own_priors = shared.value, Priors(*priors.value)
            own = Weights(tables=tables)
            own.prepare()
            for sizes, held, numbers, outcomes, hashes in rows_of(batches):
                hashes = hashes.view(np.uint64)
                for a, b in stretches(sizes):
                    # Every training document has its round.
                    take = ~held[a:b] & ((np.arange(a, b) + turn) % rounds == 0)
                    begin = int(sizes[:a].sum())
                    some = np.repeat(take, sizes[a:b])
                    flat = numbers[begin : begin + len(some)][some]
                    if len(flat):
                        outs = outcomes[flat]
                        own.train(Contexts(hashes[flat], outs, places(sizes[a:b][take]), size, depth), outs, own_priors)
            salt = TaskContext.get().partitionId() % sqrt
            moved = np.concatenate(own.moved)
            own.squares = []
            change = flat_weights(own.tables)
            change -= flat_weights(tables)
            for k, (m, d) in enumerate(zip(np.array_split(moved, SEGMENTS), np.array_split(change, SEGMENTS))):
                yield batch(schema, segment=[k], salt=[salt], moved=[m.tobytes()], change=[(d * m[:, None]).tobytes()])

        def add(table: pa.Table) -> pa.Table:
            moved = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in table.column("moved").to_pylist())
            change = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in table.column("change").to_pylist())
            return pa.table(
                {"segment": table.column("segment")[:1], "salt": table.column("salt")[:1], "moved": pa.array([moved.astype(np.float32).tobytes()], pa.binary()), "change": pa.array([change.astype(np.float32).tobytes()], pa.binary())}
            )

        ddl = "segment int, salt int, moved binary, change binary"
        part = data.mapInArrow(work, ddl).groupBy("segment", "salt").applyInArrow(add, ddl)
        rows = {r["segment"]: r for r in part.groupBy("segment").applyInArrow(add, ddl).collect()}
        shared.destroy()
        if rows:
            moved = np.concatenate([np.frombuffer(rows[k]["moved"], np.float32) for k in range(SEGMENTS)])
            change = np.concatenate([np.frombuffer(rows[k]["change"], np.float32) for k in range(SEGMENTS)]).reshape(len(moved), -1)
            change = np.split(change / np.maximum(moved, 1)[:, None], np.cumsum([len(t) for t in weights.tables])[:-1])
            weights = Weights(tables=[t + c[:, : t.shape[1]] for t, c in zip(weights.tables, change)])
    return weights


def flat_weights(tables: list[np.ndarray]) -> np.ndarray:
    """The tables below each other, of equal width."""
    width = max(t.shape[1] for t in tables)
    return np.vstack([np.pad(t, ((0, 0), (0, width - t.shape[1]))) for t in tables])


def lm_scores(docs: DataFrame, rounds: int = ROUNDS, worker_tokens: int = WORKER_TOKENS) -> DataFrame:
    """Score every text by a model learnt from those not held out.

    Held out are documents whose crc32 of the id as text leaves 1 modulo 5. Returns
    doc_id, held_out, n_tokens (words and the end), n_known (of these, met in training),
    train_tokens, base_score (the log10 probability of single words, with 0.5 added to
    their counts) and score (that of the model). A word not met in training counts as
    the unknown word of its class and slot. Words go by a 64-bit hash. Texts are scored
    whole, however long; repeated rows are scored, and learnt from, each. Null texts are empty, a null id is not held
    out. Without training texts the base is 0. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))
    blocks = stage(docs.select(id_of().alias("doc_id"), out.alias("held"), text_of().alias("text")).mapInArrow(encode, BLOCK_DDL), "blocks", **BLOCK_FILES)
    words = blocks.select(F.explode(F.arrays_zip("hashes", "counts", "outcomes")).alias("col")).select("col.*")
    counts = stage(
        words.filter("counts > 0").groupBy("hashes").agg(F.sum("counts").alias("count"), F.any_value("outcomes").alias("outcome")), "words"
    )
    v = counts.count()
    depth = depth_of(v)
    # As many rows as leaves at most.
    totals = counts.groupBy("outcome", F.shiftrightunsigned("hashes", 64 - 4 * depth).alias("leaf")).agg(
        F.sum("count").alias("count"), F.count("*").alias("types")
    ).orderBy("outcome", "leaf").toArrow()
    got = [totals.column(c).to_numpy() for c in ("outcome", "count", "types", "leaf")]
    n = int(got[1].sum())
    # Sent once for all rounds and the scores.
    priors = spark.sparkContext.broadcast(tuple(Priors.of(*got, depth)))
    del totals, got
    shared = spark.sparkContext.broadcast(trained(blocks, priors, n, depth, rounds, worker_tokens).tables)
    size = int(ROWS * growth(n))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )

    def score(block: pa.Table, answers: pa.Table) -> pa.Table:
        own_priors = Priors(*priors.value)
        model = Weights(tables=shared.value, trains=False)
        sums = sorted(zip(answers.column("shard").to_pylist(), answers.column("n").to_pylist()))
        sums = np.concatenate([unpacked(x, np.int64) for _, x in sums])
        out = []
        for ids, sizes, held, numbers, outcomes, hashes in rows_of(block.select(SCORED).to_batches()):
            hashes = hashes.view(np.uint64)
            met = np.empty(len(hashes), np.int64)
            met[np.argsort(hashes)] = sums
            for a, b in stretches(sizes):
                begin = int(sizes[:a].sum())
                part = sizes[a:b].astype(np.int64)
                here = slice(begin, begin + int(part.sum()))
                flat = numbers[here]
                outs, count = outcomes[flat], met[flat]
                first = np.cumsum(part) - part
                base = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))
                context = Contexts(hashes[flat], outs, places(part), size, depth)
                logs = model.logs(context, outs, own_priors) + own_priors.of_words(hashes[flat], outs, count)
                logs += model.digit_logs(context, (outs > 0) & (count > 0), own_priors)
                out.append(batch(
                    schema, doc_id=ids[a:b], held_out=held[a:b], n_tokens=part,
                    n_known=np.add.reduceat((count > 0).astype(np.int64), first), train_tokens=np.full(len(part), n, np.int64),
                    base_score=np.add.reduceat(base, first), score=np.add.reduceat(logs, first) / np.log(10),
                ))
        return pa.Table.from_batches(out, schema)

    return (
        blocks.select("block", *SCORED)
        .groupBy("block")
        .cogroup(word_counts(blocks, n).groupBy("block"))
        .applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
        .withColumn("doc_id", id_back("doc_id"))
    )
