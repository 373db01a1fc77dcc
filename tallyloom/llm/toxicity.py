"""Toxicity by weak supervision.

Units of words (the word, and its beginnings) that a bounded sample of labelled
documents shows far more often in toxic ones form lexicons. Many voters, of lexicons
and of patterns, vote on the sampled documents. A generative label model estimates how
often each voter speaks up given either class and how voters are correlated beyond
that, and gives each document a posterior label, the given label being one more
imperfect voter. A linear classifier trained on the posterior labels scores documents
by their words alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import batch, bounded_batches, id_of, text_of
from tallyloom.sources.tables import stage

# Bounds of the fitted model; scoring, and nothing else, reads all documents.
SAMPLE = 20_000
UNITS = 512
THRESHOLD = 0.7

BUCKETS = 1 << 20
BEGINNINGS = range(4, 9)
GROUPS = 24
SEEN = 20.0  # smallest likelihood ratio statistic of a lexicon unit
LIFT = 3.0
LETTERS = re.compile(r"[^\W\d_]+")
LABEL_ERROR = 0.1
REPEATED = 1 << 19  # marks units that occur twice or more


def units_of(word: str) -> list[int]:
    """Buckets of a word and of its beginnings."""
    names = ["=" + word] + [word[:n] for n in BEGINNINGS if n <= len(word)]
    return [xxhash.xxh32_intdigest(n.encode()) % REPEATED for n in names]


class Units(dict):
    """Buckets of a word's units, remembered."""

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= 1 << 17:
            self.clear()
        self[word] = found = units_of(word)
        return found


class Lexicon:
    """Selected units and their log odds."""

    def __init__(self, units: dict[int, float]) -> None:
        self.place = {u: i for i, u in enumerate(sorted(units))}
        self.weights = np.array([units[u] for u in sorted(units)])
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= 1 << 18:
                self.known.clear()
            place = self.place
            # A unit is selected as met once, as met repeatedly, or both.
            keys = [k for u in units_of(word) for k in (u, u + REPEATED) if k in place]
            found = self.known[word] = tuple(place[k] for k in keys)
        return found


class Seen(NamedTuple):
    """What a text shows: words, hits (words with a unit), weight of the hits, how often
    each unit was met, shouted share, runs of marks."""

    words: int
    hits: int
    weight: float
    units: Counter
    shouted: float
    marks: int


def seen(text: str, lexicon: Lexicon) -> Seen:
    words = LETTERS.findall(text.lower())
    found = [h for h in map(lexicon.of, words) if h]
    units = Counter(u for h in found for u in h)
    weight = sum(max(lexicon.weights[u] for u in h) for h in found)
    upper = sum(map(str.isupper, text)) if found else 0
    marks = text.count("!!") + text.count("??") if found else 0
    return Seen(len(words), len(found), float(weight), units, upper / max(1, len(text)), marks)


def per_hundred(n: float, words: int) -> float:
    """Rate in a text; short texts count as of fifty words. Any long text meets a unit by
    chance now and then, so rates and not numbers tell toxic texts apart."""
    return 100.0 * n / max(50, words)


def features(s: Seen, size: int) -> np.ndarray:
    """One number per unit, then those of the whole text."""
    x = np.zeros(size + EXTRA, np.float32)
    for u, n in s.units.items():
        x[u] = np.log1p(per_hundred(n, s.words))
    rate, weight = per_hundred(s.hits, s.words), per_hundred(s.weight, s.words)
    x[size:] = (
        np.log1p(rate), min(rate, 3.0), rate >= 0.7, rate >= 1.1, rate >= 1.5, s.hits >= 1, s.hits >= 2,
        s.hits >= 3, np.log1p(weight), min(weight, 15.0), np.log1p(s.words) / 5,
    )
    return x


EXTRA = 11


def votes(s: Seen, size: int) -> np.ndarray:
    """1 where a voter speaks up: lexicons by their units, then patterns."""
    v = np.zeros(GROUPS + len(PATTERNS), np.int8)
    least = max(1.0, s.words / 800)
    met = Counter()
    for u, n in s.units.items():
        met[u % GROUPS] += n
    for g, n in met.items():
        v[g] = n >= least
    rate, weight = per_hundred(s.hits, s.words), per_hundred(s.weight, s.words)
    v[GROUPS:] = [bool(p(s, rate, weight)) for p in PATTERNS]
    return v


PATTERNS = (
    lambda s, rate, weight: rate >= 0.5,
    lambda s, rate, weight: rate >= 1.0 and s.hits >= 2,
    lambda s, rate, weight: rate >= 1.5 and s.hits >= 2,
    lambda s, rate, weight: rate >= 2.5,
    lambda s, rate, weight: s.hits >= 3 and rate >= 0.8,
    lambda s, rate, weight: s.hits >= 6 and rate >= 0.8,
    lambda s, rate, weight: weight >= 4,
    lambda s, rate, weight: weight >= 8,
    lambda s, rate, weight: len(s.units) >= 4 and rate >= 0.8,
    lambda s, rate, weight: s.hits >= 1 and s.shouted > 0.4,
    lambda s, rate, weight: s.hits >= 1 and s.marks >= 3,
    lambda s, rate, weight: s.hits == 0,
)


class LabelModel(NamedTuple):
    """How often voters speak up in toxic and in clean documents, and what each vote
    counts for: less, the more a voter is correlated with others given the class."""

    prior: float
    toxic: np.ndarray
    clean: np.ndarray
    share: np.ndarray

    def logits(self, v: np.ndarray) -> np.ndarray:
        up = np.log(self.toxic / self.clean) * self.share
        down = np.log((1 - self.toxic) / (1 - self.clean)) * self.share
        return np.log(self.prior / (1 - self.prior)) + v @ up + (1 - v) @ down

    @staticmethod
    def fit(v: np.ndarray, start: np.ndarray, rounds: int = 25, given: bool = False) -> tuple[LabelModel, np.ndarray]:
        """Expectation maximisation from the posteriors given. If the last voter is a
        ``given`` label, at most ``LABEL_ERROR`` of the labels of a class are taken to be
        wrong, and it counts whole."""
        q = start
        for _ in range(rounds):
            prior = float(np.clip(q.mean(), 0.001, 0.999))
            toxic = np.clip((q @ v + 0.5) / (q.sum() + 1), 0.001, 0.999)
            clean = np.clip(((1 - q) @ v + 0.5) / ((1 - q).sum() + 1), 0.001, 0.999)
            if given:
                toxic[-1], clean[-1] = max(toxic[-1], 1 - LABEL_ERROR), min(clean[-1], LABEL_ERROR / 10)
            rest = v - np.outer(q, toxic) - np.outer(1 - q, clean)
            covariance = rest.T @ rest / len(v)
            spread = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
            # Voters that speak up together count for less; the posteriors themselves make
            # strong voters look opposed to each other, which is left out.
            correlation = np.maximum(covariance / np.outer(spread, spread), 0)
            np.fill_diagonal(correlation, 0)
            correlation[correlation < 0.1] = 0
            share = 1 / (1 + correlation.sum(1))
            if given:
                share[-1] = 1.0
            model = LabelModel(prior, toxic, clean, share)
            new = 1 / (1 + np.exp(-np.clip(model.logits(v), -30, 30)))
            if np.abs(new - q).max() < 1e-4:
                return model, new
            q = new
        return model, q


class Classifier(NamedTuple):
    lexicon: dict[int, float]
    weights: np.ndarray
    base: float

    def scores(self, texts: list[str], lexicon: Lexicon) -> np.ndarray:
        size = len(self.lexicon)
        x = np.stack([features(seen(t, lexicon), size) for t in texts]) if texts else np.zeros((0, size + EXTRA))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.base, -30, 30)))


def logistic(x: np.ndarray, q: np.ndarray, ridge: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and base of a logistic regression on soft labels, by accelerated
    gradient steps."""
    mean, spread = x.mean(0), x.std(0) + x.dtype.type(0.05)
    z = (x - mean) / spread
    n = len(q)
    p = float(q.mean())
    w, base = np.zeros(z.shape[1]), float(np.log(p / (1 - p)))
    step = 1 / (0.25 * float(np.linalg.eigvalsh((z.T @ z).astype(float) / n)[-1]) + ridge + 0.25)
    old_w, old_base = w, base
    for k in range(rounds):
        push = k / (k + 3)
        at, at_base = w + push * (w - old_w), base + push * (base - old_base)
        miss = (1 / (1 + np.exp(-np.clip(z @ at.astype(z.dtype) + at_base, -30, 30))) - q) / n
        old_w, old_base = w, base
        w, base = at - step * (miss.astype(z.dtype) @ z + ridge * at), at_base - step * miss.sum()
    w = w / spread
    return w, base - float(mean @ w)


def bit(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1: the documents held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """text and label of at most ``rows`` labelled documents that are not held out, by
    the hash of their ids."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.avg(F.col("toxic").cast("double")).alias("toxic"))
        .filter("toxic <> 0.5")
        .filter(~bit(F.col("doc_id")))
    )
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id", (F.col("toxic") > 0.5).cast("int").alias("toxic"))
    # At most ``rows`` rows of two numbers: bounded, so they are broadcast.
    found = docs.select(id_of().alias("doc_id"), text_of().alias("text")).join(F.broadcast(drawn), "doc_id")
    # Of rows that share an id the smallest text is taken, so the bound holds.
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def lexicon_of(sample: DataFrame, units: int) -> dict[int, float]:
    """Units that toxic documents of the sample show far more often, with log odds."""
    schema = pa.schema([("unit", pa.int32()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, BUCKETS), np.int64)
        buckets, total = Units(), [0, 0]
        for r in rows:
            for text, y in zip(r.column(0).to_pylist(), r.column(1).to_pylist()):
                words = LETTERS.findall(text.lower())
                if words:
                    found, n = np.unique(np.concatenate([buckets[w] for w in words]), return_counts=True)
                    count[y, found] += 1
                    count[y, found[n > 1] + REPEATED] += 1
                total[y] += 1
        some = np.flatnonzero(count.any(axis=0))
        yield batch(schema, unit=some.astype(np.int32), toxic=count[1, some], clean=count[0, some])
        yield batch(schema, unit=[-1], toxic=[total[1]], clean=[total[0]])

    counts = stage(sample.mapInArrow(run, "unit int, toxic long, clean long").groupBy("unit").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")), "units")
    whole = counts.filter("unit = -1").first()
    if not whole or not whole["t"] or not whole["c"]:
        return {}
    all_t, all_c = float(whole["t"]), float(whole["c"])
    n, p = F.col("t") + F.col("c"), all_t / (all_t + all_c)
    log = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
    statistic = 2 * (
        log(F.col("t"), n * p) + log(F.col("c"), n * (1 - p))
        + log(all_t - F.col("t"), (all_t + all_c - n) * p) + log(all_c - F.col("c"), (all_t + all_c - n) * (1 - p))
    )
    odds = F.log((F.col("t") + 0.5) / (F.col("c") + 0.5)) - float(np.log(all_t / all_c))
    best = (
        counts.filter("unit >= 0")
        .select("unit", statistic.alias("g"), odds.alias("odds"))
        .filter((F.col("g") >= SEEN) & (F.col("odds") >= float(np.log(LIFT))))
        .orderBy(F.desc("g"), "unit")
        .limit(units)
    )
    return {r["unit"]: r["odds"] for r in best.collect()}


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, units: int = UNITS) -> Classifier:
    """A classifier learnt from at most ``sample`` labelled documents not held out.

    Without labels of both classes it scores all texts alike.
    """
    bounded_batches(docs.sparkSession)
    drawn = stage(labelled_sample(docs, labels, sample).repartition(8), "sample")
    lexicon = lexicon_of(drawn, units)
    size = len(lexicon)
    schema = pa.schema([("toxic", pa.int32()), ("votes", pa.binary()), ("features", pa.binary())])

    def show(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lexicon(lexicon)
        for r in rows:
            found = [seen(t, known) for t in r.column(0).to_pylist()]
            yield batch(
                schema, toxic=r.column(1), votes=[votes(s, size).tobytes() for s in found],
                features=[features(s, size).tobytes() for s in found],
            )

    rows = drawn.mapInArrow(show, "toxic int, votes binary, features binary").toArrow()
    y = rows.column("toxic").to_numpy()
    if not size or not len(y):
        share = (y.sum() + 0.5) / (len(y) + 10)
        return Classifier({}, np.zeros(EXTRA), float(np.log(share / (1 - share))))
    v, x = numbers_of(rows.column("votes"), np.int8, len(y)).astype(float), numbers_of(rows.column("features"), np.float32, len(y))
    v = np.column_stack([v, y])  # the given label is a voter, too
    _, q = LabelModel.fit(v, np.where(y == 1, 0.95, 0.05), given=True)
    w, base = logistic(x, q, ridge=2e-3)
    return Classifier(lexicon, w, base)


def numbers_of(column: pa.ChunkedArray, kind: type, rows: int) -> np.ndarray:
    """Rows of numbers from binary values of equal size, without copies of each."""
    whole = column.combine_chunks()
    whole = whole if isinstance(whole, pa.Array) else pa.concat_arrays(whole.chunks)
    first, last = (int(np.frombuffer(whole.buffers()[1], np.int32)[whole.offset + i]) for i in (0, rows))
    return np.frombuffer(whole.buffers()[2], np.uint8)[first:last].view(kind).reshape(rows, -1)


def score_column(model: Classifier, text: str = "text") -> Column:
    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = Lexicon(model.lexicon)
        for part in parts:
            found = [model.scores(part.iloc[i : i + 500].tolist(), lexicon) for i in range(0, len(part), 500)]
            yield pd.Series(np.concatenate(found) if found else [], dtype="float64")

    return score(text_of(text))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """Scores of all documents: doc_id, held_out, score (0 to 1), predicted (score at
    least ``threshold``).

    Only labels of documents that are not held out are learnt from, and only the text
    is scored. Null and empty texts get the score of a text without words. Labels that
    are null, or that contradict each other evenly, are not used; a null id is not held
    out. An empty table gives no rows.
    """
    model = fit_toxicity(docs, labels, **how)
    return docs.select("doc_id", bit(F.col("doc_id")).alias("held_out"), score_column(model).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """The documents that score below the threshold, all columns as they are."""
    return docs.filter(score_column(fit_toxicity(docs, labels, **how)) < threshold)
