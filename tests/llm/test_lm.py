import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm.catalog import QUERIES
from tallyloom.llm import lm
from tallyloom.llm.common import mixed
from tallyloom.llm.lm import CLASS_ROWS, CLASSES, DIGIT_ROWS, RATE, ROWS, SLOT_ROWS, SLOTS, Contexts, Priors, Weights, lm_scores, outcome_of
from tallyloom.sources.tables import stage

DOCS = "doc_id long, text string, score string"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")) + [None]


def brute(rows):
    """What does not come from the weights."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    count = Counter(t for (_, x), h in zip(rows, held) if not h for t in tokens(x))
    n, v = sum(count.values()), len(count)
    out = []
    for (i, x), h in zip(rows, held):
        own = tokens(x)
        base = sum(math.log10((count[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        out.append((i, h, len(own), sum(count[t] > 0 for t in own), n, round(base, 6)))
    return sorted(out, key=repr)


def ours(rows):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=repr)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op2_lm_scores"](spark, sf).collect()
    assert ours(got) == brute(rows)
    out = [r for r in got if r.held_out]
    per = sum(r.n_tokens for r in out)
    assert sum(r.score for r in out) / per > sum(r.base_score for r in out) / per + 0.05
    assert all(r.score <= 0 for r in got)


def test_odd_rows(spark):
    rows = [(i, " ".join(random.Random(i).choice("a b c d E f".split()) for _ in range(i))) for i in range(40)]
    rows += [(None, "A b"), (50, None), (51, ""), (52, "zz yy"), rows[3], (53, "w " * 30000)]
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], DOCS).repartition(3)
    assert ours(lm_scores(df).collect()) == brute(rows)
    assert lm_scores(spark.createDataFrame([], DOCS)).count() == 0
    only = [(i, "a b", "s") for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    got = lm_scores(spark.createDataFrame(only, DOCS)).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and np.isfinite(r.score) for r in got)


@pytest.fixture
def trained():
    rng = np.random.default_rng(1)
    words = [f"w{i}".encode() for i in range(60)]
    outcomes = np.array([0] + [outcome_of(w) for w in words])
    count = np.concatenate([[50.0], rng.integers(1, 100, 60)])
    types = np.ones(61)
    sums = {o: (count[outcomes == o].sum(), (outcomes == o).sum()) for o in set(outcomes)}
    keys = np.array(sorted(sums))
    priors = Priors.of(keys, np.array([sums[k][0] for k in keys]), np.array([sums[k][1] for k in keys]))
    model = Weights()
    model.prepare()
    flat = rng.integers(0, 61, 5000)
    hashes = rng.integers(0, 2**63, 61).astype(np.uint64)
    c = Contexts(hashes[flat], outcomes[flat], np.arange(5000) % 50)
    model.train(c, outcomes[flat], priors)
    return model, priors, outcomes, hashes, count, types


def test_probabilities_add_up_to_one(trained):
    """Over all words, and the unknown word of every slot, after any context."""
    model, priors, outcomes, hashes, count, _ = trained
    before = np.array([7, 9, 11])
    total = 0.0
    every = [(o, math.log((n + 0.5) / priors.mass[o]) if o else 0.0, h) for o, n, h in zip(outcomes, count, hashes)]
    every += [(o, math.log(0.5 / priors.mass[o]), np.uint64(5)) for o in range(SLOTS, CLASSES * SLOTS)]
    for o, inside, h in every:
        seq = np.append(outcomes[before], o)
        c = Contexts(np.append(hashes[before], h), seq, np.arange(4))
        total += math.exp(model.logs(c, seq, priors)[3] + inside)
    assert total == pytest.approx(1, abs=1e-4)


def test_training_lowers_the_loss():
    rng = np.random.default_rng(2)
    flat = np.zeros(20000, np.int64)
    for i in range(1, len(flat)):
        flat[i] = (flat[i - 1] * 7 + 1) % 40 if rng.random() < 0.8 else rng.integers(0, 40)
    outcomes = np.array([outcome_of(f"x{i}".encode()) for i in range(40)])
    keys, n = np.unique(outcomes[flat], return_counts=True)
    priors = Priors.of(keys, n.astype(float), np.ones(len(keys)))
    hashes = rng.integers(0, 2**63, 40).astype(np.uint64)
    c = Contexts(hashes[flat], outcomes[flat], np.arange(len(flat)))
    before, after = Weights(), Weights()
    after.prepare()
    after.train(c, outcomes[flat], priors)
    assert after.classes.shape == (CLASS_ROWS, CLASSES) and after.slots.shape == (SLOT_ROWS, SLOTS)
    assert after.logs(c, outcomes[flat], priors).mean() > before.logs(c, outcomes[flat], priors).mean() + 0.5


@pytest.mark.parametrize("shard_tokens", [1 << 19, 50])
def test_context_tells_words_of_a_slot_apart(spark, monkeypatch, shard_tokens):
    """Two words of one class and slot, equally frequent, each after a word of its own."""
    monkeypatch.setattr(lm, "SHARD_TOKENS", shard_tokens)
    of = outcome_of(b"w0ing")
    x, y = [w for w in (f"w{i}ing" for i in range(9999)) if outcome_of(w.encode()) == of][:2]
    own = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 != 1][:400]
    held = [i for i in range(600, 700) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    rows = [(i, f"qq {y} zz" if k % 2 else f"pp {x} zz") for k, i in enumerate(own)]
    rows += [(held[0], f"pp {x} zz"), (held[1], f"pp {y} zz")]
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], DOCS).repartition(3)
    got = {r.doc_id: r.score for r in lm_scores(df).collect()}
    assert got[held[0]] > got[held[1]] + 0.5


def features(words, k, level, path):
    """Keys of the weight rows of a token, by a scalar hash."""
    def back(j):
        return xxhash.xxh3_64_intdigest(words[k - j].encode()) if k >= j else 0

    def kind(j):
        return outcome_of(words[k - j].encode()) // SLOTS + 1 if k >= j else 0

    def row(x, rows=ROWS):
        return (int(mixed(np.array([x % 2**64], np.uint64))[0]) >> 40) * rows >> 24

    odd, own = 0x9E3779B97F4A7C15, path[0]
    if level == 0:
        keys = [back(1), back(1) * odd + back(2), kind(1) * (CLASSES + 1) + kind(2), back(2) + 2, back(3) + 3]
        return [(level, f, row(x)) for f, x in enumerate(keys)]
    if level == 1:
        slot = outcome_of(words[k - 1].encode()) % SLOTS if k and kind(1) == own + 1 else None
        return [(level, 0, row(back(1) * odd + own)), (level, 1, row(kind(1) * 2**20 + kind(2) * 2**10 + own)), (level, 2, slot)]
    before = 0
    for d in [own * SLOTS + path[1], *path[2:level]]:
        before = before * 16 + d
    return [(level, 0, row(back(1) * odd + before + level - 2, DIGIT_ROWS * ROWS))]


def path_of(word):
    h = xxhash.xxh3_64_intdigest(word.encode())
    return [*divmod(outcome_of(word.encode()), SLOTS), h >> 60, h >> 56 & 15]


def test_trained_score_against_plain_loops(spark):
    """Softmaxes, steps and scores word by word over dictionaries of weights."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("a b c d e f g big fig".split()) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], DOCS).coalesce(1)
    got = {r.doc_id: r.score for r in lm_scores(df).collect()}
    texts = [(zlib.crc32(str(i).encode()) % 5 == 1, [t or " " for t in tokens(x)]) for i, x in rows]
    count = Counter(w for held, words in texts if not held for w in words)
    share = Counter()
    for w, n in count.items():
        path = path_of(w)
        for level in range(5):
            share[tuple(path[:level])] += n + 0.5 * (w != " ")
    for o in range(1, CLASSES * SLOTS):  # unknown words
        share[()] += 0.5
        share[(o // SLOTS,)] += 0.5
    share[(0,)] = count[" "]
    share[()] -= 0.5 * (SLOTS - 1)
    mass = lambda o: share[o] + 0.5
    inner = lambda c: sum(mass((c, d)) for d in range(SLOTS))
    weights = {}

    def shares(words, k, level, path):
        rows_ = features(words, k, level, path)
        if level == 0:
            prior = [share[(c,)] if c == 0 else inner(c) for c in range(CLASSES)]
        elif level == 1:
            prior = [mass((path[0], d)) for d in range(SLOTS)]
        else:
            prior = [share[(*path[:level], d)] for d in range(16)]
        total = [x * math.exp(sum(weights.get((r, d), 0.0) for r in rows_)) for d, x in enumerate(prior)]
        return rows_, [x / sum(total) for x in total]

    for turn in range(2):
        step = []
        for j, (held, words) in enumerate(texts):
            if not held and (j + turn) % 2 == 0:
                for k, w in enumerate(words):
                    path = path_of(w)
                    step += [(shares, words, k, level, path) for level in range(1 if w == " " else 4)]
        for level in range(4):
            slope = Counter()
            for _, words, k, own, path in step:
                if own == level:
                    rows_, p = shares(words, k, level, path)
                    for r in rows_:
                        for d in range(16):
                            slope[r, d] += p[d] - (d == path[level])
            for key, g in slope.items():
                weights[key] = weights.get(key, 0.0) - RATE * g / math.sqrt(1 + g * g)
    for (i, _), (_, words) in zip(rows, texts):
        want = 0.0
        for k, w in enumerate(words):
            path = path_of(w)
            for level in range(1 if w == " " else 4):
                if level < 2 or count[w]:
                    want += math.log10(shares(words, k, level, path)[1][path[level]])
            if w != " ":
                unknown = 0.5 / mass(tuple(path[:2]))
                want += math.log10((count[w] + 0.5) / share[tuple(path)] * (1 - unknown) if count[w] else unknown)
        assert got[i] == pytest.approx(want, abs=0.02)


def test_what_is_learnt_grows_with_the_corpus():
    sizes = [lm.growth(n) for n in (0, 10**7, 10**9, 10**13)]
    assert sizes[0] == 1 and sizes == sorted(sizes) and sizes[3] > 100
    assert [lm.depth_of(v) for v in (0, 16**4, 16**6, 16**8)] == [2, 3, 4, 5]
    assert Weights(4096, 3).tables[2].shape == (4 * 4096, 16)


def test_blocks_lie_in_row_groups_of_few(spark, monkeypatch):
    """A reader holds a row group: all blocks of a task were one."""

    class Staged(Exception):
        pass

    def staged(df, label, **options):
        raise Staged(stage(df, label, **options).inputFiles())

    monkeypatch.setattr(lm, "stage", staged)
    text = " ".join(f"w{i}" for i in range(1 << 15)) + " "
    df = spark.range(6, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit(text), 32).alias("text"))
    with pytest.raises(Staged) as found:
        lm_scores(df)
    metas = [pq.read_metadata(f.removeprefix("file:").replace("///", "/")) for f in found.value.args[0]]
    assert sum(m.num_rows for m in metas) == 6
    assert all(m.row_group(i).num_rows <= 2 for m in metas for i in range(m.num_row_groups))


def test_the_largest_priors_are_held_once():
    outcome, leaf = np.repeat(np.arange(16, 40), 50), np.tile(np.arange(50) * 5, 24)
    count, types = np.arange(1, 1201), np.ones(1200, np.int64)
    priors = Priors.of(outcome, count, types, leaf, 2)
    assert sum(x.nbytes for x in priors.digits) < 1.1 * 4 * CLASSES * SLOTS * 16**2
    known = np.exp(priors.digits[-1].ravel().astype(float))
    assert known[outcome * 16**2 + leaf] == pytest.approx(count + 0.5, rel=1e-6) and known.sum() == pytest.approx((count + 0.5).sum())
    met = priors.of_words((leaf.astype(np.uint64) << np.uint64(56)), outcome, count)
    own = np.log1p(-0.5 / priors.mass[outcome])
    assert met == pytest.approx(own, abs=1e-6)  # a word alone in its leaf
