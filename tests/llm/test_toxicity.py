import random
import zlib

import numpy as np

from tallyloom.llm.catalog import QUERIES
from tallyloom.llm.toxicity import LabelModel, clean_documents, lexicon_of, logistic, toxicity

DOCS = "doc_id long, text string, score string, held_out int"
LABELS = "doc_id long, quality int, toxic int"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 1


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 200))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(3):
                words.insert(rng.randint(0, len(words)), rng.choice(["Dolt!!", "NITWIT", "oafx" + rng.choice("abcdef"), "oafx" + rng.choice("ghijk")]))
        docs.append((i, " ".join(words), "s", 1))
        labels.append((i, 0, int(toxic)))
    return docs, labels


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus()
    docs += [(5000, None, None, None), (5001, "", "", 0), (None, "dolt nitwit oafxa dolt", "x", 0), docs[0], (5002, "word " * 50000 + "dolt nitwit dolt", "", 0)]
    noisy = labels + [(1, 0, None), (None, 0, 1), (2, 1, 0), (2, 1, 1)]
    df, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(noisy, LABELS)
    got = toxicity(df, lab).collect()
    assert len(got) == len(docs)
    truth = {i: t for i, _, t in labels}
    seen = [r for r in got if r.doc_id in truth and r.held_out]
    assert all(r.held_out == held(r.doc_id) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    right = sum(r.predicted == truth[r.doc_id] for r in seen)
    assert len(seen) > 200 and right >= 0.98 * len(seen)
    by = {r.doc_id: r for r in got}
    assert by[5000].predicted == by[5001].predicted == 0 and by[5000].score == by[5001].score
    assert by[None].predicted == 1
    kept = clean_documents(df, lab)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_labels_of_held_out_documents_are_not_used(spark):
    docs, labels = corpus(400, 3)
    turned = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    df = spark.createDataFrame(docs, DOCS)
    a, b = (sorted((r.doc_id, r.score) for r in toxicity(df, spark.createDataFrame(x, LABELS)).collect()) for x in (labels, turned))
    assert a == b


def test_without_labels_or_rows(spark):
    docs, labels = corpus(30)
    none = spark.createDataFrame([], LABELS)
    got = toxicity(spark.createDataFrame(docs, DOCS), none).collect()
    assert len(got) == 30 and len({r.score for r in got}) == 1
    assert toxicity(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).count() == 0
    one = [(i, q, 0) for i, q, _ in labels]
    assert {r.predicted for r in toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(one, LABELS)).collect()} == {0}


def test_lexicon_counts_are_those_of_brute_force(spark):
    rows = [("dolt good day", 1)] * 20 + [("good day", 0)] * 60
    found = lexicon_of(spark.createDataFrame(rows, "text string, toxic int").repartition(3), 50)
    assert len(found) == 2  # the word and its beginning of four letters
    odds = np.log(20.5 / 0.5) - np.log(20 / 60)
    assert np.allclose(list(found.values()), odds)


def test_label_model_finds_accuracies_and_doubles():
    rng = np.random.default_rng(2)
    y = rng.random(6000) < 0.3
    hit, false = [0.9, 0.6, 0.7, 0.5, 0.8], [0.05, 0.1, 0.02, 0.3, 0.1]
    v = np.stack([np.where(y, rng.random(6000) < h, rng.random(6000) < f) for h, f in zip(hit, false)], 1).astype(float)
    v = np.column_stack([v, v[:, 3], v[:, 3]])  # one voter three times
    model, q = LabelModel.fit(v, np.where(v[:, 0] == 1, 0.8, 0.2))
    assert np.abs(model.toxic[:5] - hit).max() < 0.05 and np.abs(model.clean[:5] - false).max() < 0.05
    assert abs(model.prior - 0.3) < 0.03 and ((q > 0.5) == y).mean() > 0.93
    assert model.share[3] < 0.4 < 0.8 < model.share[0]


def test_logistic_regression():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 3))
    q = 1 / (1 + np.exp(-(x @ np.array([2.0, -1.0, 0.0]) + 0.5)))
    w, base = logistic(x, q, 1e-6, 2000)
    assert np.allclose(w, [2, -1, 0], atol=0.05) and abs(base - 0.5) < 0.05


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op3_toxicity"](spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    bad, good = [s for s, t in out if t], [s for s, t in out if not t]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in bad for b in good]) > 0.85
