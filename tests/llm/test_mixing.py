import random
from collections import Counter, defaultdict

import pytest

from oracle_check import connect, differences
from tallyloom.llm.mixing import label_quality, mix, mixed_documents

SCHEMA = "doc_id long, text string, source string, size string"


def docs(seed, n=400):
    rng = random.Random(seed)
    names = ["hot"] * 5 + ["b", "a", "é", "Z", None, "tiny"]
    out = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(names), "x") for i in range(n)]
    return [(i, t if s != "tiny" else t[:1], s, x) for i, t, s, x in out] + [(None, "a b", "b", None), (n, None, "none", None), (5, "same", "a", None), (5, "same", "a", None)]


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), share * sum(sizes.values())
    while True:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total >= most * sizes[s]}
        if not over:
            return out | {s: left * w[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
        if not open_:
            return out


@pytest.mark.parametrize("seed", range(2))
def test_targets_are_met(spark, seed):
    rows = docs(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = mix(df, bucket_rows=7).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    want = targets(sizes)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) < 1
    again = mix(df.repartition(3), bucket_rows=100).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    # Complete epochs before the fractional selection: no text is passed over by one
    # that is taken twice more.
    per = defaultdict(set)
    for r in got:
        if r.size:
            per[r.source].add(r.taken // r.size)
    assert all(max(x) - min(x) <= 1 for x in per.values())


def test_quality_raises_the_share(spark):
    df = spark.createDataFrame([(i, "w " * 10, "a", "") for i in range(2000)] + [(i, "w " * 10, "b", "") for i in range(2000, 4000)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)] + [(None, 1), (1, None)], "doc_id long, quality int")
    rows = mix(df, label_quality(labels), weights=(3, 5)).collect()
    # One eighth of an epoch of the first source is drawn at weights 2 and 0.5.
    part = [r for r in rows if r.source == "a"]
    good, all_ = sum(r.part for r in part if r.doc_id % 2), sum(r.part for r in part)
    assert all_ == 2500 and 0.7 * all_ < good < 0.9 * all_


def test_empty_and_copies_of_documents(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame(docs(3), SCHEMA)
    out = mixed_documents(df)
    assert out.columns == df.columns
    size = {r.source: r.target for r in mix(df).collect()}
    got = Counter()
    for r in out.collect():
        got[r.source] += len((r.text or "").split())
    assert all(abs(got[s] - t) <= 31 for s, t in size.items())


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(spark, connect(sf), sf, "op5_source_mixing") == []
