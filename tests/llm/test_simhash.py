import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from tallyloom.llm import simhash
from tallyloom.llm.catalog import QUERIES
from tallyloom.llm.common import components
from tallyloom.llm.simhash import GrayTree, one_of_each, print_links, simhash_groups

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def print_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    """Rows with a shared id count as linked."""
    ids = [-(2**63) if i is None else i for i, _ in rows]
    prints = [print_of(t) for _, t in rows]
    label = list(ids)
    while True:
        before = list(label)
        for i in range(len(rows)):
            for j in range(len(rows)):
                if ids[i] == ids[j] or bin(prints[i] ^ prints[j]).count("1") <= 3:
                    label[i] = min(label[i], label[j])
        if label == before:
            break
    back = lambda x: None if x == -(2**63) else x
    return sorted(((i, f"{p:016x}", back(c)) for (i, _), p, c in zip(rows, prints, label)), key=repr)


def ours(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert ours(QUERIES["op9_simhash_groups"](spark, sf)) == brute(rows)


def test_odd_rows(spark):
    rng = random.Random(5)
    base = [rng.choice("abcdefghijk") * rng.randint(1, 3) for _ in range(200)]
    rows = [(i, " ".join(base[:k] + ["X"] + base[k:])) for i, k in enumerate(range(0, 60, 3))]
    rows += [(50, None), (51, ""), (52, "one"), (53, "ONE two"), (53, "one"), (None, "one"), (54, " \n"), rows[0]]
    df = spark.createDataFrame(rows, DOCS)
    assert ours(simhash_groups(df)) == brute(rows)
    assert simhash_groups(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("crowded", [1_000_000, 3])
def test_links_find_every_component(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(crowded)
    seen = {}
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            seen.setdefault(x - (1 << 64) if x >> 63 else x, len(seen))
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
    df = spark.createDataFrame([(p, n) for p, n in seen.items()], "print long, node long")
    got = {r.node: r.component for r in components(print_links(df)).collect()}
    bits = np.array([p & (2**64 - 1) for p in seen], np.uint64)
    want = np.arange(len(bits))
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 3
    for _ in range(len(bits)):
        new = np.where(near, want[None, :], len(bits)).min(axis=1)
        if (new == want).all():
            break
        want = new
    assert [got.get(i, i) for i in range(len(bits))] == want.tolist()


def test_tree_over_one_dense_group():
    rng = np.random.default_rng(1)
    bits = np.unique(np.uint64(7) ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)))
    a, b = GrayTree(np.zeros(len(bits), np.int64), bits).link(3)
    assert len(a) == len(bits) - 1  # a tree joins them all


def test_one_of_each_keeps_columns(spark):
    rows = [(3, "a b c d", "p", 1), (3, "a b c d", "p", 1), (5, "a b c d", "q", 2), (7, "other words are here", None, 3), (None, "zz yy xx", "r", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string, print int")
    out = one_of_each(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([rows[0], rows[3], rows[4]], key=repr)
