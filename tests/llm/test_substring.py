import hashlib
import random
import re

import pytest
from oracle_check import connect, differences
from pyspark.sql import types as T

from tallyloom.llm.catalog import QUERIES
from tallyloom.llm.substring import substring_dedup, without_repeats

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def brute(rows, length):
    words = [(i if i is not None else -(2**63), re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for s in range(len(w) - length + 1):
            key = tuple(w[s : s + length])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), (d, w) in zip(rows, words):
        gone = set()
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] < d:
                gone.update(range(s, s + length))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def ours(df):
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") for _ in range(rng.randint(5, 40))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += rng.choice(passages) if rng.random() < 0.6 else [rng.choice("xyzuvwé") for _ in range(rng.randint(1, 12))]
        if rng.random() < 0.1:
            words = ["same"] * rng.randint(0, 50)
        rows.append((rng.randint(0, 40), rng.choice([" ", "\n", "\t "]).join(words)))
    rows += [(3, None), (None, rows[5][1]), (99, ""), rows[0], rows[0]]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    assert ours(substring_dedup(df, length=12, anchor=4)) == brute(rows, 12)


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert ours(QUERIES["op1_substring_dedup"](spark, sf)) == brute(rows, 50)


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(spark, connect(sf), sf, "op1_substring_dedup") == []


def test_empty_table_and_columns_of_the_input(spark):
    empty = spark.createDataFrame([], DOCS)
    assert substring_dedup(empty).count() == 0
    same = " ".join(f"w{i}" for i in range(60))
    rows = [(1, same, "a", 7), (2, "x " + same + "\ny", "b", 8), (3, None, None, None), (4, "short  text", "c", 11)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, n_chars int")
    got = {r.doc_id: r for r in without_repeats(df).collect()}
    assert without_repeats(df).columns == df.columns
    assert got[1].text == same and got[2].text == "x y" and got[2].n_chars == 3
    assert got[3].text is None and got[4].text == "short  text" and got[4].n_words == "c"
