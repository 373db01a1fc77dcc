import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import types as T

from tallyloom.llm.catalog import QUERIES
from tallyloom.llm.spelling import near_pairs, spelling_variants, word_counts

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
COUNTS = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])


def brute_counts(rows, spoil):
    counts = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % spoil == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            counts[word] += 1
    return counts


def edits(word, letters):
    for i in range(len(word) + 1):
        if i < len(word):
            yield word[:i] + word[i + 1 :]
        for c in letters:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1 :]


def brute_variants(n, factor=10):
    letters = sorted({c for w in n for c in w})
    near = {w: {x for x in edits(w, letters) if x in n and x != w} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def ours(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_on_a_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    n = {w: c for w, c in brute_counts(rows, 31).items() if len(w) >= 7 and c >= 2}
    want = brute_variants(n)
    assert any(f for _, f, *_ in want)
    assert ours(QUERIES["op11_spelling_variants"](spark, SF)) == want


@pytest.mark.parametrize("shapes, block_cells", [(4, 1 << 14), (2, 20), (1, 60), (3, 1), (7, 200)])
def test_near_words_in_groups_of_any_size(spark, shapes, block_cells):
    rng = random.Random(shapes)
    words = {"".join(rng.choice("aab") for _ in range(rng.randint(1, 12))) for _ in range(250)}
    words |= {"é" + w for w in list(words)[:40]} | {"", "日本語日本語日", "日本語日本日", "日本語日本語日日"}
    rows = [(w, rng.choice([2, 3, 20, 30, 400, 5000, 60000])) for w in sorted(words)]
    df = spark.createDataFrame(rows, COUNTS).repartition(4)
    assert ours(spelling_variants(df, shapes=shapes, block_cells=block_cells)) == brute_variants(dict(rows))


def test_each_pair_once_in_both_directions(spark):
    rows = [("aaaaaaa", 5), ("aaaaaa", 6), ("aaaaaab", 7), ("baaaaaa", 8)]
    found = sorted((r.word, r.near, r.near_n) for r in near_pairs(spark.createDataFrame(rows, COUNTS)).collect())
    near = [("aaaaaaa", "aaaaaa"), ("aaaaaaa", "aaaaaab"), ("aaaaaaa", "baaaaaa"), ("aaaaaa", "aaaaaab"), ("aaaaaa", "baaaaaa")]
    assert found == sorted((a, b, dict(rows)[b]) for x, y in near for a, b in ((x, y), (y, x)))


def test_forms_lead_to_their_root_over_many_steps(spark):
    rows = [("a" * (7 + k), 2 * 10**k) for k in range(18)]
    assert {r.root for r in spelling_variants(spark.createDataFrame(rows, COUNTS)).collect()} == {"a" * 24}


def test_nulls_repeats_ties_long_words_and_empty_tables(spark):
    rows = [(None, 50), ("caterers", 3), ("caterers", 2), ("catererz", 50), ("catererx", 50), ("l" * 30000, 40), ("l" * 30001, 4), ("lonely words", 1)]
    n = {"caterers": 5, "catererz": 50, "catererx": 50, "l" * 30000: 40, "l" * 30001: 4}
    assert ours(spelling_variants(spark.createDataFrame(rows, COUNTS))) == brute_variants(n)
    assert spelling_variants(spark.createDataFrame([], COUNTS)).count() == 0


def test_counts_of_words(spark):
    rows = [(1, None), (2, ""), (None, "Straßenlaterne CAFÉTIÈRE"), (3, "Überraschung×÷ " * 40), (3, "Überraschung×÷ " * 40), (4, "x" * 100000), (5, "short words only")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'w' AS word", "1 AS n")
    got = {r.word: r.n for r in word_counts(docs, spoil=5).collect()}
    assert got == {w: c for w, c in brute_counts(rows, 5).items() if len(w) >= 7}
    assert word_counts(spark.createDataFrame([], DOCS)).count() == 0
