import hashlib
import random
import re

import numpy as np
import pytest
from oracle_check import connect, differences
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.infill import ArrayContainer, BitmapContainer, BoundarySet, RunContainer, fill_in_middle, restored

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def brute(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text, text
    if h[3] % 100 < spm_rate:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'z' AS output", "2 AS n").repartition(3)
    cut = fill_in_middle(docs, **options).withColumn("text", restored(F.col("output"), F.col("form")))
    assert sorted((tuple(r) for r in cut.collect()), key=key) == sorted((brute(*r, **options) for r in rows), key=key)


def test_query_against_sql(spark):
    assert differences(spark, connect(SF), SF, "op13_fill_in_middle") == []


@pytest.mark.parametrize("options", [{}, {"seed": 1, "rate": 40}, {"spm_rate": 0}, {"spm_rate": 100}])
def test_forms_and_cuts(spark, options):
    rng = random.Random(4)
    bits = ["a", "bé", "\n", "\n\n", "日本\n", "<", "P>", "<S", ">", "👩", "\r\n", " "]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 20)))) for i in range(400)]
    check(spark, rows, **options)


def test_nulls_marks_repeats_and_long_texts(spark):
    rows = [(None, "a\nb"), (1, None), (2, ""), (3, "x <M> y\n"), (4, "\n"), (4, "\n"), (5, "<<S\nS>>\n<P"), (6, "line\n" * 300000), (7, "\n" * 200000), (8, "w" * 500000)]
    check(spark, rows)
    assert fill_in_middle(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("share", [0.001, 0.3, 0.99, 1.0])
def test_boundary_set_against_an_array(share):
    rng = np.random.default_rng(2)
    flat = np.flatnonzero(rng.random(300000) < share)
    flat = np.concatenate([flat, flat[:: max(1, len(flat) // 50)] + (1 << 21)])
    found = BoundarySet(flat)
    assert len(found) == len(flat)
    assert found.select(np.arange(len(flat))).tolist() == flat.tolist()
    at = np.concatenate([rng.integers(0, 1 << 22, 5000), flat, flat + 1])
    assert found.rank(at).tolist() == np.searchsorted(flat, at, side="right").tolist()


def test_containers_by_what_is_smallest():
    every, many = np.arange(60000), np.flatnonzero(np.random.default_rng(1).random(60000) < 0.5)
    kinds = {RunContainer: every, BitmapContainer: many, ArrayContainer: many[::50]}
    for kind, positions in kinds.items():
        assert [type(c) for c in BoundarySet(positions).containers] == [kind]
    assert len(BoundarySet(np.zeros(0, np.int64))) == 0
