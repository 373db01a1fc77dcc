"""Correlations of columns with gaps, one scan, against plain sums over each pair's own rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import tallyloom as tl
from tallyloom.operators.comoments import CoMoments, pair_correlations
from tallyloom.spec import as_double


def brute(x):
    out = {}
    for i in range(x.shape[1]):
        for j in range(i, x.shape[1]):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            flat = len(a) < 2 or (a == a[0]).all() or (b == b[0]).all() or np.isinf(a).any() or np.isinf(b).any()
            out[i, j] = None if flat else 1.0 if i == j else np.corrcoef(a, b)[0, 1]
    return out


def frame(spark, x, partitions=4):
    names = ", ".join(f"a{i} double" for i in range(x.shape[1]))
    rows = [[None if math.isnan(v) else float(v) for v in row] for row in x]
    return spark.createDataFrame(rows, names).repartition(partitions)


def check(found, want):
    assert set(found) == set(want)
    for key, r in want.items():
        assert (found[key] is None) == (r is None), key
        assert r is None or found[key] == pytest.approx(r, abs=1e-9), key


def pairs(df, **options):
    return {(r["i"], r["j"]): r["r"] for r in pair_correlations(df, [as_double(df, c) for c in df.columns], **options).collect()}


def wide_sample(rows=700, columns=70, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, columns)) @ rng.normal(size=(columns, columns)) + rng.choice([0.0, 1e6], columns)
    x[rng.random(x.shape) < 0.2] = np.nan
    return x


@pytest.mark.parametrize("panel", [512, 33, 20])
def test_more_columns_than_a_tile_and_than_a_panel(spark, panel):
    x = wide_sample()
    check(pairs(frame(spark, x), panel=panel), brute(x))


def test_pairs_whose_common_rows_lie_far_from_the_mean(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 4))
    far = rng.random(4000) < 0.5
    x[far, 0] = 1e9 + x[far, 0]
    x[~far, 1] = np.nan
    x[:, 2] += 1e8
    x[:, 3] = np.where(far, 3.25, x[:, 3])
    got = pairs(frame(spark, x, 7))
    assert got[1, 3] is None
    want = brute(x)
    del got[1, 3], want[1, 3]
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-6), key


@pytest.mark.parametrize("bad", [math.inf, -math.inf])
def test_infinities_leave_their_pairs_undefined(spark, bad):
    x = np.random.default_rng(2).normal(size=(60, 4))
    x[5, 0], x[5, 1], x[9, 2] = bad, np.nan, np.nan
    got = pairs(frame(spark, x))
    want = brute(x)
    assert want[0, 1] is not None and want[0, 2] is None  # the infinite row has no value in column 1
    check(got, want)


def test_what_has_no_value_is_null_everywhere(spark):
    df = spark.createDataFrame(
        [(1.0, 7.0, None, 1e200, 1.0), (2.0, 7.0, None, -1e200, math.nan), (4.0, 7.0, 3.0, 5.0, 2.0)],
        "x double, constant double, lone double, huge double, gap double",
    )
    rows = {(r["column_a"], r["column_b"]): r["r"] for r in tl.correlation_matrix(df).collect()}
    assert len(rows) == 25 and not any(r is not None and math.isnan(r) for r in rows.values())
    assert all(rows[pair] is None for pair in rows if {"constant", "lone", "huge"} & set(pair))
    assert rows["x", "x"] == 1.0 and rows["x", "gap"] == pytest.approx(1.0)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "x double, y double")
    assert [(r["i"], r["j"], r["r"]) for r in tl.correlations(none).collect()] == [(0, 1, None)]
    assert tl.correlations(none.select(F.lit("a").alias("s"))).count() == 0


def test_one_scan_and_the_same_for_other_partitions(spark, tmp_path):
    x = wide_sample(columns=40)
    path = str(tmp_path / "wide")
    frame(spark, x).write.parquet(path)
    df = spark.read.parquet(path)
    plan = tl.correlations(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    other = pairs(df.repartition(13))
    for key, r in pairs(df).items():
        assert other[key] == pytest.approx(r, rel=1e-10, abs=1e-10)


def test_merging_is_that_of_all_rows_together():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 6)) + 1e5
    x[rng.random(x.shape) < 0.4] = np.nan
    x[200:] -= 3e5
    whole, parts = CoMoments.of_batch(x), CoMoments(6)
    for a, b in ((0, 1), (1, 200), (200, 201), (201, 500)):
        parts.add(CoMoments.of_batch(x[a:b]))
    for name in ("n", "m", "w", "c", "d", "p"):
        np.testing.assert_allclose(getattr(parts, name), getattr(whole, name), rtol=1e-9)
