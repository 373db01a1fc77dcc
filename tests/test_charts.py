import numpy as np
import pandas as pd
import pytest

import tallyloom as tl
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(11)
    return pd.DataFrame(
        {
            "g": rng.choice(["a", "b"], 3000, p=[0.8, 0.2]),
            "x": np.round(rng.gamma(2.0, 10.0, 3000), 1),
        }
    )


@pytest.fixture(scope="module")
def df(spark, frame):
    extra = pd.DataFrame({"g": ["lone", None], "x": [5.0, 6.0]})
    return spark.createDataFrame(pd.concat([frame, extra])).cache()


def test_histogram_matches_numpy(df, frame):
    edges = np.histogram_bin_edges(frame["x"], 30, (frame["x"].min(), frame["x"].max()))
    rows = tl.histogram(df, "x", "g").orderBy("g", "bin").collect()
    assert len(rows) == 90
    for g in "ab":
        expect, _ = np.histogram(frame.loc[frame["g"] == g, "x"], bins=edges)
        assert [r["n"] for r in rows if r["g"] == g] == list(expect)
    assert rows[0]["bin_start"] == edges[0] and rows[29]["bin_end"] == edges[-1]


def test_histogram_of_edge_values(spark):
    values = [0.1 * i for i in range(31)]
    df = spark.createDataFrame([("g", v) for v in values], "g string, x double")
    expect, _ = np.histogram(values, bins=30)
    assert [r["n"] for r in tl.histogram(df, "x", "g").orderBy("bin").collect()] == list(expect)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([("g", 5.0)] * 4, "g string, x double")
    rows = tl.histogram(df, "x", "g").orderBy("bin").collect()
    assert rows[0]["bin_start"] == 4.5 and rows[29]["bin_end"] == 5.5
    assert [r["n"] for r in rows] == list(np.histogram([5.0] * 4, bins=30)[0])


def test_density_curve(df, frame):
    rows = tl.density_curve(df, "x", "g").orderBy("g", "point").collect()
    assert {r["g"] for r in rows} == {"a", "b"}  # one value has no spread and no curve
    for g in "ab":
        x = frame.loc[frame["g"] == g, "x"].to_numpy()
        grid = np.linspace(x.min(), x.max(), 200)
        h = x.std(ddof=1) * len(x) ** -0.2
        expect = np.exp(-(((grid[:, None] - x) / h) ** 2) / 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
        mine = [r for r in rows if r["g"] == g]
        assert np.allclose([r["x"] for r in mine], grid)
        assert np.allclose([r["density"] for r in mine], expect, rtol=1e-10)


def test_density_keeps_points_out_of_reach(spark):
    # Two tight clumps far apart: the grid between them is beyond every kernel.
    values = [float(v) for v in range(20000)]
    df = spark.createDataFrame([("g", v / 1e6) for v in values] + [("g", 1e9)], "g string, x double")
    rows = tl.density_curve(df, "x", "g").collect()
    assert len(rows) == 200


def exact_density(x, points=200):
    grid, h = np.linspace(x.min(), x.max(), points), x.std(ddof=1) * len(x) ** -0.2
    kernels = np.exp(-(((grid[:, None] - x) / h) ** 2) / 2)
    return kernels.sum(1) / (len(x) * h * np.sqrt(2 * np.pi)), 1 / (h * np.sqrt(2 * np.pi))


def test_density_is_within_its_bound(spark):
    rng = np.random.default_rng(5)
    tables = {
        "heavy": rng.standard_t(1.5, 4000),
        "clumps": np.r_[rng.normal(0, 1e-3, 500), rng.normal(1e6, 1.0, 500)],
        "far": 1e9 + rng.gamma(2.0, 10.0, 2000),
        "few": np.array([1.0, 2.0, 2.0]),
        "two": np.array([-1e-200, 1e-200]),
    }
    df = spark.createDataFrame([(g, float(v)) for g, x in tables.items() for v in x], "g string, x double")
    rows = tl.density_curve(df, "x", "g").orderBy("g", "point").collect()
    for g, x in tables.items():
        mine = np.array([r["density"] for r in rows if r["g"] == g])
        if g == "two":  # its squares are below the range of doubles, so it has no spread
            assert len(mine) == 0
            continue
        expect, height = exact_density(x)
        # of the value 1e9 itself a double keeps seven digits behind the point
        assert len(mine) == 200 and mine.min() >= 0
        assert np.abs(mine - expect).max() <= height * (1e-7 if g == "far" else 1e-10), g


def test_density_passes_over_groups_with_infinities(spark):
    rows = [("a", 1.0), ("a", float("inf")), ("b", 1.0), ("b", 2.0), ("b", None), ("c", -float("inf")), ("c", float("inf")), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    assert {r["g"] for r in tl.density_curve(df, "x", "g").collect()} == {"b"}
    assert tl.density_curve(df.limit(0), "x", "g").count() == 0


def test_box_plot_and_outliers(df, frame):
    rows = {r["g"]: r for r in tl.box_plot(df, "x", "g").collect()}
    far = tl.outliers(df, "x", "g").collect()
    for g in "ab":
        x = frame.loc[frame["g"] == g, "x"].to_numpy()
        q1, q2, q3 = np.percentile(x, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        r = rows[g]
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, q2, q3))
        assert r["whisker_low"] == x[x >= low].min() and r["whisker_high"] == x[x <= high].max()
        assert (r["n_below"], r["n_above"]) == ((x < low).sum(), (x > high).sum())
        assert sum(f["n"] for f in far if f["g"] == g) == r["n_below"] + r["n_above"]


def test_whisker_does_not_end_inside_the_box(spark):
    # All values up to the fence lie below the interpolated third quartile.
    values = [0.0, 0.0, 0.0, 100.0]
    df = spark.createDataFrame([("g", v) for v in values], "g string, x double")
    r = tl.box_plot(df, "x", "g").first()
    assert r["q3"] == 25.0 and r["whisker_high"] == 25.0 and r["n_above"] == 1


def test_answers_are_the_same_where_groups_are_shuffled(spark, frame, df):
    few = tl.box_plot(df, "x", "g").orderBy("g").collect()
    curve = tl.density_curve(df, "x", "g").orderBy("g", "point").collect()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert tl.box_plot(df, "x", "g").orderBy("g").collect() == few
        again = tl.density_curve(df, "x", "g").orderBy("g", "point").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert [r["density"] for r in again] == pytest.approx([r["density"] for r in curve], rel=1e-12)


def test_outliers_of_more_groups_than_are_broadcast(spark):
    rows = spark.range(88_000).select((F.col("id") % 11_000).alias("g"), F.when(F.col("id") < 11_000, 9.0).otherwise(1.0).alias("x"))
    found = tl.outliers(rows, "x", "g")
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.agg(F.count("*"), F.min("x"), F.max("n")).first() == (11_000, 9.0, 1)
