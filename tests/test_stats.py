import math

import numpy as np
import pytest
from census import people
from pyspark.sql import functions as F

import tallyloom as tl
from tallyloom.functions.tails import chi2_upper, format_p, t_two_sided
from tallyloom.spec import CENSUS_INCOME


@pytest.fixture(scope="module")
def cleaned(spark):
    return tl.clean(people(spark, CENSUS_INCOME.schema.names), "income").table


def expand(spark, cells, schema):
    return spark.createDataFrame(cells, schema).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))


def test_t_test_has_p_and_sentence(cleaned):
    row = tl.welch_t(cleaned, "hours-per-week", "income").first()
    assert 0.0 <= row["p_value"] <= 1.0
    assert isinstance(row["significant"], bool)
    assert "p=" in row["interpretation"]
    assert (row["group_a"], row["group_b"]) == ("<=50K", ">50K")


def test_missing_columns_raise(cleaned):
    with pytest.raises(ValueError, match="not_exist"):
        tl.welch_t(cleaned, "not_exist", "income")
    with pytest.raises(ValueError, match="nope"):
        tl.chi2_independence(cleaned, "sex", "nope")


def test_t_test_wants_two_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "g string, x double")
    with pytest.raises(Exception, match="takes two groups, found 3"):
        tl.welch_t(df, "x", "g").collect()
    with pytest.raises(Exception, match="takes two groups, found 1"):
        tl.welch_t(df.where("g = 'a'"), "x", "g").collect()


def test_t_test_against_a_hand_made_case(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 9.0]
    df = spark.createDataFrame([("a", v) for v in a] + [("b", v) for v in b] + [("b", None), (None, 5.0)], "g string, x double")
    row = tl.welch_t(df, "x", "g").first()
    va, vb = np.var(a, ddof=1) / 4, np.var(b, ddof=1) / 3
    assert row["t_stat"] == pytest.approx((2.5 - 5.0) / math.sqrt(va + vb))
    assert row["df"] == pytest.approx((va + vb) ** 2 / (va**2 / 3 + vb**2 / 2))
    assert (row["n_a"], row["n_b"]) == (4, 3)


def test_t_test_without_spread_or_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 1.0)], "g string, x double")
    row = tl.welch_t(df, "x", "g").first()
    assert row["t_stat"] is None and row["p_value"] is None and row["significant"] is False
    lone = tl.welch_t(df.where("g = 'a'").union(df.limit(1).selectExpr("'b'", "2.0D")), "x", "g").first()
    assert lone["t_stat"] is None
    bare = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None)], "g string, x double")
    assert tl.welch_t(bare, "x", "g").first()["n_b"] == 0


def test_t_test_by_segment(spark):
    df = spark.createDataFrame(
        [(s, g, float(i * (1 if g == "a" else 2))) for s in "xy" for g in "ab" for i in range(5)] + [("z", "a", 1.0)],
        "s string, g string, x double",
    )
    rows = {r["s"]: r for r in tl.welch_t(df, "x", "g", by=["s"]).collect()}
    assert rows["x"]["t_stat"] == rows["y"]["t_stat"] == tl.welch_t(df.where("s = 'x'"), "x", "g").first()["t_stat"]
    assert rows["z"]["t_stat"] is None


def test_published_chi_square(spark):
    cells = [("Female", "<=50K", 9583), ("Female", ">50K", 1179), ("Male", "<=50K", 15115), ("Male", ">50K", 6660)]
    df = expand(spark, cells, "sex string, income string, n long")
    row = tl.chi2_independence(df, "sex", "income").first()
    assert round(row["chi2"], 4) == 1516.5397
    assert (row["dof"], row["p_value"], row["p_text"], row["significant"]) == (1, 0.0, "< 1e-308", True)


def test_chi_square_with_empty_cells(spark):
    cells = [("a", "x", 5), ("b", "y", 7), ("c", "x", 2), ("c", "z", 4)]
    o = np.array([[5, 0, 0], [0, 7, 0], [2, 0, 4]], dtype=float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    df = expand(spark, cells, "a string, b string, n long")
    row = tl.chi2_independence(df, "a", "b").first()
    assert row["chi2"] == pytest.approx(((o - e) ** 2 / e).sum())
    assert row["dof"] == 4


@pytest.mark.parametrize("cells", [[("a", "x", 5), ("b", "y", 7)], [("a", "x", 5), ("a", "y", 3), ("b", "y", 7)]])
def test_yates_with_empty_cells(spark, cells):
    o = np.zeros((2, 2))
    for a, b, n in cells:
        o["ab".index(a), "xy".index(b)] = n
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    expect = (np.maximum(np.abs(o - e) - 0.5, 0) ** 2 / e).sum()
    df = expand(spark, cells, "a string, b string, n long")
    assert tl.chi2_independence(df, "a", "b").first()["chi2"] == pytest.approx(expect)


def test_chi_square_with_one_row_of_cells(spark):
    df = expand(spark, [("a", "x", 5), ("a", "y", 3)], "a string, b string, n long")
    row = tl.chi2_independence(df, "a", "b").first()
    assert (row["chi2"], row["dof"], row["p_value"]) == (0.0, 0, 1.0)


@pytest.mark.parametrize("df", [1.0, 2.0, 3.7, 10.0, 120.0, 5000.0, 19_999.0, 20_001.0, 1e6])
def test_t_tail_against_commons_math(spark, df):
    dist = spark._jvm.org.apache.commons.math3.distribution.TDistribution(df)
    for t in (0.0, 0.01, 0.7, 2.0, 5.0, 20.0):
        expect = 2.0 * dist.cumulativeProbability(-t)
        assert t_two_sided(t, df) == pytest.approx(expect, rel=1e-8, abs=1e-300)
        assert t_two_sided(-t, df) == t_two_sided(t, df)


def test_deep_tails():
    # Twice the normal tail at 20 and at 37, from its asymptotic series.
    assert t_two_sided(20.0, 1e12) == pytest.approx(5.507248237212467e-89, rel=1e-8)
    assert 0.0 < t_two_sided(37.0, 1e12) < 1e-298
    assert t_two_sided(60.0, 1e12) == 0.0
    assert chi2_upper(4000.0, 1.0) == 0.0
    assert chi2_upper(1400.0, 2.0) == pytest.approx(math.exp(-700.0), rel=1e-10)


@pytest.mark.parametrize("dof", [1.0, 2.0, 3.0, 10.0, 250.0])
def test_chi2_tail_against_commons_math(spark, dof):
    gamma = spark._jvm.org.apache.commons.math3.special.Gamma
    for x in (0.001, 0.5, 3.84, 9.0, 80.0, 300.0):
        expect = gamma.regularizedGammaQ(dof / 2, x / 2, 1e-15, 100_000)
        assert chi2_upper(x, dof) == pytest.approx(expect, rel=1e-8, abs=1e-14)


def test_p_text():
    assert format_p(0.0) == "< 1e-308"
    assert format_p(0.05) == "0.05"
    assert format_p(0.123456) == "0.1235"
    assert format_p(1.23456e-7) == "1.235e-07"
    assert format_p(None) is None


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(3)
    import pandas as pd

    x = rng.normal(1e6, 1, (500, 4))
    x[:, 1] += x[:, 0]
    frame = pd.DataFrame(x, columns=list("abcd"))
    frame["const"] = 4.1
    frame.loc[::7, "a"] = np.nan
    frame.loc[::5, "c"] = np.nan
    return frame, spark.createDataFrame(frame)


def test_correlation_over_jointly_known_rows(gappy):
    frame, df = gappy
    expect = frame.corr()
    found = tl.correlation_matrix(df).collect()
    assert len(found) == 25
    for row in found:
        e = expect.loc[row["column_a"], row["column_b"]]
        if "const" in (row["column_a"], row["column_b"]):
            assert row["r"] is None
        else:
            assert row["r"] == pytest.approx(e, rel=1e-6)
            assert row["r"] == 1.0 or row["i"] != row["j"]


def test_correlation_is_that_of_the_joint_rows_alone(spark):
    """One column is huge exactly where the other is missing."""
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=400), rng.normal(size=400)
    rows = [(1e9 + i, None) if i % 2 else (float(a), float(a + b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double")
    found = tl.correlations(df).first()["r"]
    assert found == pytest.approx(np.corrcoef(x[::2], (x + y)[::2])[0, 1], rel=1e-9)


def test_tails_of_many_degrees_of_freedom():
    from tallyloom.functions.tails import chi2_upper, t_two_sided

    for dof in (19_999, 20_001, 1e6, 1e12):
        # Wilson and Hilferty's cube root is good to about 1e-6 here.
        for z in (-2.0, 0.0, 1.0, 3.0):
            x = dof * (1 - 2 / (9 * dof) + z * (2 / (9 * dof)) ** 0.5) ** 3
            assert chi2_upper(x, dof) == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-4)
    assert chi2_upper(19_999.5, 19_999.9) == pytest.approx(chi2_upper(19_999.5, 20_000.1), rel=2e-3)
    assert t_two_sided(1.5, 1e9) == pytest.approx(math.erfc(1.5 / math.sqrt(2)), rel=1e-6)


def test_crosstab_of_many_values(spark):
    df = spark.range(40_000).select((F.col("id") % 4).alias("a"), (F.col("id") % 12_000).alias("b"))
    pct = tl.crosstab_pct(df, "a", "b", zeros=False)
    assert pct.count() == df.distinct().count() and abs(pct.agg(F.sum("pct")).first()[0] - 400) < 1e-6


def test_top_correlations_order(spark):
    pairs = spark.createDataFrame(
        [(0, 1, "a", "b", 0.07801), (1, 2, "b", "c", 0.0784), (0, 2, "a", "c", -0.5), (2, 3, "c", "d", None)],
        "i int, j int, column_a string, column_b string, r double",
    )
    top = [(r["column_a"], r["column_b"]) for r in tl.top_correlations(pairs, 3).collect()]
    assert top == [("a", "c"), ("a", "b"), ("b", "c")]


def test_published_grouped_bars(spark):
    # A few cells of the published chart: count and means per occupation and label.
    cells = [("Prof-specialty", "<=50K", 3930), ("Prof-specialty", ">50K", 2049), ("Armed-Forces", ">50K", 1), (None, ">50K", 9)]
    df = expand(spark, cells, "occupation string, income string, n long").withColumn("hours", F.lit(40))
    out = tl.by_count(tl.group_summary(df, ["occupation", "income"], {"avg_hours": "hours"}), ["occupation"])
    assert [r["count"] for r in out.collect()] == [3930, 2049, 1]


def test_crosstab_fills_empty_cells(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), (None, "y"), ("a", None)], "k string, v string")
    assert [tuple(r) for r in tl.crosstab(df, "k", "v").orderBy("k").collect()] == [("a", 2, 0), ("b", 0, 1)]
    pct = {(r["k"], r["v"]): r["pct"] for r in tl.crosstab_pct(df, "k", "v").collect()}
    assert pct == {("a", "x"): 100.0, ("a", "y"): 0.0, ("b", "x"): 0.0, ("b", "y"): 100.0}
