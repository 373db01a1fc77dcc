import math

import pytest
from census import people
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tallyloom as tl
from tallyloom.spec import CENSUS_INCOME

LINES = """39, State-gov, 77516, <=50K
50, ?, 83311, >50K.

 40 ,?,, >50K

41, A,1, <=50K,extra
42, B
,,,
43,"q, r",NA, nan
44,   ,5,x
xx, A,1,y
"""
SCHEMA = T.StructType(
    [
        T.StructField("age", T.LongType()),
        T.StructField("wc", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("inc", T.StringType()),
    ]
)


@pytest.fixture(scope="module")
def raw(spark):
    return people(spark, CENSUS_INCOME.schema.names, rows=600, copied=8).cache()


def test_counts_of_a_table_with_known_gaps_and_copies(raw):
    nulls = {r["column"]: r["n_null"] for r in tl.null_profile(raw).collect()}
    assert nulls == {"age": 600 // 40, "workclass": 600 // 25, "occupation": 600 // 60}
    tidy = tl.clean(raw, CENSUS_INCOME.target)
    assert tuple(tidy.history.first()) == (8, 600 // 25 + 600 // 60, 600 // 40)
    assert tidy.table.count() == 600
    middle = raw.dropDuplicates().agg(F.expr("percentile(age, 0.5)")).first()[0]
    filled = tidy.table.exceptAll(raw.select([F.col(f"`{c}`").cast(t).alias(c) for c, t in tidy.table.dtypes]))
    assert {r["age"] for r in filled.where("`marital-status` IS NOT NULL").collect() if r["age"] == middle}


def test_cleaned_table_needs_no_second_cleaning(raw):
    once = tl.stage(tl.clean(raw, CENSUS_INCOME.target).table)
    again = tl.clean(once, CENSUS_INCOME.target)
    dropped, text, numbers = again.history.first()
    # Rows that the fills made equal are copies now.
    assert text == numbers == 0 and again.table.count() == once.count() - dropped


def test_clean_fills_a_long_column_with_a_fractional_median(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "x long, k string")
    out = {r["k"]: r["x"] for r in tl.clean(df).table.collect()}
    assert out == {"a": 1.0, "b": 2.0, "c": 1.5}


def test_mode_tie_takes_the_smallest_value(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "i long, k string")
    out = {r["i"]: r["k"] for r in tl.clean(df).table.collect()}
    assert out[3] == "a"


def test_labels_are_tidied_after_dedupe_and_fill(spark):
    # ">50K" and ">50K." are two values while copies are dropped and the mode is taken.
    rows = [(1, ">50K"), (1, ">50K."), (2, ">50K."), (3, "<=50K"), (4, "<=50K"), (5, None), (5, None)]
    df = spark.createDataFrame(rows, "i long, y string")
    out = sorted(tuple(r) for r in tl.clean(df, "y").table.collect())
    assert out == [(1, ">50K"), (1, ">50K"), (2, ">50K"), (3, "<=50K"), (4, "<=50K"), (5, "<=50K")]


def test_column_without_values_stays_null(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, None)], "i long, s string, d double")
    found = tl.clean(df)
    assert tl.total_nulls(found.table).first()[0] == 4
    assert found.history.first()["filled_categorical"] == 0


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert tl.total_nulls(df).first()[0] == 2
    row = tl.describe_numeric(df).first()
    assert (row["count"], row["mean"], row["max"], row["median"]) == (2, 2.0, 3.0, 2.0)
    assert tl.dedupe(df).count() == 3


def test_impact_of_the_fill(spark):
    raw = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    keyed = raw.withColumn("i", F.monotonically_increasing_id())
    impact = tl.imputation_impact(keyed, tl.clean(keyed).table).first()
    assert (impact["mode"], impact["n_filled"]) == ("a", 1)
    assert impact["before_pct"] == pytest.approx(200 / 3)
    assert impact["after_pct"] == pytest.approx(75.0)
    assert tl.worst_impact(tl.imputation_impact(keyed, tl.clean(keyed).table)).first()["column"] == "k"


def test_impact_without_nulls_is_empty(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n long")
    assert tl.imputation_impact(df, df).count() == 0
    assert tl.imputation_impact(df.select("n"), df.select("n")).count() == 0


def write_lines(tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text(LINES)
    return str(path)


def test_delimited_edge_lines(spark, tmp_path):
    df = tl.read_delimited(spark, write_lines(tmp_path), SCHEMA)
    rows = [tuple(r) for r in df.collect()]
    assert [r[0] for r in rows] == [39, 50, 40, 41, 42, None, 43, 44, None]
    assert rows[1] == (50, None, 83311, ">50K.")
    assert rows[2] == (40, None, None, ">50K")
    assert rows[3] == (41, "A", 1, "<=50K")
    assert rows[6] == (43, "q, r", None, "nan")


def test_tolerant_reader_drops_empty_rows(spark, tmp_path):
    df = tl.read_tolerant(spark, write_lines(tmp_path), SCHEMA)
    assert df.count() == 8
    assert df.where("wc = 'q, r'").first()["age"] == 43
    tokens = tl.read_tolerant(spark, write_lines(tmp_path), SCHEMA, null_tokens=["?", "NA", "nan"])
    assert tokens.where("age = 43").first()["inc"] is None


def test_two_loads_of_a_clean_file_agree(spark, tmp_path):
    rows = [f"{i}, w{i % 3}, {i * i}, {'>50K' if i % 4 else '?'}" for i in range(50)]
    path = tmp_path / "clean.csv"
    path.write_text("\n".join(rows) + "\n\n")
    left = tl.read_delimited(spark, str(path), SCHEMA)
    right = tl.read_tolerant(spark, str(path), SCHEMA)
    assert all(r["equal"] for r in tl.reconcile(left, right).collect())
    # Equal counts alone do not pass.
    moved = right.withColumn("n", F.when(F.col("age") == 1, 7).otherwise(F.col("n")))
    wrong = {r["metric"] for r in tl.reconcile(left, moved).where("NOT equal").collect()}
    assert wrong == {"fingerprint"}


def test_strip_takes_tabs_too(spark):
    df = spark.createDataFrame([("\t >50K.. ",)], "y string")
    assert df.select(tl.clean_label(F.col("y"))).first()[0] == ">50K"
    assert df.select(tl.strip_space(F.col("y"))).first()[0] == ">50K.."
    wide = spark.createDataFrame([("\u00a0\u3000 x\u200b \u2028",)], "y string")
    assert wide.select(tl.strip_space(F.col("y"))).first()[0] == "x\u200b"


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.125,), (0.375,)], "x double")
    assert [r[0] for r in tl.rounded(df, 2).collect()] == [0.12, 0.38]


def test_names_with_dots_and_hyphens(spark):
    df = spark.createDataFrame([(1.0, "x", "u"), (None, None, "v"), (3.0, "x", "w")], "`a.b` double, `c-d` string, k string")
    out = tl.clean(df).table
    assert tl.total_nulls(out).first()[0] == 0
    assert out.where("k = 'v'").select("`a.b`").first()[0] == 2.0
    assert {r["column"] for r in tl.describe_numeric(df).collect()} == {"a.b"}
    assert tl.crosstab_long(df, "c-d", "k").count() == 2


def test_other_types_are_ignored(spark):
    df = spark.sql("SELECT 1L AS n, 'a' AS s, true AS b, array(1) AS arr, timestamp'2020-01-01' AS t")
    assert tl.select_class(df, "numeric").columns == ["n"]
    assert tl.select_class(df, "categorical").columns == ["s"]
    assert tl.describe_numeric(df).count() == 1


def test_summary_of_a_table_with_known_gaps_and_copies(raw):
    rows = {(r["section"], r["item"], r["metric"]): r for r in tl.eda_summary(raw, "income").collect()}
    assert rows["shape", "table", "n_rows"]["value_num"] == 608
    assert rows["shape", "table", "n_cols"]["value_num"] == 15
    assert rows["duplicates", "table", "n_duplicates"]["value_num"] == 8
    assert rows["nulls", "age", "n_null"]["value_num"] == 15
    assert rows["dtypes", "age", "dtype"]["value_str"] == "bigint"
    assert rows["describe", "age", "count"]["value_num"] == 593
    assert sum(r["value_num"] for k, r in rows.items() if k[0] == "target" and k[2] == "n") == 608
    assert ("nulls", "sex", "n_null") not in rows and tl.target_share(raw, "nothing").count() == 0


def test_tables_of_one_type_class(spark):
    words = spark.createDataFrame([("a", None), ("b", "c")], "x string, y string")
    numbers = spark.createDataFrame([(1, 2.0), (3, None)], "x long, y double")
    assert tl.describe_numeric(words).count() == tl.correlation_matrix(words).count() == 0
    assert tl.describe_numeric(words).columns == tl.describe_numeric(numbers).columns
    assert tl.correlation_matrix(words).columns == tl.correlation_matrix(numbers).columns
    assert tl.categorical_profile(numbers).count() == tl.value_counts(numbers).count() == 0
    assert {r["section"] for r in tl.eda_summary(words, "x").collect()} == {"shape", "duplicates", "dtypes", "nulls", "target"}
    assert {r["section"] for r in tl.eda_summary(numbers, "none").collect()} == {"shape", "duplicates", "dtypes", "nulls", "describe"}
    assert tl.clean(words).table.count() == 2 and tl.clean(numbers).table.count() == 2


def test_readers_treat_blanks_alike(spark, tmp_path):
    path = tmp_path / "blank.csv"
    path.write_text('1, "  ",2,\u00a0x\u00a0\n2,\t y\t,3,"\u2003"\n')
    for read in (tl.read_delimited, tl.read_tolerant):
        rows = sorted(tuple(r) for r in read(spark, str(path), SCHEMA).collect())
        assert rows == [(1, None, 2, "x"), (2, "y", 3, None)]
    broken = tmp_path / "broken.csv"
    broken.write_text('1,"a\nb",2,x\n')
    assert tl.read_delimited(spark, str(broken), SCHEMA, line_breaks=True).first()["wc"] == "a\nb"
    assert tl.read_delimited(spark, str(broken), SCHEMA).count() == 2


def test_staged_tables_go_with_their_block(spark):
    from pathlib import Path

    from tallyloom.sources.tables import staging_path

    place = Path(staging_path(spark, "x")).parent
    before = set(place.iterdir()) if place.exists() else set()
    kept = [str(p) for p in before]
    assert tl.stage(spark.range(3)).count() == 3 and len(set(place.iterdir()) - before) == 1 and kept is not None


def test_describe_matches_a_known_case(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 10)], "x long")
    row = tl.describe_numeric(df).first()
    assert (row["q1"], row["median"], row["q3"]) == (1.75, 2.5, 4.75)
    assert math.isclose(row["std"], 4.08248290463863)
