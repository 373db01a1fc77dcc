"""Table descriptions, type classes and input validation."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """What a run needs to know about one table, passed as an argument."""

    schema: T.StructType
    target: str
    positive_label: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    ttest_value: str
    chi2_column: str
    histogram_column: str
    bar_column: str
    bar_means: dict[str, str] = field(default_factory=dict)
    null_tokens: tuple[str, ...] = ("?",)
    seed: int = 42

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]


# Column names, types and roles of the public census income table.
CENSUS_INCOME = TableSpec(
    schema=T.StructType(
        [
            T.StructField("age", T.LongType()),
            T.StructField("workclass", T.StringType()),
            T.StructField("fnlwgt", T.LongType()),
            T.StructField("education", T.StringType()),
            T.StructField("education-num", T.LongType()),
            T.StructField("marital-status", T.StringType()),
            T.StructField("occupation", T.StringType()),
            T.StructField("relationship", T.StringType()),
            T.StructField("race", T.StringType()),
            T.StructField("sex", T.StringType()),
            T.StructField("capital-gain", T.LongType()),
            T.StructField("capital-loss", T.LongType()),
            T.StructField("hours-per-week", T.LongType()),
            T.StructField("native-country", T.StringType()),
            T.StructField("income", T.StringType()),
        ]
    ),
    target="income",
    positive_label=">50K",
    numeric=("age", "education-num", "capital-gain", "capital-loss", "hours-per-week"),
    categorical=(
        "workclass",
        "marital-status",
        "occupation",
        "relationship",
        "race",
        "sex",
        "native-country",
    ),
    ttest_value="hours-per-week",
    chi2_column="sex",
    histogram_column="age",
    bar_column="occupation",
    bar_means={"avg_hours": "hours-per-week", "avg_age": "age"},
)


def q(name: str) -> str:
    """Backtick a column name, so that dots and hyphens in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def columns_of(df: DataFrame, *classes: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, classes)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.NumericType)


def string_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.StringType)


def select_class(df: DataFrame, kind: str) -> DataFrame:
    """Project to the ``"numeric"`` or the ``"categorical"`` columns only."""
    picked = {"numeric": numeric_columns, "categorical": string_columns}[kind](df)
    return df.select(*[col(c) for c in picked])


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing, as every operator here sees it."""
    return F.when(~F.isnan(col(name)), col(name)) if is_floating(df, name) else col(name)


def as_double(df: DataFrame, name: str) -> Column:
    return present(df, name).cast("double")


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[present(df, c).alias(c) for c in df.columns])


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def feature_view(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Project to features and target, naming what is missing."""
    if spec.target not in df.columns:
        raise ValueError(f"target column not found: {spec.target}")
    missing = [c for c in spec.features if c not in df.columns]
    if missing:
        raise ValueError(f"feature columns not found: {missing}")
    return df.select(*[col(c) for c in [*spec.features, spec.target]])


def rounded(df: DataFrame, digits: int | None) -> DataFrame:
    """Round every double column half-even; ``None`` leaves the values as they are."""
    if digits is None:
        return df
    doubles = set(columns_of(df, T.DoubleType))
    return df.select(
        *[F.bround(col(c), digits).alias(c) if c in doubles else col(c) for c in df.columns]
    )
