"""Delimited text with an explicit schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.text import drop_empty_rows, strip_strings, tokens_to_null
from tallyloom.spec import col

NULL_TOKENS = ("?",)
# Further spellings of a missing value that table readers know.
MORE_NULL_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_tokens: Iterable[str] = NULL_TOKENS,
    sep: str = ",",
    line_breaks: bool = False,
) -> DataFrame:
    """Headerless delimited file, columns named and typed by position.

    White space around values is dropped, the tokens and blank values are null, quoted
    ones too, and blank lines are skipped. A value that does not fit its type is null. All
    columns are read as text first, so that a token counts as null in a column of any type.
    With ``line_breaks`` quoted values may hold some; such files cannot be split, so one
    task reads each.
    """
    raw = _text_reader(spark, schema, sep, line_breaks).csv(path)
    return _typed(tokens_to_null(strip_strings(raw), [*null_tokens, ""]), schema)


def read_tolerant(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_tokens: Iterable[str] = NULL_TOKENS,
    sep: str = ",",
    line_breaks: bool = False,
) -> DataFrame:
    """As ``read_delimited`` for untidy files.

    Surplus fields of a long line are dropped, and rows without any value are left out.
    """
    raw = _text_reader(spark, schema, sep, line_breaks).csv(path)
    blank_free = tokens_to_null(strip_strings(raw), [*null_tokens, ""])
    return _typed(drop_empty_rows(blank_free), schema)


def _text_reader(spark: SparkSession, schema: T.StructType, sep: str, line_breaks: bool):
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    # A quote is seen only where no blank stands before it.
    return (
        spark.read.schema(text)
        .option("header", False)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("ignoreLeadingWhiteSpace", True)
        .option("multiLine", line_breaks)
    )


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    def cast(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.StringType):
            return col(f.name)
        return col(f.name).try_cast(f.dataType).alias(f.name)

    return df.select(*[cast(f) for f in schema.fields])


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.mode("overwrite").option("header", False).option("sep", sep).csv(path)
    return path


def column_names(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Name the columns by position."""
    return df.toDF(*names)
