"""String rules: trimming, missing-value tokens and label endings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.spec import col, string_columns

# The characters Unicode calls white space, and the four separators that
# text tools count with them.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_space(c: Column) -> Column:
    """Strip all white space at both ends, also what Unicode counts as such."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def strip_strings(df: DataFrame) -> DataFrame:
    strings = set(string_columns(df))
    return df.select(*[strip_space(col(c)).alias(c) if c in strings else col(c) for c in df.columns])


def tokens_to_null(df: DataFrame, tokens: Iterable[str]) -> DataFrame:
    """Turn missing-value tokens in string columns into nulls."""
    strings, tokens = set(string_columns(df)), list(tokens)
    return df.select(
        *[
            F.when(~col(c).isin(tokens), col(c)).alias(c) if c in strings else col(c)
            for c in df.columns
        ]
    )


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop the rows in which every column is null."""
    return df.na.drop(how="all")


def clean_label(c: Column) -> Column:
    """Strip white space, then all trailing dots."""
    return F.rtrim(strip_space(c), F.lit("."))
