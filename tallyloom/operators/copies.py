"""Identical rows, found without shuffling the rows that have no copy.

The hashes of all rows are counted first. A Bloom filter of the hashes that occur more than
once then parts the table: a row that it does not know occurs once, for sure, and stays where
it is; only the others are shuffled whole and compared exactly. So the result never rests on a
hash, and neither a collision nor a false hit of the filter changes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources.tables import stage
from tallyloom.spec import col

BITS_A_HASH = 16
MOST_WORDS = 1 << 20
FEW_ONCE = 0.05
NARROW_BYTES = 32


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of the row. Spark's hash passes over nulls, so where they are goes in, too."""
    columns = [col(c) for c in df.columns]
    return F.xxhash64(F.array(*[c.isNull() for c in columns]), *columns)


def split_repeated(df: DataFrame, most_words: int = MOST_WORDS) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows that occur once, and rows that may have copies (nearly all of them do).

    None stands for a part that is empty for sure. Counts the hashes before it returns; the
    parts then scan the table once each. The filter has 16 bits for each repeated hash, in at
    most ``most_words`` words of 64 bits, which bounds what is sent to the tasks (8 MB). With
    more repeated hashes than that (some 10 million) it lets more rows without copies through
    to the second part. Where hardly any row occurs once, all are in the second part, so that the
    table is read once instead of twice. Narrow rows, which are no larger than what is counted of them, and rows
    with values that Spark does not hash as it compares them are all in the second part.
    """
    if not df.columns or _narrow(df.schema) or not all(_hashed_as_compared(f.dataType) for f in df.schema):
        return None, df
    if not df._jdf.queryExecution().analyzed().deterministic():
        df = stage(df, "rows")  # the scans below have to see the same rows
    hash_ = row_hash(df)
    counted = df.select(hash_.alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    seen = Observation()
    counted = counted.observe(seen, F.count_if(F.col("n") == 1).alias("once"), F.sum("n").alias("rows"))
    repeated = stage(counted.where("n > 1").select("h"), "repeated")
    number = repeated.count()
    if not number:
        return df, None
    if seen.get["once"] <= (seen.get["rows"] or 0) * FEW_ONCE:
        return None, df
    words = 1
    while words * 64 < number * BITS_A_HASH and words < most_words:
        words *= 2
    known = _known(hash_, _filter(repeated, words), words)
    return df.where(~known), df.where(known)


def _word(hash_: Column, words: int) -> Column:
    return F.shiftrightunsigned(hash_, 12).bitwiseAND(F.lit(words - 1)).cast("int")


def _mask(hash_: Column) -> Column:
    """Two of the 64 bits of a word."""
    one = F.lit(1).cast("long")
    places = hash_.bitwiseAND(F.lit(63)).cast("int"), F.shiftrightunsigned(hash_, 6).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", one, places[0]).bitwiseOR(F.call_function("shiftleft", one, places[1]))


def _filter(hashes: DataFrame, words: int) -> DataFrame:
    """One row with the words of the filter, in order."""
    h = F.col("h")
    set_ = hashes.select(_word(h, words).alias("word"), _mask(h).alias("bits"))
    every = hashes.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    filled = set_.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return filled.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).getField("bits").alias("bits"))


def _known(hash_: Column, filter_: DataFrame, words: int) -> Column:
    mask = _mask(hash_)
    return filter_.scalar()[_word(hash_, words)].bitwiseAND(mask) == mask


def _narrow(schema: T.StructType) -> bool:
    width = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4}
    fixed = (*width, T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)
    return all(isinstance(f.dataType, fixed) for f in schema) and sum(width.get(type(f.dataType), 8) for f in schema) <= NARROW_BYTES


def _hashed_as_compared(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashed_as_compared(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _hashed_as_compared(kind.elementType)
    if isinstance(kind, T.StringType):
        return kind == T.StringType()  # other collations hold different texts equal
    return isinstance(kind, (T.NumericType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType))
