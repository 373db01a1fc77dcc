"""Rows of the census columns with known gaps and copies.

Row k of ``people`` holds: an age that is missing in every 40th row, a work class that is
missing in every 25th, an occupation missing in every 60th. ``copied`` rows follow again.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEVELS = {
    "workclass": ["Local-gov", "Never-worked", "Without-pay", "Federal-gov"],
    "education": ["Masters", "Assoc-voc", "10th"],
    "marital-status": ["Divorced", "Widowed", "Separated"],
    "occupation": ["Craft-repair", "Priv-house-serv", "Armed-Forces", "Adm-clerical", "Farming-fishing"],
    "relationship": ["Unmarried", "Own-child", "Wife"],
    "race": ["Other", "Amer-Indian-Eskimo", "Asian-Pac-Islander"],
    "sex": ["Female", "Male"],
    "native-country": ["Peru", "Laos", "Greece", "Cuba"],
    "income": ["<=50K", "<=50K", ">50K"],
}
NUMBERS = {
    "age": (17, 90),
    "fnlwgt": (12_000, 1_400_000),
    "education-num": (1, 16),
    "capital-gain": (0, 99_999),
    "capital-loss": (0, 4_356),
    "hours-per-week": (1, 99),
}
GAPS = {"age": 40, "workclass": 25, "occupation": 60}


def people(spark: SparkSession, columns: list[str], rows: int = 600, copied: int = 8) -> DataFrame:
    def value(name: str) -> Column:
        h = F.xxhash64(F.lit(f"column {name}"), "id")
        if name in NUMBERS:
            low, high = NUMBERS[name]
            drawn = F.pmod(h, F.lit(high - low + 1)) + low
        else:
            drawn = F.element_at(F.array(*map(F.lit, LEVELS[name])), (F.pmod(h, F.lit(len(LEVELS[name]))) + 1).cast("int"))
        gap = F.col("id") % GAPS[name] == GAPS[name] - 1 if name in GAPS else F.lit(False)
        return F.when(~gap, drawn).alias(name)

    table = spark.range(rows).select("id", *[value(c) for c in columns])
    return table.unionByName(table.where(F.col("id") < copied)).drop("id")
