"""Feature stages: median fill and scaling, mode fill and one-hot levels, class weights."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLWritable,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.profile import modes_of, value_counts
from tallyloom.operators.rank import medians, row_numbers, with_stats
from tallyloom.sources.tables import stage, staging_path, write_table
from tallyloom.spec import as_double, col, require_columns

INFREQUENT = "infrequent"
# What is broadcast of the levels of all columns: so many of at most so many characters.
HEAD_LEVELS, HEAD_CHARS = 50_000, 100


class _Columns(HasInputCols, HasOutputCols):
    def _require(self, df: DataFrame) -> list[str]:
        require_columns(df, self.getInputCols())
        return self.getInputCols()


class NumericPrep(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fill with the exact median, then centre and scale by the population deviation."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> NumericPrepModel:
        columns = self._require(df)
        middle = {r["column"]: r["median"] for r in medians(df, columns).collect()}
        empty = [c for c in columns if c not in middle]
        if empty:
            raise ValueError(f"numeric features without any value: {empty}")
        filled = [F.coalesce(as_double(df, c), F.lit(middle[c])) for c in columns]
        row = df.agg(*[F.avg(v) for v in filled], *[F.stddev_pop(v) for v in filled]).first()
        k = len(columns)
        model = NumericPrepModel()
        model._set(
            inputCols=columns,
            outputCols=self.getOutputCols(),
            medians=[middle[c] for c in columns],
            means=list(row[:k]),
            scales=[s if s > 0 else 1.0 for s in row[k:]],
        )
        return model


class NumericPrepModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "fill values", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "centres", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "divisors", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = self._require(df)
        fitted = zip(*[self.getOrDefault(p) for p in ("medians", "means", "scales")])
        scaled = {
            out: (F.coalesce(as_double(df, c), F.lit(fill)) - F.lit(mean)) / F.lit(scale)
            for c, out, (fill, mean, scale) in zip(columns, self.getOutputCols(), fitted)
        }
        return df.withColumns(scaled)


class CategoryLevels(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Mode fill and level numbers for one-hot encoding.

    Levels with fewer than ``minFrequency`` training rows share one number. A value the
    training rows did not hold gets the last number, which the encoder drops to zeros.

    The levels of all columns are one table, numbered inside Spark by their order: columns
    as given, in each the frequent levels by value, then the shared number. The driver
    learns how many there are of each column, and no level but the fill values.
    """

    minFrequency = Param(Params._dummy(), "minFrequency", "rows a level needs", TypeConverters.toInt)
    headLevels = Param(Params._dummy(), "headLevels", "levels that are broadcast at most", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: list[str] | None = None,
        outputCols: list[str] | None = None,
        minFrequency: int = 10,
        headLevels: int = HEAD_LEVELS,
    ):
        super().__init__()
        self._setDefault(minFrequency=10, headLevels=HEAD_LEVELS)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> CategoryLevelsModel:
        columns = self._require(df)
        # Counted once; missing values are added to the level that fills them.
        known = stage(value_counts(df, columns), "levels")
        most = {r["column"]: r for r in modes_of(known).collect()}
        empty = [c for c in columns if c not in most]
        if empty:
            raise ValueError(f"categorical features without any value: {empty}")
        found, rows = {c: most[c]["mode"] for c in columns}, df.count()
        pos = (F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column")) - 1).cast("int")
        fill = F.array(*[F.lit(found[c]) for c in columns])
        missing = F.array(*[F.lit(rows - most[c]["n_known"]).cast("long") for c in columns])
        counts = known.select(pos.alias("pos"), "value", "n").withColumn(
            "n", F.col("n") + F.when(F.col("value") == fill[F.col("pos")], missing[F.col("pos")]).otherwise(0)
        )
        enough = F.col("n") >= self.getOrDefault("minFrequency")
        entries = counts.where(enough).select("pos", F.lit(False).alias("rare"), "value", "n").unionByName(
            counts.where(~enough).groupBy("pos").agg(
                F.lit(True).alias("rare"), F.lit(INFREQUENT).alias("value"), F.sum("n").alias("n")
            )
        )
        order = [F.col("pos"), F.col("rare"), F.col("value")]
        names_place = write_table(row_numbers(entries, order, "at"), staging_path(df.sparkSession, "level_numbers"))
        ranked = df.sparkSession.read.parquet(names_place)
        # As many rows as columns.
        spans = {r["pos"]: r for r in ranked.groupBy("pos").agg(F.min("at").alias("low"), F.count("*").alias("n"), F.max("rare").alias("rare")).collect()}
        first = F.array(*[F.lit(spans[i]["low"]) for i in range(len(columns))])
        shared = F.array(*[F.lit(spans[i]["n"] - 1) for i in range(len(columns))])
        levels = (
            ranked.where("NOT rare")
            .select("pos", "value", (F.col("at") - first[F.col("pos")]).cast("int").alias("slot"), "n")
            .unionByName(counts.where(~enough).select("pos", "value", shared[F.col("pos")].cast("int").alias("slot"), "n"))
        )
        spark, limit = df.sparkSession, self.getOrDefault("headLevels")
        model = CategoryLevelsModel()
        model.places = {"names": names_place, "head": write_table(levels, staging_path(spark, "levels"))}
        long = F.length("value") > HEAD_CHARS
        total, n_long = model.table("head").agg(F.count("*"), F.count_if(long)).first()
        tail = 0
        if total > limit or n_long:
            # Levels that are not long and most frequent, as many as the parameter allows.
            held = spark.read.parquet(model.places["head"])
            head = held.where(~long).orderBy(F.col("n").desc(), "pos", "value").limit(limit).drop("n")
            model.places["head"] = write_table(head, staging_path(spark, "head_levels"))
            rest = held.join(F.broadcast(model.table("head")), ["pos", "value"], "left_anti")
            model.places["tail"] = write_table(rest, staging_path(spark, "tail_levels"))
            tail = total - model.table("head").count()
        model._set(
            inputCols=columns,
            outputCols=self.getOutputCols(),
            fills=[found[c] for c in columns],
            widths=[spans[i]["n"] for i in range(len(columns))],
            tailLevels=tail,
        )
        return model


class CategoryLevelsModel(Model, _Columns, MLReadable, MLWritable):
    """Adds the level number of each column as a double, ``widths[i]`` for unseen values.

    The most frequent levels are broadcast, at most ``headLevels`` of at most ``HEAD_CHARS``
    characters, so rows stay where they are. If there are others, rows are written to the
    shared folder under a number, the values not found yet of all columns meet the other
    levels in one shuffle, and what they find returns to their rows.
    """

    fills = Param(Params._dummy(), "fills", "fill values", TypeConverters.toListString)
    widths = Param(Params._dummy(), "widths", "level numbers per column", TypeConverters.toListInt)
    tailLevels = Param(Params._dummy(), "tailLevels", "levels that are not broadcast", TypeConverters.toInt)

    places: dict[str, str]

    def table(self, name: str) -> DataFrame:
        own = {"names": "at long", "head": "slot int", "tail": "slot int, n long"}  # n: training rows
        schema = f"pos int, value string, {own[name]}"
        return SparkSession.active().read.schema(schema).parquet(self.places[name])

    def level_names(self) -> DataFrame:
        """``(column, at, name)`` of all encoded levels, numbered over all columns."""
        names = F.array(*[F.lit(c) for c in self.getInputCols()])
        return self.table("names").select(names[F.col("pos")].alias("column"), "at", F.col("value").alias("name"))

    def slots(self) -> dict[str, list[str]]:
        """Names of the encoded levels per column, in order; for columns of few levels."""
        rows = self.level_names().orderBy("at").collect()
        return {c: [r["name"] for r in rows if r["column"] == c] for c in self.getInputCols()}

    def _transform(self, df: DataFrame) -> DataFrame:
        columns, fills = self._require(df), self.getOrDefault("fills")
        widths = self.getOrDefault("widths")
        held = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
        values = [F.coalesce(F.col(f"c{df.columns.index(c)}").cast("string"), F.lit(fill)) for c, fill in zip(columns, fills)]
        for i, value in enumerate(values):
            side = self.table("head").where(F.col("pos") == i).select(F.col("value").alias("_value"), F.col("slot").alias(f"_s{i}"))
            held = held.join(F.broadcast(side), value == F.col("_value"), "left").drop("_value")
        found = [F.col(f"_s{i}") for i in range(len(columns))]
        if self.getOrDefault("tailLevels"):
            held = stage(held.withColumn("_row", F.monotonically_increasing_id()), "rows")
            open_ = [F.when(s.isNull(), F.struct(F.lit(i).alias("pos"), v.alias("value"))) for i, (s, v) in enumerate(zip(found, values))]
            missed = held.select("_row", F.inline(F.array_compact(F.array(*open_))))
            met = with_stats(missed, self.table("tail"), ["pos", "value"], "n").groupBy("_row").agg(
                *[F.max(F.when(F.col("pos") == i, F.col("slot"))).alias(f"_t{i}") for i in range(len(columns))]
            )
            held = held.join(met, "_row", "left")
            found = [F.coalesce(s, F.col(f"_t{i}")) for i, s in enumerate(found)]
        slots = {
            out: F.coalesce(found[i], F.lit(width)).cast("double").alias(
                out, metadata={"column": columns[i], "width": width, "pos": i, "low": sum(widths[:i]), "names": self.places["names"]}
            )
            for i, (out, width) in enumerate(zip(self.getOutputCols(), widths))
        }
        kept = [F.col(f"c{i}").alias(c, metadata=df.schema[i].metadata) for i, c in enumerate(df.columns) if c not in slots]
        return held.select(*kept, *slots.values())

    def write(self) -> DefaultParamsWriter:
        return _LevelsWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _LevelsReader(cls)


class _LevelsWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        for name in self.instance.places:
            self.instance.table(name).write.parquet(f"{path}/{name}")


class _LevelsReader(DefaultParamsReader):
    def load(self, path: str) -> CategoryLevelsModel:
        model = super().load(path)
        model.places = {n: f"{path}/{n}" for n in ("head", "names", *(["tail"] if model.getOrDefault("tailLevels") else []))}
        return model


class FeatureVector(Transformer, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One sparse vector of the numbers and the one-hot levels of a row.

    Numbers come first, then a place for each level of each slot column. The widths of the
    slot columns stand in their metadata; names are not in the vector's metadata, whatever
    the number of levels (see ``feature_table``).
    """

    numbers = Param(Params._dummy(), "numbers", "columns of doubles", TypeConverters.toListString)
    slots = Param(Params._dummy(), "slots", "columns of level numbers", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, numbers: list[str] | None = None, slots: list[str] | None = None, outputCol: str | None = None):
        super().__init__()
        self._setDefault(numbers=[], slots=[])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        numbers, slots = self.getOrDefault("numbers"), self.getOrDefault("slots")
        widths = [df.schema[c].metadata["width"] for c in slots]
        size = len(numbers) + sum(widths)
        if size >= 2**31:
            raise ValueError(f"{size} features are more than a vector has places")
        begin = np.cumsum([len(numbers), *widths])[:-1]
        ends = np.array(widths)

        def build(number: pa.Array, slot: pa.Array) -> pa.Array:
            rows = len(number)
            x = number.flatten().to_numpy(zero_copy_only=False).reshape(rows, len(numbers))
            s = slot.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, len(slots))
            at = np.concatenate([np.broadcast_to(np.arange(len(numbers)), x.shape), s + begin], axis=1)
            full = np.concatenate([x != 0, s < ends], axis=1)
            values = np.concatenate([x, np.ones(s.shape)], axis=1)[full]
            upto = pa.array(np.concatenate([[0], np.cumsum(full.sum(axis=1))]), pa.int32())
            return pa.StructArray.from_arrays(
                [
                    pa.array(np.zeros(rows), pa.int8()),  # fixed value: 0 marks a sparse vector
                    pa.array(np.full(rows, size), pa.int32()),
                    pa.ListArray.from_arrays(upto, pa.array(at[full], pa.int32())),
                    pa.ListArray.from_arrays(upto, pa.array(values, pa.float64())),
                ],
                names=["type", "size", "indices", "values"],
            )

        def all_of(names: list[str]) -> Column:
            return F.array(*[col(c).cast("double") for c in names]) if names else F.array().cast("array<double>")

        vector = F.arrow_udf(build, VectorUDT())(all_of(numbers), all_of(slots))
        made = {"numbers": numbers, "levels": [df.schema[c].metadata for c in slots]}
        out = self.getOutputCol()
        return df.withColumn(out, vector).withMetadata(out, made)


def feature_stages(
    numeric: list[str], categorical: list[str], min_frequency: int = 10, output: str = "features"
) -> list:
    """Numeric block, then one-hot block; features are named num__x and cat__x_level.

    A block without columns is left out.
    """
    scaled, slots = [f"num__{c}" for c in numeric], [f"slot__{c}" for c in categorical]
    if not numeric and not categorical:
        raise ValueError("a model needs at least one feature")
    stages: list = [NumericPrep(inputCols=numeric, outputCols=scaled)] if numeric else []
    if categorical:
        stages.append(CategoryLevels(inputCols=categorical, outputCols=slots, minFrequency=min_frequency))
    return [*stages, FeatureVector(numbers=scaled, slots=slots, outputCol=output)]


def vector_places(vector: Column) -> Column:
    """The places of a sparse vector that hold something."""
    return F.arrow_udf(lambda v: v.field("indices"), "array<int>")(vector)


def feature_table(df: DataFrame, column: str = "features") -> DataFrame:
    """``(position, feature)``: the name of each place of a vector, ``num__x`` or ``cat__x_level``.

    The vector's metadata tells the columns it is made of and where the names of their
    levels are; the names stay in that table.
    """
    made = df.schema[column].metadata
    numbers, levels = made["numbers"], made["levels"]
    out = df.sparkSession.createDataFrame(list(enumerate(numbers)), "position long, feature string")
    at = len(numbers)
    for one in levels:
        named = df.sparkSession.read.parquet(one["names"]).where(F.col("pos") == one["pos"])
        out = out.unionByName(
            named.select(
                (F.col("at") + F.lit(at - one["low"])).alias("position"),
                F.concat(F.lit(f"cat__{one['column']}_"), "value").alias("feature"),
            )
        )
        at += one["width"]
    return out


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """The same as a list in order, for vectors of few places."""
    return [r["feature"] for r in feature_table(df, column).orderBy("position").collect()]


def class_table(df: DataFrame, label: str) -> DataFrame:
    """``(label, n)``: rows per class, in the shared folder; a missing label is an error."""
    require_columns(df, [label])
    counts = df.groupBy(col(label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    held = stage(counts, "classes")
    if not held.where("label IS NULL").isEmpty():
        raise ValueError(f"{label} contains missing values")
    return held


def class_weights(classes: DataFrame) -> DataFrame:
    """``(label, weight)`` with balanced weights: rows / (classes x rows of the class)."""
    return classes.select("label", _balanced(classes).alias("weight"))


def _balanced(classes: DataFrame) -> Column:
    total, number = classes.agg(F.sum("n"), F.count(F.lit(1))).first()
    return F.lit(float(total or 0)) / (F.lit(number) * F.col("n"))


def with_class_weight(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    classes = class_table(df, label)
    weights = classes.select(F.col("label").alias("_label"), _balanced(classes).alias("_weight"), F.col("n").alias("_size"))
    # Under names of their own, so that no column of the table meets one of the weights.
    inner = {c: f"c{i}" for i, c in enumerate(df.columns)}
    rows = df.select(*[col(c).alias(n) for c, n in inner.items()], col(label).cast("string").alias("_label"))
    met = with_stats(rows, weights, ["_label"], "_size")
    return met.select(*[F.col(n).alias(c) for c, n in inner.items() if c != output], F.col("_weight").alias(output))
