"""The classification model: assembly, training with evaluation, saving and checking."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.learning import metrics
from tallyloom.learning.features import feature_stages, feature_table, with_class_weight
from tallyloom.learning.split import stratified_split
from tallyloom.sources.tables import stage
from tallyloom.spec import TableSpec, col, feature_view


@dataclass(frozen=True)
class ForestSize:
    """Defaults of the full-size model; smaller ones for quick runs."""

    trees: int = 300
    depth: int = 18
    leaf_rows: int = 3
    memory_mb: int = 1024
    bins: int = 32  # cut points tried for a numeric feature


@dataclass(frozen=True)
class Evaluation:
    model: PipelineModel
    predictions: DataFrame
    sizes: DataFrame
    confusion: DataFrame
    report: DataFrame
    scores: DataFrame
    importance: DataFrame


def build_model(spec: TableSpec, size: ForestSize = ForestSize(), min_frequency: int = 10) -> Pipeline:
    """Feature stages and a random forest; ``fit`` wants a ``weight`` column next to the data."""
    index = StringIndexer(
        inputCol=spec.target, outputCol="label_index", stringOrderType="alphabetAsc", handleInvalid="error"
    )
    forest = RandomForestClassifier(
        labelCol="label_index",
        featuresCol="features",
        weightCol="weight",
        numTrees=size.trees,
        maxDepth=size.depth,
        minInstancesPerNode=size.leaf_rows,
        featureSubsetStrategy="sqrt",
        impurity="gini",
        maxMemoryInMB=size.memory_mb,
        maxBins=size.bins,
        seed=spec.seed,
    )
    features = feature_stages(list(spec.numeric), list(spec.categorical), min_frequency)
    return Pipeline(stages=[index, *features, forest])


def fit_model(df: DataFrame, spec: TableSpec, size: ForestSize = ForestSize()) -> PipelineModel:
    """Fit with balanced class weights; the fitted model predicts unlabelled rows too."""
    weighted = with_class_weight(feature_view(df, spec), spec.target)
    *stages, forest = build_model(spec, size).getStages()
    fitted = Pipeline(stages=stages).fit(weighted)
    # The forest reads its rows several times; encoded once, they are three columns.
    rows = stage(fitted.transform(weighted).select("features", "label_index", "weight"), "features")
    index, *features = fitted.stages
    named = IndexToString(inputCol="prediction", outputCol="predicted", labels=index.labels)
    # A copy has no training summary. That one holds the session, which would be sent to the
    # tasks with the model, and can't be once anything was observed in it.
    return PipelineModel([*features, forest.fit(rows).copy(), named])


def class_labels(model: PipelineModel) -> list[str]:
    return list(model.stages[-1].getLabels())


def predict(model: PipelineModel, df: DataFrame, positive: str) -> DataFrame:
    """Add ``predicted`` and ``score``, the probability of the positive class."""
    at = class_labels(model).index(positive)
    scored = model.transform(df).withColumn("score", vector_to_array("probability")[at])
    return scored.select(*[col(c) for c in df.columns], "predicted", "score")


def feature_importance(model: PipelineModel, df: DataFrame, top_n: int = 10) -> DataFrame:
    """Most important features by name: ``(feature, importance)``, ties in their order."""
    names = feature_table(model.transform(df.limit(0)))
    found = next(s for s in model.stages if hasattr(s, "featureImportances")).featureImportances
    # As many rows as the trees use features.
    rows = [(int(i), float(found[int(i)])) for i in found.toArray().nonzero()[0]]
    table = df.sparkSession.createDataFrame(rows, "position long, importance double")
    return (
        names.join(table, "position", "left")
        .select("position", "feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))
        .orderBy(F.col("importance").desc(), "position")
        .limit(top_n)
    )


def train_and_evaluate(
    df: DataFrame,
    spec: TableSpec,
    test_size: float = 0.2,
    size: ForestSize = ForestSize(),
    key: Sequence[str] | None = None,
) -> Evaluation:
    """Split, fit on the training rows only, evaluate on the test rows.

    The rows to split and the predictions are written to the shared folder: the fit
    reads the ones many times, every metric reads the others.
    """
    view = feature_view(df, spec)
    if key is not None:
        keyed = df.select(*[col(c) for c in dict.fromkeys([*spec.features, spec.target, *key])])
        split = stage(stratified_split(keyed, spec.target, test_size, spec.seed, key), "split")
    else:  # the numbered rows are on disk already, and the mark is cheap to compute
        split = stratified_split(view, spec.target, test_size, spec.seed)
    train, test = split.where(~F.col("is_test")), split.where("is_test")
    model = fit_model(train, spec, size)
    scored = predict(model, test, spec.positive_label)
    kept = scored.select(col(spec.target).alias("actual"), "predicted", "score")
    predictions = stage(kept, "predictions")
    cells = metrics.confusion(predictions, "actual", "predicted", zeros=False)
    auc = metrics.roc_auc(predictions, "score", F.col("actual") == spec.positive_label)
    single = metrics.scores(cells, spec.positive_label).withColumn(
        "roc_auc", auc.select("roc_auc").scalar()
    )
    sizes = split.agg(
        F.count_if(~F.col("is_test")).alias("n_train"), F.count_if(F.col("is_test")).alias("n_test")
    )
    return Evaluation(
        model=model,
        predictions=predictions,
        sizes=sizes,
        confusion=metrics.confusion(predictions, "actual", "predicted"),
        report=metrics.classification_report(cells),
        scores=single,
        importance=feature_importance(model, train),
    )


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def verify_reload(path: str, model: PipelineModel, sample: DataFrame, positive: str) -> bool:
    """Whether the saved model loads and predicts the sample as the one in hand does.

    Any failure on the way counts as no, and its cause is logged.
    """
    try:
        mine = predict(model, sample, positive)
        theirs = predict(PipelineModel.load(path), sample, positive)
        return mine.exceptAll(theirs).isEmpty() and theirs.exceptAll(mine).isEmpty()
    except Exception:  # noqa: BLE001 - the answer is the verdict, whatever went wrong
        logging.getLogger(__name__).exception("the model at %s did not answer", path)
        return False
