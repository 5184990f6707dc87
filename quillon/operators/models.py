"""Models over pair features and texts with Spark ML, out of fold."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows of a partition while models train.
PARTITION_ROWS = 50_000


def balanced_weights(rows: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``weight``: the inverse of the class's share."""
    counts = {r[0]: r.n for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    chain = F.when(F.lit(False), F.lit(1.0))
    for value, n in counts.items():
        chain = chain.when(F.col(label) == value, F.lit(total / (len(counts) * n)))
    return rows.withColumn("weight", chain.otherwise(1.0))


def tabular_pipeline(columns: list[str], label: str = "label", iterations: int = 10, seed: int = 7) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep"), GBTClassifier(labelCol=label, maxIter=iterations, maxDepth=4, stepSize=0.1, seed=seed)])


def out_of_fold(rows: DataFrame, pipeline: Pipeline, folds: int, key: str = "id", label: str = "label", model: str = "model") -> DataFrame:
    """(key, label, fold, proba, model_name): each fold scored by a model of the other folds.

    A fold whose training rows hold one class gets that class's share.  The rows
    are kept while the models train, in partitions of about ``PARTITION_ROWS``.
    """
    rows = rows.persist()
    rows = rows.coalesce(max(1, rows.count() // PARTITION_ROWS))
    parts = []
    for fold in range(folds):
        train, test = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        classes = [r[0] for r in train.select(label).distinct().collect()]
        if len(classes) < 2:
            parts.append(test.select(key, label, "fold", F.lit(float(classes[0]) if classes else 0.0).alias("proba")))
        else:
            scored = pipeline.fit(train).transform(test)
            parts.append(scored.select(key, label, "fold", vector_to_array("probability")[1].alias("proba")))
    return reduce(DataFrame.unionByName, parts).withColumn("model_name", F.lit(model))


def fitted_logistic(rows: DataFrame, columns: list[str], label: str = "label") -> Callable[[DataFrame], DataFrame]:
    """A class-balanced logistic model of numeric columns; the result adds its probability as ``proba`` to a table.

    Rows of one class alone give that class to every row.
    """
    classes = [r[0] for r in rows.select(label).distinct().collect()]
    if len(classes) < 2:
        share = float(classes[0]) if classes else 0.0
        return lambda df: df.withColumn("proba", F.lit(share))
    stages = [VectorAssembler(inputCols=columns, outputCol="_features", handleInvalid="keep"), StandardScaler(inputCol="_features", outputCol="_scaled", withMean=True), LogisticRegression(featuresCol="_scaled", labelCol=label, weightCol="weight", maxIter=50)]
    model = Pipeline(stages=stages).fit(balanced_weights(rows, label))
    made = ("_features", "_scaled", "rawPrediction", "probability", "prediction")
    return lambda df: model.transform(df).withColumn("proba", F.round(vector_to_array("probability")[1], 6)).drop(*made)


def stacked(wide: DataFrame, models: list[str], folds: int, fold: str = "fold", label: str = "label") -> DataFrame:
    """Adds ``stacked``: a logistic model over the models' scores, each fold scored by one of the other folds."""
    parts = [fitted_logistic(wide.where(F.col(fold) != f), models, label)(wide.where(F.col(fold) == f)).withColumnRenamed("proba", "stacked") for f in range(folds)]
    return reduce(DataFrame.unionByName, parts)


def importance(model, columns: list[str]) -> list[tuple[str, float]]:
    """Feature importances of a fitted tabular pipeline, largest first; zeros for a model without any."""
    stage = model.stages[-1]
    values = stage.featureImportances.toArray() if hasattr(stage, "featureImportances") else [0.0] * len(columns)
    return sorted(zip(columns, map(float, values), strict=True), key=lambda x: (-x[1], x[0]))


def mean_importance(rows: DataFrame, pipelines: dict[str, tuple[Pipeline, list[str]]], folds: int, fold: str = "fold") -> DataFrame:
    """(feature, importance): the mean importance over the models of all folds and pipelines, largest first.

    Each model is trained on the rows outside its fold.  A feature that a model
    does not use counts as 0 there.
    """
    names = sorted({c for _, columns in pipelines.values() for c in columns})
    found = []
    for f in range(folds):
        train = rows.where(F.col(fold) != f)
        for pipeline, columns in pipelines.values():
            own = dict(importance(pipeline.fit(train), columns))
            found += [(name, own.get(name, 0.0)) for name in names]
    return rows.sparkSession.createDataFrame(found, "feature string, value double").groupBy("feature").agg(F.avg("value").alias("importance")).orderBy(F.desc("importance"), "feature")
