"""Tf-idf weights of exact terms, fitted on some rows and applied to others: an Estimator whose model is a table.

A fitted model numbers every term of its texts and knows how many of them hold
it.  Both lie in a table, sorted by term; no vocabulary is cut, hashed or kept
on the driver.  Weights are worked out once per distinct text and joined to the
rows that have it.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param.shared import HasInputCols, HasWeightCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.text import text_or_empty
from quillon.sources.work import Work, saved, shared_folder

from .numbering import numbered
from .retrieval import unigrams_bigrams


def _terms(text: Column) -> Column:
    return unigrams_bigrams(text)


class TermWeights(Estimator, HasInputCols, HasWeightCol):
    """Learns document frequencies of the words and pairs of neighbours of ``inputCols``, each text of each column a document.

    ``weightCol`` says how many times a row counts.
    """

    def __init__(self, inputCols: list[str] | None = None, weightCol: str | None = None) -> None:
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)
        if weightCol is not None:
            self._set(weightCol=weightCol)

    def _fit(self, dataset: DataFrame) -> TermWeightsModel:
        spark, folder = dataset.sparkSession, shared_folder(dataset.sparkSession, "terms")
        columns = self.getInputCols()
        times = F.col(self.getWeightCol()).cast("bigint") if self.isDefined(self.weightCol) else F.lit(1)
        texts = dataset.select(F.explode(F.array(*(text_or_empty(F.col(c)) for c in columns))).alias("text"), times.alias("n")).groupBy("text").agg(F.sum("n").alias("n"))
        with Work(spark) as work:
            counted = work.written(texts, "texts")
            n = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
            df = counted.select("n", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term")).groupBy("term").agg(F.sum("n").alias("df"))
            table = saved(numbered(df, ["term"], work, "id").withColumn("idf", F.log((1.0 + n) / (1 + F.col("df"))) + 1), f"{folder}/table")
        return self._copyValues(TermWeightsModel(table, n))


class TermWeightsModel(Model, HasInputCols, MLReadable, MLWritable):
    """``table`` (term, df, id, idf) of ``n`` documents; ``transform`` adds a sparse unit vector per input column, named with ``_weights``.

    Terms that the fit did not see are left out; a text without known terms has
    a vector of zeros.
    """

    def __init__(self, table: DataFrame, n: int) -> None:
        super().__init__()
        self.table, self.n = table, n
        self.size = table.count()

    def weights(self, dataset: DataFrame, column: str, name: str, met: DataFrame | None = None) -> DataFrame:
        """Adds ``name``: the ids of the column's known terms in order and their weights; with ``met`` (id) of these terms alone, with the lengths of whole texts."""
        key = F.md5(text_or_empty(F.col(column)))
        texts = dataset.select(key.alias("_key"), text_or_empty(F.col(column)).alias("_text")).dropDuplicates(["_key"])
        tf = texts.select("_key", F.explode(_terms(F.col("_text"))).alias("term")).groupBy("_key", "term").agg(F.count("*").alias("tf"))
        table = self.table.select("term", "id", "idf")
        kept = F.struct("id", "w")
        if met is not None:
            table, kept = table.join(met.select("id", F.lit(True).alias("_met")), "id", "left"), F.when(F.col("_met"), kept)
        weighed = tf.join(table, "term").withColumn("w", F.col("tf") * F.col("idf"))
        vectors = weighed.groupBy("_key").agg(F.array_sort(F.collect_list(kept)).alias("_l"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
        unit = vectors.select("_key", F.struct(F.col("_l.id").alias("ids"), F.transform("_l.w", lambda w: w / F.col("_norm")).alias("weights")).alias(name))
        none = F.struct(F.array().cast("array<bigint>").alias("ids"), F.array().cast("array<double>").alias("weights"))
        return dataset.withColumn("_key", key).join(unit, "_key", "left").drop("_key").withColumn(name, F.coalesce(name, none))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size = max(1, self.size)
        vector = F.udf(lambda x: Vectors.sparse(size, x["ids"], x["weights"]), VectorUDT())
        for column in self.getInputCols():
            dataset = self.weights(dataset, column, f"{column}_weights").withColumn(f"{column}_weights", vector(f"{column}_weights"))
        return dataset

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: TermWeightsModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"n": self.model.n})
        self.model.table.write.parquet(f"{path}/table")


class _ModelReader(MLReader):
    def load(self, path: str) -> TermWeightsModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TermWeightsModel(self.sparkSession.read.parquet(f"{path}/table"), metadata["n"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def sparse_dot(left: str, right: str, name: str):
    """A step for ``DataFrame.transform``: adds ``name``, the product of two columns made by ``weights``; the left one should be the shorter."""

    def added(rows: DataFrame) -> DataFrame:
        looked_up = rows.withColumn("_of", F.map_from_arrays(f"{right}.ids", f"{right}.weights"))
        parts = F.zip_with(f"{left}.ids", f"{left}.weights", lambda i, w: w * F.coalesce(F.try_element_at(F.col("_of"), i), F.lit(0.0)))
        return looked_up.withColumn(name, F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)).drop("_of")

    return added


def pair_text_pipeline(query: str = "query", item: str = "item", pair: str = "pair", label: str = "label", C: float = 4.0) -> Pipeline:
    """Tf-idf of query, item and pair texts side by side, each with its own terms, and a balanced logistic model."""
    from .text_logistic import TextLogistic

    return Pipeline(stages=[TextLogistic([query, item, pair], C, labelCol=label)])
