"""A cleaning pipeline over documents: each stage works on all that the one before it kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.llm import language, toxicity
from quillon.llm.common import BATCH_BYTES, crc32_of_id, setting, table, written
from quillon.llm.decontamination import decontaminate
from quillon.llm.jaccard_join import join_components
from quillon.llm.packing import pack_documents

#: A document is rejected for its language where the language is unknown or less certain than this.
LANGUAGE_SCORE = 0.35
#: Size of an Arrow batch. Rows carry whole documents, and a task holds a batch in the JVM and again in its Python worker.
BATCH = "4m"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _small_batches(stage: Stage) -> Stage:
    """The stage in a session with batches of ``BATCH``; the setting stays, as the caller writes the result later."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH_BYTES, BATCH)
        return stage(spark, docs, sf_dir)

    return run


def _carried(docs: DataFrame) -> DataFrame:
    """All columns as one struct beside the text, so that no column clashes with an operator's own."""
    return docs.select(F.struct("*").alias("doc"), F.col("text").alias("text"))


@_small_batches
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose toxicity score is below 0.5; a null or empty text is scored like any other."""
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels, crc32_of_id() % 5 != 0)
    return toxicity.score(_carried(docs), model, id_col="doc").where("predicted = 0").select("doc.*")


@_small_batches
def reject_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised; null texts and texts without letters go."""
    trees = language.train(docs.select("doc_id", "text", "lang"), F.crc32(F.col("id").cast("string").cast("binary")) % 4 != 2)
    found = language.identify(_carried(docs), trees, id_col="doc")
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LANGUAGE_SCORE)).select("doc.*")


@_small_batches
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays.

    Rows of that id with one text stay once, rows of other texts beside it;
    documents without an id all stay.
    """
    groups = join_components(docs.select("doc_id", "text"))
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.select("doc_id", F.struct("*").alias("doc")).join(first, "doc_id", "left_semi")
    once = Window.partitionBy("doc_id", F.sha2("doc.text", 256)).orderBy(F.lit(0))
    one = kept.select("doc", F.row_number().over(once).alias("place")).where("place = 1").select("doc.*")
    return one.unionByName(docs.where("doc_id IS NULL"))


@_small_batches
def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which no window of a benchmark item occurs; a null or empty text has none."""
    found = decontaminate(_carried(docs), table(spark, sf_dir, "benchmark", "item_id", "text"), id_col="doc")
    return found.where(F.size("hits") == 0).select("doc.*")


@_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens of all documents that are left; a null text is its end alone, no documents give no sequences."""
    return pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", reject_toxic),
    ("language_id", reject_unknown_language),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", reject_contaminated),
    ("packing", pack),
]

#: Trained models, whole-text similarity and tokenisers are beyond SQL; tests/llm/test_pipeline.py compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again; an empty table gives an empty result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with setting(spark, BATCH_BYTES, BATCH):
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
