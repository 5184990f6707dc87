"""Stored search indexes: postings in blocks of documents with each block's largest weight, and latent spaces, by version.

Documents of like length share a block of ``block_docs``, which keeps the
largest weight of a block near the others.  A search first adds up, per query
and block, what the block could score at most, from columns that hold no
postings; it scores the most promising blocks, and then those of the rest whose
bound reaches the k-th score found.  Postings lie in folders by a hash of their
term, so a search opens the folders of the terms that are asked for alone.
Texts are never read again.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.text import retrieval_tokens
from quillon.sources.work import Work, saved, shared_folder

from .joins import cut
from .latent import LatentSpace, fit_latent
from .numbering import numbered
from .retrieval import dense_search, hybrid, query_terms, spread, term_search, top_k

#: Folders of postings, and documents from which on each is written as one more file.
BUCKETS, FILE_DOCS = 64, 1_000_000
#: Documents whose blocks are made in one task.
TASK_DOCS = 8_192


def versioned(root: str, name: str, config: dict) -> str:
    """The folder of a stored result below ``root``: its name, then the first twelve digits of its configuration's SHA-1."""
    bare = re.sub("[^a-z0-9]+", "_", name.lower()).strip("_") or "unknown"
    return f"{root.rstrip('/')}/{bare}/{hashlib.sha1(json.dumps(config, sort_keys=True).encode()).hexdigest()[:12]}"


def _bucket(term):
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


class LexicalIndex:
    """A stored BM25 index in ``folder``: ``postings``, ``terms`` and ``facts``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.folder = folder
        self.postings, self.terms = spark.read.parquet(f"{folder}/postings"), spark.read.parquet(f"{folder}/terms")
        facts = spark.read.parquet(f"{folder}/facts").first()
        self.n, self.avgdl, self.k1, self.b, self.doc_id = facts.n, facts.avgdl, facts.k1, facts.b, facts.doc_id

    def _asked(self, queries: DataFrame, query_id: str, query: str) -> DataFrame:
        """(query, bucket, term, weight): a repeated term of a query counts repeatedly."""
        asked = query_terms(queries, query_id, query).withColumn("bucket", _bucket("term"))
        return asked.join(self.terms, ["bucket", "term"]).select(query_id, "bucket", "term", (F.col("qtf") * F.col("idf")).alias("weight"))

    def bounds(self, queries: DataFrame, query_id: str, query: str) -> DataFrame:
        """(query, block, bound): the most that a document of a block can score; blocks without an asked term are not listed."""
        heads = self.postings.select("bucket", "term", "block", "most")
        met = heads.join(F.broadcast(self._asked(queries, query_id, query)), ["bucket", "term"])
        return met.groupBy(query_id, "block").agg(F.sum(F.col("weight") * F.col("most")).alias("bound"))

    def _part(self):
        """What one occurrence list of a document gives a term of weight 1."""
        tf, dl = F.col("tf"), F.col("dl")
        return tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * dl / (self.avgdl or 1.0)))

    def _scores(self, blocks: DataFrame, asked: DataFrame, query_id: str, excluded: DataFrame | None, places: int) -> DataFrame:
        wanted = blocks.select(query_id, "block").join(asked, query_id)
        met = self.postings.drop("most").join(wanted, ["bucket", "term", "block"])
        each = met.select(query_id, "weight", F.inline(F.arrays_zip("docs", "tf", "dl")))
        scored = each.groupBy(query_id, F.col("docs").alias(self.doc_id)).agg(F.round(F.sum(F.col("weight") * self._part()), places).alias("bm25")).where("bm25 > 0")
        return scored if excluded is None else scored.join(excluded, [query_id, self.doc_id], "left_anti")

    def reading(self, queries: DataFrame, query_id: str, query: str, k: int, first: int = 4, excluded: DataFrame | None = None, places: int = 6) -> tuple[DataFrame, DataFrame]:
        """The blocks of every query with whether they are ``read``, and the scores of the documents in those."""
        asked = cut(self._asked(queries, query_id, query))
        bounds = cut(self.bounds(queries, query_id, query))
        start = top_k(bounds, query_id, [F.desc("bound"), F.asc("block")], first, "_place").select(query_id, "block")
        begun = cut(self._scores(start, asked, query_id, excluded, places))
        # a query whose first blocks hold fewer than k documents has no k-th score and reads on
        least = top_k(begun, query_id, [F.desc("bm25"), F.asc(self.doc_id)], k, "_place").where(F.col("_place") == k).select(query_id, F.col("bm25").alias("least"))
        opened = start.withColumn("begun", F.lit(True))
        marked = bounds.join(opened, [query_id, "block"], "left").join(least, query_id, "left")
        reached = F.col("least").isNull() | (F.col("bound") + 10.0**-places >= F.col("least"))
        marked = marked.withColumn("read", F.coalesce("begun", F.lit(False)) | reached)
        rest = self._scores(marked.where("read AND begun IS NULL"), asked, query_id, excluded, places)
        return marked.select(query_id, "block", "bound", "read"), begun.unionByName(rest)

    def search(self, queries: DataFrame, query_id: str, query: str, k: int, first: int = 4, excluded: DataFrame | None = None, places: int = 6) -> DataFrame:
        """(query, doc, bm25, rank): the same hits as ``bm25_search`` of the documents; (query, doc) pairs in ``excluded`` are left out.

        Blocks that some query has to read are scored against all queries, a
        bounded number of documents and queries in a task, and only the hits go
        on.  The queries are taken to be few enough to be broadcast with their
        terms; cut a larger set into parts.
        """
        asked = cut(self._asked(queries, query_id, query))
        blocks, _ = self.reading(queries, query_id, query, k, first, excluded, places)
        read = cut(blocks.where("read").select("block").distinct())
        lists = self.postings.join(asked.select("bucket", "term").distinct(), ["bucket", "term"], "left_semi").join(read, "block", "left_semi")
        p = lists.select("term", F.inline(F.arrays_zip("docs", "tf", "dl"))).select(F.col("docs").alias(self.doc_id), "term", self._part().alias("x"))
        return term_search(p, asked.select(query_id, "term", F.col("weight").alias("w")), self.n, self.doc_id, query_id, k, places, "bm25", excluded=excluded)


def _lists(avgdl: float, k1: float, b: float):
    """A function from the documents of one block to its postings, a row per term with the largest weight."""

    def made(group: pa.Table) -> pa.Table:
        group = group.take(np.argsort(group.column("number").to_numpy(), kind="stable"))
        tokens = group.column("t").combine_chunks()
        encoded = tokens.flatten().dictionary_encode()
        dl = group.column("dl").to_numpy()
        of = np.repeat(np.arange(len(group)), np.diff(tokens.offsets.to_numpy()))
        cells, tf = np.unique(encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(group) + of, return_counts=True)
        term, doc = np.divmod(cells, len(group))
        part = tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl[doc] / (avgdl or 1.0)))
        starts = np.searchsorted(term, np.arange(len(encoded.dictionary) + 1)).astype("<i4")
        most = np.maximum.reduceat(part, starts[:-1]) if len(cells) else part
        listed = lambda values: pa.ListArray.from_arrays(pa.array(starts), values)
        block = pa.array(np.full(len(most), group.column("block")[0].as_py(), "<i8"))
        columns = [block, encoded.dictionary, pa.array(most), listed(group.column("docs").combine_chunks().take(pa.array(doc))), listed(pa.array(tf.astype("<i8"))), listed(pa.array(dl[doc].astype("<i4")))]
        return pa.Table.from_arrays(columns, names=["block", "term", "most", "docs", "tf", "dl"])

    return made


def build_lexical(docs: DataFrame, doc_id: str, text: str, folder: str | None = None, k1: float = 1.5, b: float = 0.75, block_docs: int = 256) -> LexicalIndex:
    """Write the index of all documents to ``folder``, or to a fresh one below ``spark.checkpoint.dir``.

    Null and empty texts count as documents without terms, as in
    ``bm25_search``; repeated rows are documents of their own; an empty table
    gives an empty index.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "lexical")
    with Work(spark) as work:
        tokens = spread(docs.select(doc_id, text)).select(F.col(doc_id).alias("docs"), retrieval_tokens(F.col(text)).alias("t")).withColumn("dl", F.size("t"))
        placed = work.written(numbered(tokens, ["dl", "docs"], work, "number"), "placed")
        size = placed.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl")).first()
        n, avgdl = size.n, size.avgdl or 0.0
        # whole documents meet by block, and no token is shuffled or counted by itself
        tasks = max(spark.sparkContext.defaultParallelism, n // TASK_DOCS)
        dealt = placed.withColumn("block", F.floor(F.col("number") / block_docs).cast("bigint")).repartition(tasks, "block")
        lists = dealt.select("block", "number", "docs", "dl", "t").groupBy("block").applyInArrow(_lists(avgdl, k1, b), f"block bigint, term string, most double, docs array<{docs.schema[doc_id].dataType.simpleString()}>, tf array<bigint>, dl array<int>")
        named = lists.select(_bucket("term").alias("bucket"), "term", "block", "most", "docs", "tf", "dl")
        files = F.pmod(F.xxhash64("term", "block"), F.lit(1 + n // FILE_DOCS))
        named.repartition(F.col("bucket"), files).sortWithinPartitions("bucket", "term", "block").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/postings")
    if not n or not avgdl:
        # no folder was written that a reader could take the columns from
        named.limit(0).drop("bucket").write.mode("overwrite").parquet(f"{folder}/postings/bucket=0")
    df = spark.read.parquet(f"{folder}/postings").groupBy("bucket", "term").agg(F.sum(F.size("docs")).alias("df"))
    saved(df.withColumn("idf", F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))), f"{folder}/terms")
    saved(spark.createDataFrame([(n, avgdl, k1, b, doc_id)], "n bigint, avgdl double, k1 double, b double, doc_id string"), f"{folder}/facts")
    return LexicalIndex(spark, folder)


class HybridIndex:
    """A stored lexical index and a stored latent space of the same documents."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.folder = folder
        self.lexical, self.latent = LexicalIndex(spark, f"{folder}/lexical"), LatentSpace(spark, f"{folder}/latent")

    def dense(self, queries: DataFrame, query_id: str, query: str, k: int) -> DataFrame:
        """(query, doc, score, rank) by cosine in the latent space; queries and documents without a direction take no part."""
        held = F.exists("embedding", lambda x: x != 0)
        asked = self.latent.encode(queries.select(query_id, query), query_id, query).where(held)
        found = dense_search(self.latent.vectors.where(held), asked, k, self.lexical.doc_id, query_id, "embedding")
        return found.select(F.col("query").alias(query_id), F.col("item").alias(self.lexical.doc_id), "score", "rank")

    def search(self, queries: DataFrame, query_id: str, query: str, k: int, depth: int = 50) -> DataFrame:
        """The union of ``depth`` hits of both by the sum of their scores."""
        bm25 = self.lexical.search(queries, query_id, query, depth).withColumnRenamed("bm25", "score")
        return hybrid(bm25, self.dense(queries, query_id, query, depth), query_id, self.lexical.doc_id, k)


def build_hybrid(docs: DataFrame, doc_id: str, text: str, root: str | None = None, name: str = "hybrid", dims: int = 32, k1: float = 1.5, b: float = 0.75) -> HybridIndex:
    """Fit and write both indexes below ``root``, in the folder of the name and configuration; ``HybridIndex`` reads it again."""
    spark = docs.sparkSession
    config = {"doc_id": doc_id, "text": text, "dims": dims, "k1": k1, "b": b}
    folder = versioned(root or shared_folder(spark, "indexes"), name, config)
    build_lexical(docs, doc_id, text, f"{folder}/lexical", k1, b)
    fit_latent(docs, doc_id, text, dims, folder=f"{folder}/latent")
    return HybridIndex(spark, folder)
