"""Lexical, dense and hybrid retrieval over postings and vector blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quillon.functions.text import retrieval_tokens, text_or_empty

from .joins import cut

#: Vectors of a block of queries and of a block of items that meet in one task, and of a block of queries that has a task of its own while cores are idle.
QUERY_BLOCK, ITEM_BLOCK, LEAST_BLOCK = 8192, 16384, 1024
#: Queries and documents whose terms meet in one task.
TERM_QUERIES, TERM_DOCS = 256, 4096
#: Queries of a block that are scored at once.
SCORED_QUERIES = 64


def top_k(scored: DataFrame, key: str, order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows per key, numbered from 1; Spark limits each task's groups before the shuffle."""
    return scored.withColumn(rank, F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col(rank) <= k)


def query_terms(queries: DataFrame, query_id: str, text: str, tokenize=retrieval_tokens) -> DataFrame:
    """(query, term, qtf)."""
    return queries.select(query_id, F.explode(tokenize(F.col(text))).alias("term")).groupBy(query_id, "term").agg(F.count("*").alias("qtf"))


def spread(rows: DataFrame) -> DataFrame:
    """The rows, dealt over all cores where they lie in fewer partitions, for work that costs more than moving them."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def postings(docs: DataFrame, doc_id: str, text: str, terms: DataFrame | None = None, tokenize=retrieval_tokens) -> DataFrame:
    """(doc, dl, term, tf); only of ``terms`` if given, which keeps all other tokens out of the shuffle."""
    tokens = spread(docs.select(doc_id, text)).select(doc_id, tokenize(F.col(text)).alias("t"))
    flat = tokens.select(doc_id, F.size("t").alias("dl"), F.explode("t").alias("term"))
    if terms is not None:
        flat = flat.join(terms.select("term").distinct(), "term", "left_semi")
    return flat.groupBy(doc_id, "dl", "term").agg(F.count("*").alias("tf"))


def corpus_stats(docs: DataFrame, text: str) -> tuple[int, float]:
    row = spread(docs.select(text)).agg(F.count("*").alias("n"), F.avg(F.size(retrieval_tokens(F.col(text)))).alias("avgdl")).first()
    return row.n, row.avgdl or 0.0


def _asked_postings(docs: DataFrame, doc_id: str, text: str, asked: DataFrame) -> tuple[DataFrame, int, float]:
    """Postings of the asked terms, the number of rows and their mean length, from one reading of the texts.

    Tokens that no query asks for are counted per document under a null term,
    so the shuffle carries one row more per document than the asked terms take.
    """
    tokens = spread(docs.select(doc_id, text)).select(doc_id, retrieval_tokens(F.col(text)).alias("t"))
    flat = tokens.select(doc_id, F.size("t").alias("dl"), F.explode_outer("t").alias("token"))
    known = asked.select(F.col("term").alias("token")).distinct().withColumn("term", F.col("token"))
    marked = flat.join(known, "token", "left").groupBy(doc_id, "dl", "term").agg(F.count("*").alias("tf"), F.count("token").alias("tokens"))
    # every task of a later shuffle opens a file per partition, so few of them read what is kept
    kept = marked.coalesce(3 * docs.sparkSession.sparkContext.defaultParallelism).persist()
    length = kept.agg(F.sum("tokens").alias("s")).first().s or 0
    n = docs.count()
    return kept.where("term IS NOT NULL").select(doc_id, "dl", "term", "tf"), n, length / n if n else 0.0


def _bm25_parts(docs: DataFrame, queries: DataFrame, doc_id: str, text: str, query_id: str, query: str, k1: float, b: float) -> tuple[DataFrame, DataFrame, int]:
    """(doc, term, x) and (query, term, w), whose products add up to the scores, and the number of documents."""
    asked = query_terms(queries, query_id, query)
    p, n, avgdl = _asked_postings(docs, doc_id, text, asked)
    df = p.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    x = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / (avgdl or 1.0)))
    # a row per query and term, read twice by a search: their frequencies come from all postings
    weights = cut(asked.join(df, "term").select(query_id, "term", (idf * F.col("qtf")).alias("w")))
    return p.select(doc_id, "term", x.alias("x")), weights, n


def _products(p: DataFrame, asked: DataFrame, doc_id: str, query_id: str, pairs: DataFrame | None, name: str) -> DataFrame:
    """(query, doc, name): sums of products over shared terms; only of ``pairs`` if given, whose documents alone meet the queries."""
    if pairs is not None:
        p = p.join(pairs.select(doc_id).distinct(), doc_id, "left_semi")
    found = p.join(asked, "term").groupBy(query_id, doc_id).agg(F.sum(F.col("x") * F.col("w")).alias(name))
    return found if pairs is None else found.join(pairs.select(query_id, doc_id).distinct(), [query_id, doc_id], "left_semi")


def bm25_scores(docs: DataFrame, queries: DataFrame, doc_id: str, text: str, query_id: str, query: str, k1: float = 1.5, b: float = 0.75, pairs: DataFrame | None = None) -> DataFrame:
    """(query, doc, bm25) of all documents that share a term with the query, or of those of ``pairs``; a repeated query term counts repeatedly."""
    p, asked, _ = _bm25_parts(docs, queries, doc_id, text, query_id, query, k1, b)
    return _products(p, asked, doc_id, query_id, pairs, "bm25")


def term_search(p: DataFrame, asked: DataFrame, n: int, doc_id: str, query_id: str, k: int, places: int, name: str, zeros: bool = False, excluded: DataFrame | None = None) -> DataFrame:
    """(query, doc, name, rank): top documents by the sum of x * w over the terms of (doc, term, x) and (query, term, w), rounded to ``places``.

    Terms of a bounded number of documents and of queries meet in a task, of
    which the best ``k`` per query go on; no row per query and document is
    shuffled.  Ties go to the smaller id.  Scores that round to 0 count with
    ``zeros`` alone; (query, doc) pairs in ``excluded`` are left out.
    """
    if excluded is not None:
        # a query loses no more hits than it has pairs to leave out
        most = excluded.distinct().groupBy(query_id).agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).first().n
        found = term_search(p, asked, n, doc_id, query_id, k + most, places, name, zeros).drop("rank")
        return top_k(found.join(excluded, [query_id, doc_id], "left_anti"), query_id, [F.desc(name), F.asc(doc_id)], k)
    doc_type, query_type = p.schema[doc_id].dataType, asked.schema[query_id].dataType
    n_docs = 1 + n // TERM_DOCS
    n_queries = max(1, -(-asked.select(query_id).distinct().count() // TERM_QUERIES))
    dealt = lambda key, parts: F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    copies = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = asked.select(F.col(query_id).alias("query"), "term", "w", dealt(query_id, n_queries).alias("qb"), copies(n_docs).alias("db"))
    right = p.select(F.col(doc_id).alias("doc"), "term", "x", dealt(doc_id, n_docs).alias("db"), copies(n_queries).alias("qb"))
    types = [to_arrow_type(query_type), to_arrow_type(doc_type), pa.float64()]

    def meet(q: pa.Table, d: pa.Table) -> pa.Table:
        terms = pc.unique(q.column("term"))
        at = pc.index_in(d.column("term"), terms)
        d = d.append_column("at", at).filter(pc.is_valid(at))
        queries, of_query = np.unique(q.column("query").to_numpy(), return_inverse=True)
        weights = np.zeros((len(terms), len(queries)))
        np.add.at(weights, (pc.index_in(q.column("term"), terms).to_numpy(), of_query), q.column("w").to_numpy())
        docs, of_doc = np.unique(d.column("doc").to_numpy(), return_inverse=True)
        order = np.argsort(of_doc, kind="stable")
        x, t = d.column("x").to_numpy()[order], d.column("at").to_numpy()[order]
        ends = np.searchsorted(of_doc[order], np.arange(len(docs) + 1)).tolist()
        scores = np.zeros((len(docs), len(queries)))
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            scores[i] = x[a:b] @ weights[t[a:b]]
        rounded = np.round(scores, places)
        found = []
        for j in range(len(queries)):
            best = np.flatnonzero(scores[:, j] > 0 if zeros else rounded[:, j] > 0)
            falling = -rounded[best, j]
            if len(best) > k:
                near = falling <= np.partition(falling, k - 1)[k - 1]
                best, falling = best[near], falling[near]
            # ids are in order, and a stable sort keeps them so
            found.append(best[np.argsort(falling, kind="stable")[:k]])
        rows = np.concatenate(found) if found else np.zeros(0, int)
        own = np.repeat(np.arange(len(found)), [len(f) for f in found])
        return pa.Table.from_arrays([pa.array(v, kind) for v, kind in zip((queries[own], docs[rows], rounded[rows, own]), types, strict=True)], names=["query", "doc", "score"])

    met = left.groupBy("qb", "db").cogroup(right.groupBy("qb", "db")).applyInArrow(meet, f"query {query_type.simpleString()}, doc {doc_type.simpleString()}, score double")
    scored = met.select(F.col("query").alias(query_id), F.col("doc").alias(doc_id), F.col("score").alias(name))
    return top_k(scored, query_id, [F.desc(name), F.asc(doc_id)], k)


def bm25_search(docs: DataFrame, queries: DataFrame, doc_id: str, text: str, query_id: str, query: str, k: int, excluded: DataFrame | None = None, places: int = 6) -> DataFrame:
    """Top documents by score rounded to ``places``, ties to the smaller id; (query, doc) pairs in ``excluded`` are left out."""
    p, asked, n = _bm25_parts(docs, queries, doc_id, text, query_id, query, 1.5, 0.75)
    return term_search(p, asked, n, doc_id, query_id, k, places, "bm25", excluded=excluded)


def unigrams_bigrams(c: Column) -> Column:
    """Tokens of two word characters or more in lower case, then their bigrams."""
    words = F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))

    def with_pairs(t: Column) -> Column:
        n = F.greatest(F.size(t) - 1, F.lit(0))
        return F.concat(t, F.zip_with(F.slice(t, F.lit(1), n), F.slice(t, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b)))

    # an array of one, so that the text is split once for all that is made of its words
    return F.get(F.transform(F.array(words), with_pairs), 0)


def _tfidf_parts(docs: DataFrame, queries: DataFrame, doc_id: str, text: str, query_id: str, query: str, of_docs: DataFrame | None) -> tuple[DataFrame, DataFrame, int]:
    """(doc, term, x) and (query, term, w), whose products add up to the cosines, and the number of documents."""
    from .term_columns import norms

    n = docs.count()
    words = query_terms(queries, query_id, query, unigrams_bigrams)
    p = postings(docs, doc_id, text, words, unigrams_bigrams).select(doc_id, "term", "tf").persist()
    idf = p.groupBy("term").agg((F.log((1 + n) / (1 + F.count("*"))) + 1).alias("idf"))
    asked = words.join(idf, "term").withColumn("qw", F.col("qtf") * F.col("idf"))
    qnorm = asked.groupBy(query_id).agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qnorm"))
    lengths = norms(docs, doc_id, text) if of_docs is None else of_docs
    x = p.join(lengths, doc_id).select(doc_id, "term", (F.col("tf") / F.col("norm")).alias("x"))
    return x, asked.join(qnorm, query_id).select(query_id, "term", (F.col("qw") * F.col("idf") / F.col("qnorm")).alias("w")), n


def tfidf_cosine(docs: DataFrame, queries: DataFrame, doc_id: str, text: str, query_id: str, query: str, pairs: DataFrame | None = None, of_docs: DataFrame | None = None) -> DataFrame:
    """(query, doc, cosine) with weights tf * (ln((1 + n) / (1 + df)) + 1) fitted on the documents; only of ``pairs`` if given.

    ``of_docs`` takes the documents' ``norms`` from an earlier call.
    """
    p, asked, _ = _tfidf_parts(docs, queries, doc_id, text, query_id, query, of_docs)
    return _products(p, asked, doc_id, query_id, pairs, "cosine")


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays, 0 where either is null or all zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def matryoshka(a: Column, b: Column, dims: int) -> Column:
    """Cosine over the first ``dims`` components."""
    return cosine(F.slice(a, 1, dims), F.slice(b, 1, dims))


def dense_search(items: DataFrame, queries: DataFrame, k: int, item_id: str, query_id: str, vector: str, skip_same_id: bool = False, places: int = 6) -> DataFrame:
    """Top items per query by inner product rounded to ``places``, ties to the smaller id.

    Queries and items meet in bounded blocks: each pair of blocks is one matrix
    product in a task, of which the best ``k`` per query go on.  ``skip_same_id``
    leaves out the query's own row.  Null vectors take no part.
    """
    items, queries = (df.where(F.col(vector).isNotNull()) for df in (items, queries))
    n_items = max(1, -(-items.count() // ITEM_BLOCK))
    asked, idle = queries.count(), -(-items.sparkSession.sparkContext.defaultParallelism // n_items)
    # items are copied for every block of queries, so there are more of these for the cores' sake alone
    n_queries = max(1, -(-asked // QUERY_BLOCK), min(-(-asked // LEAST_BLOCK), idle))

    def dealt(df: DataFrame, key: str, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        doubles = F.transform(vector, lambda x: x.cast("double")).alias("v")
        return df.select(F.col(key).alias("id"), doubles, F.pmod(F.xxhash64(key), F.lit(own_n)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))).alias(other))

    def matrix(t: pa.Table) -> np.ndarray:
        return pc.list_flatten(t.column("v")).to_numpy().reshape(len(t), -1)

    def meet(q: pa.Table, x: pa.Table) -> pa.Table:
        parts: list[tuple] = [(np.zeros(0, "<i8"), np.zeros(0, "<i8"), np.zeros(0))]
        if len(q) and len(x):
            x = x.sort_by("id")
            ids, queries, left, right = x.column("id").to_numpy(), q.column("id").to_numpy(), matrix(q), matrix(x).T
            # scores of a few queries at a time, whatever the blocks hold
            for a in range(0, len(queries), SCORED_QUERIES):
                for query, row in zip(queries[a : a + SCORED_QUERIES], np.round(left[a : a + SCORED_QUERIES] @ right, places), strict=True):
                    if skip_same_id:
                        row[ids == query] = -np.inf
                    # all that reach the k-th score, ties included
                    best = np.flatnonzero(row >= np.partition(row, -k)[-k]) if len(row) > k else np.arange(len(row))
                    best = best[np.lexsort((ids[best], -row[best]))][:k]
                    best = best[row[best] > -np.inf]
                    parts.append((np.full(len(best), query), ids[best], row[best]))
        return pa.table([np.concatenate(c) for c in zip(*parts, strict=True)], names=["query", "item", "score"])

    left = dealt(queries, query_id, "qb", n_queries, "ib", n_items)
    right = dealt(items, item_id, "ib", n_items, "qb", n_queries).select("id", "v", "qb", "ib")
    found = left.groupBy("qb", "ib").cogroup(right.groupBy("qb", "ib")).applyInArrow(meet, "query bigint, item bigint, score double")
    return top_k(found, "query", [F.desc("score"), F.asc("item")], k)


def latent_search(docs: DataFrame, queries: DataFrame, doc_id: str, text: str, query_id: str, query: str, k: int, dims: int = 32) -> DataFrame:
    """(query, doc, score, rank): top documents by cosine in a latent space fitted on the documents alone.

    A text without a direction, that is without a term of the documents, takes
    no part.  The hits are saved and the space, a vector per document and more,
    goes with the call.
    """
    from quillon.sources.work import Work

    from .latent import fit_latent

    with Work(docs.sparkSession) as work:
        space = fit_latent(docs.select(doc_id, text), doc_id, text, dims, folder=work.folder("latent"))
        held = F.exists("embedding", lambda x: x != 0)
        asked = space.encode(queries.select(query_id, query), query_id, query)
        found = dense_search(space.vectors.where(held), asked.where(held), k, doc_id, query_id, "embedding")
        return cut(found.select(F.col("query").alias(query_id), F.col("item").alias(doc_id), "score", "rank"))


def hybrid(bm25: DataFrame, dense: DataFrame, query: str, item: str, k: int) -> DataFrame:
    """Union of both hit lists by the sum of scores; (query, item, score, rank) in, an absent rank or score is 0."""
    b = bm25.select(query, item, F.col("score").alias("bm25_score"), F.col("rank").alias("bm25_rank"))
    d = dense.select(query, item, F.col("score").alias("dense_score"), F.col("rank").alias("dense_rank"))
    both = b.join(d, [query, item], "full").na.fill(0, ["bm25_score", "bm25_rank", "dense_score", "dense_rank"])
    scored = both.withColumn("hybrid", F.round(F.col("bm25_score") + F.col("dense_score"), 6))
    return top_k(scored, query, [F.desc("hybrid"), F.desc("dense_score"), F.asc(item)], k)


def reciprocal_rank_fusion(lists: list[DataFrame], query: str, item: str, k: int, constant: int = 60) -> DataFrame:
    """Sum of 1 / (constant + rank - 1) over lists whose ranks start at 1."""
    union = lists[0].select(query, item, "rank")
    for one in lists[1:]:
        union = union.unionByName(one.select(query, item, "rank"))
    fused = union.groupBy(query, item).agg(F.round(F.sum(1.0 / (constant - 1 + F.col("rank"))), 9).alias("rrf"))
    return top_k(fused, query, [F.desc("rrf"), F.asc(item)], k)


def business_boost(score: Column, brand: Column, gender: Column, color: Column, popularity: Column, in_stock: Column) -> Column:
    """Score times 1.3 for the brand, 1.15 for gender, 1.1 for colour and 1 + popularity / 10; nothing out of stock scores."""
    factor = F.when(brand, 1.3).otherwise(1.0) * F.when(gender, 1.15).otherwise(1.0) * F.when(color, 1.1).otherwise(1.0)
    return F.when(in_stock, score * factor * (1 + 0.1 * F.coalesce(popularity, F.lit(0.0)))).otherwise(0.0)


def tfidf_search(docs: DataFrame, queries: DataFrame, doc_id: str, text: str, query_id: str, query: str, k: int, places: int = 6, of_docs: DataFrame | None = None) -> DataFrame:
    """(query, doc, score, rank): top documents by TF-IDF cosine rounded to ``places``, ties to the smaller id."""
    p, asked, n = _tfidf_parts(docs, queries, doc_id, text, query_id, query, of_docs)
    return term_search(p, asked, n, doc_id, query_id, k, places, "score", zeros=True)


def search_pipeline(lists: list[DataFrame], rerank: DataFrame, boost: Column, query: str, item: str, k: int, depth: int = 300) -> DataFrame:
    """(query, item, score, rank): lists fused to ``depth`` hits, the best 2 * k of them by the reranker, the best k of these after boosts.

    ``rerank`` takes a hit to ``rerank_score`` and the columns that ``boost``, a
    factor, reads; a hit that it does not know is dropped.
    """
    fused = reciprocal_rank_fusion(lists, query, item, depth).select(query, item)
    best = top_k(fused.join(rerank, [query, item]), query, [F.desc("rerank_score"), F.asc(item)], 2 * k, "_place")
    boosted = best.withColumn("score", F.round(F.col("rerank_score") * boost, 6))
    return top_k(boosted.select(query, item, "score"), query, [F.desc("score"), F.asc(item)], k)


def attribute_pool(queries: DataFrame, items: DataFrame, kinds: dict[str, tuple[str, str]], query: str, item: str, k: int) -> DataFrame:
    """(query, item, score, rank): items that share most kinds of values with a query, ties to the smaller id.

    ``kinds`` names for each kind the column of the query's and of the item's
    values, both joined by ``|``.  Items of the same values count as one until
    the end, so a common value is not joined item by item.
    """
    values = lambda c: F.filter(F.split(F.coalesce(F.col(c), F.lit("")), r"\|"), lambda v: v != "")

    def named(kind: str):
        return lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))

    def long(df: DataFrame, key: str, side: int) -> DataFrame:
        each = F.flatten(F.array(*(F.transform(values(c[side]), named(kind)) for kind, c in kinds.items())))
        return df.select(key, F.explode(each).alias("x")).select(key, "x.*").distinct()

    own = [c[1] for c in kinds.values()]
    packed = items.select(item, F.concat_ws("\x01", *(F.coalesce(F.col(c), F.lit("")) for c in own)).alias("_set"), *own)
    sets = packed.select("_set", *own).distinct()
    met = long(queries, query, 0).join(long(sets, "_set", 1), ["kind", "value"]).groupBy(query, "_set").agg(F.count_distinct("kind").cast("double").alias("score"))
    first = packed.select("_set", item, F.row_number().over(Window.partitionBy("_set").orderBy(item)).alias("_r")).where(F.col("_r") <= k).drop("_r")
    return top_k(met.join(first, "_set").select(query, item, "score"), query, [F.desc("score"), F.asc(item)], k)


def same_value_pool(queries: DataFrame, items: DataFrame, column: str, query: str, item: str, k: int) -> DataFrame:
    """The first ``k`` items per query that share ``column`` with it, by item id, score 1."""
    values = items.select(column, item).withColumn("place", F.row_number().over(Window.partitionBy(column).orderBy(item))).where(F.col("place") <= k)
    return queries.select(query, column).distinct().join(values, column).select(query, item, column, F.col("place").alias("rank"), F.lit(1.0).alias("score"))


def centroid_similarity(rows: DataFrame, group: str, vector: str) -> DataFrame:
    """Adds each row's cosine to the mean vector of its group."""
    parts = rows.select(group, F.posexplode(vector).alias("i", "x")).groupBy(group, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    mean = parts.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("centroid"))
    return rows.join(mean, group).withColumn("centroid_similarity", cosine(F.col(vector), F.col("centroid"))).drop("centroid")


def evaluate_retrieval(bm25: DataFrame, dense: DataFrame, items: DataFrame, queries: DataFrame, query: str, item: str) -> DataFrame:
    """Per query: hits of both lists, overlap, Jaccard, dense-only hits and the rate of hits that share the query's category."""
    b, d = (x.select(query, item).distinct().withColumn(n, F.lit(1)) for x, n in ((bm25, "b"), (dense, "d")))
    both = b.join(d, [query, item], "full").join(items.select(item, F.col("category").alias("ic")), item, "left").join(queries.select(query, "category"), query, "left")
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    hits = both.groupBy(query).agg(
        n("b").alias("bm25_hits"),
        n("d").alias("dense_hits"),
        n(F.when(F.col("b").isNotNull() & F.col("d").isNotNull(), 1)).alias("overlap"),
        F.count("*").alias("in_either"),
        n(F.when(F.col("b").isNull(), 1)).alias("dense_only"),
        F.round(F.avg(F.when(F.col("d").isNotNull(), (F.col("ic") == F.col("category")).cast("int"))), 6).alias("dense_category_rate"),
    )
    return hits.withColumn("jaccard", F.round(F.col("overlap") / F.col("in_either"), 6))
