"""Queries: lexical, dense and hybrid search, fusion, pools and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators import retrieval as R
from quillon.operators.index_store import build_hybrid, build_lexical
from quillon.operators.joins import cut
from quillon.operators.latent import fit_latent
from quillon.operators.term_columns import norms

from .catalog import Registry, cte, view

query = Registry()
K = 10

_WORDS = r"regexp_extract_all(trim(regexp_replace(lower(coalesce({0}, '')), '\s+', ' ', 'g')), '[a-zA-ZçğıöşüÇĞİÖŞÜ0-9]+')"
_BM25 = (
    cte("docs", "questions")
    + f""", d AS (SELECT doc_id, {_WORDS.format("text")} AS t FROM docs), n AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM d),
q AS (SELECT question_id, term, count(*) AS qtf FROM (SELECT question_id, unnest({_WORDS.format("question")}) AS term FROM questions) GROUP BY ALL),
p AS (SELECT doc_id, dl, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM d) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
s AS (SELECT question_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl)) * qtf), 6) AS bm25 FROM p JOIN df USING (term) JOIN q USING (term), n GROUP BY ALL),
bm AS (SELECT question_id, doc_id, bm25, CAST(row_number() OVER (PARTITION BY question_id ORDER BY bm25 DESC, doc_id) AS int) AS rank FROM s WHERE bm25 > 0)"""
)


def _bm25(spark: SparkSession, d: str, k: int = K) -> DataFrame:
    return R.bm25_search(view(spark, d, "docs"), view(spark, d, "questions"), "doc_id", "text", "question_id", "question", k)


@query(_BM25 + f" SELECT * FROM bm WHERE rank <= {K}")
def bm25_topk(spark, d):
    return _bm25(spark, d).select("question_id", "doc_id", "bm25", "rank")


@query(
    _BM25
    + f""", k AS (SELECT question_id, doc_id FROM bm WHERE rank = 1), x AS (SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY bm25 DESC, doc_id) AS int) AS r FROM bm ANTI JOIN k USING (question_id, doc_id))
SELECT question_id, doc_id, bm25, r AS rank FROM x WHERE r <= {K}"""
)
def bm25_excluding_known(spark, d):
    known = _bm25(spark, d, 1).select("question_id", "doc_id")
    return R.bm25_search(view(spark, d, "docs"), view(spark, d, "questions"), "doc_id", "text", "question_id", "question", K, known).select("question_id", "doc_id", "bm25", "rank")


@query(_BM25 + " SELECT term, df, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf FROM df, n WHERE term IN (SELECT term FROM q)")
def bm25_corpus_stats(spark, d):
    docs, asked = view(spark, d, "docs"), R.query_terms(view(spark, d, "questions"), "question_id", "question")
    n, _ = R.corpus_stats(docs, "text")
    df = R.postings(docs, "doc_id", "text", asked).groupBy("term").agg(F.count("*").alias("df"))
    return df.withColumn("idf", F.round(F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)), 6))


_VECTORS = cte("vectors") + """, e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS double)) AS v FROM vectors WHERE embedding IS NOT NULL),
p AS (SELECT q.vec_id AS query, i.vec_id AS item, round(list_sum(list_transform(list_zip(q.v, i.v), lambda z: z[1] * z[2])), 6) AS score FROM e q, e i WHERE q.vec_id % 20 = 0)"""


@query(_VECTORS + f" SELECT query, item, score, CAST(rank AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item) AS rank FROM p) WHERE rank <= {K}")
def dense_topk(spark, d):
    v = view(spark, d, "vectors")
    return R.dense_search(v, v.where("vec_id % 20 = 0"), K, "vec_id", "vec_id", "embedding")


_OTHERS = " SELECT query, item, score, CAST(rank AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item) AS rank FROM p WHERE query <> item) WHERE rank <= {0}"


@query(_VECTORS.replace(" WHERE q.vec_id % 20 = 0", "") + _OTHERS.format(K))
def dense_excluding_self(spark, d):
    """The nearest other vectors of every vector."""
    v = view(spark, d, "vectors")
    return R.dense_search(v, v, K, "vec_id", "vec_id", "embedding", skip_same_id=True)


@query(_VECTORS + _OTHERS.format(K))
def dense_excluding_self_full(spark, d):
    """The nearest other vectors, of all, of those whose id is divisible by 20."""
    v = view(spark, d, "vectors")
    return R.dense_search(v, v.where("vec_id % 20 = 0"), K, "vec_id", "vec_id", "embedding", skip_same_id=True)


query.queries["dense_topk_full"], query.sql["dense_topk_full"] = dense_topk, query.sql["dense_topk"]


_TFIDF_TERMS = r"regexp_extract_all(lower(coalesce({0}, '')), '[\p{{L}}\p{{N}}_]{{2,}}')"
_TFIDF = f"""n AS (SELECT count(*) AS n FROM docs), dt AS (SELECT doc_id, {_TFIDF_TERMS.format("text")} AS t FROM docs), qt AS (SELECT question_id, {_TFIDF_TERMS.format("question")} AS t FROM questions),
tp AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM dt) GROUP BY ALL),
idf AS (SELECT term, ln((1 + n) / (1 + count(*))) + 1 AS idf FROM tp, n GROUP BY term, n), w AS (SELECT doc_id, term, tf * idf AS w FROM tp JOIN idf USING (term)), nd AS (SELECT doc_id, sqrt(sum(w * w)) AS nd FROM w GROUP BY 1),
tq AS (SELECT question_id, term, count(*) AS qtf FROM (SELECT question_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM qt) GROUP BY ALL),
qw AS (SELECT question_id, term, qtf * idf AS qw FROM tq JOIN idf USING (term)), nq AS (SELECT question_id, sqrt(sum(qw * qw)) AS nq FROM qw GROUP BY 1),
c AS (SELECT question_id, doc_id, round(sum(w * qw) / (nd * nq), 6) AS cosine FROM w JOIN qw USING (term) JOIN nd USING (doc_id) JOIN nq USING (question_id) GROUP BY question_id, doc_id, nd, nq),
tf AS (SELECT question_id, doc_id, cosine, CAST(row_number() OVER (PARTITION BY question_id ORDER BY cosine DESC, doc_id) AS int) AS rank FROM c)"""


@query(cte("questions", "docs") + f", {_TFIDF} SELECT * FROM tf WHERE rank <= 5")
def tfidf_cosine_topk(spark, d):
    found = R.tfidf_search(view(spark, d, "docs"), view(spark, d, "questions"), "doc_id", "text", "question_id", "question", 5)
    return found.select("question_id", "doc_id", F.col("score").alias("cosine"), "rank")


query.queries["tfidf_cosine_full"], query.sql["tfidf_cosine_full"] = tfidf_cosine_topk, query.sql["tfidf_cosine_topk"]

#: Hits of both retrievers: BM25, and cosines of TF-IDF vectors, which SQL can repeat; ``_latent_hits`` takes the latent vectors instead.
_VECTOR_HITS = f"""{_TFIDF.replace("n AS (SELECT count(*) AS n FROM docs), ", "")}, b AS (SELECT * FROM bm WHERE rank <= {K}), dd AS (SELECT question_id, doc_id, cosine AS dense_score, rank FROM tf WHERE rank <= {K})"""


def _hits(spark: SparkSession, d: str, of_docs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    bm = _bm25(spark, d).withColumnRenamed("bm25", "score").select("question_id", "doc_id", "score", "rank")
    # a few rows per question, which both branches of a fusion read
    return cut(bm), cut(R.tfidf_search(view(spark, d, "docs"), view(spark, d, "questions"), "doc_id", "text", "question_id", "question", K, of_docs=of_docs))


@query(
    _BM25
    + f""", {_VECTOR_HITS}, h AS (SELECT question_id, doc_id, coalesce(bm25, 0) AS bm25_score, coalesce(b.rank, 0) AS bm25_rank, coalesce(dense_score, 0) AS dense_score, coalesce(dd.rank, 0) AS dense_rank FROM b FULL JOIN dd USING (question_id, doc_id)),
r AS (SELECT *, round(bm25_score + dense_score, 6) AS hybrid FROM h) SELECT question_id, doc_id, bm25_score, bm25_rank, dense_score, dense_rank, hybrid, CAST(rank AS int) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY hybrid DESC, dense_score DESC, doc_id) AS rank FROM r) WHERE rank <= {K}"""
)
def hybrid_search(spark, d):
    return R.hybrid(*_hits(spark, d), "question_id", "doc_id", K)


_FUSED = f""", f AS (SELECT question_id, doc_id, round(sum(1.0 / (59 + rank)), 9) AS rrf FROM (SELECT question_id, doc_id, rank FROM b UNION ALL SELECT question_id, doc_id, rank FROM dd) GROUP BY ALL),
fr AS (SELECT question_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY rrf DESC, doc_id) AS r FROM f) WHERE r <= 300)"""


@query(
    _BM25
    + f""", {_VECTOR_HITS}{_FUSED}, hit AS (SELECT question_id, doc_id, round(coalesce(bm25, 0) / 100 + coalesce(cosine, 0), 6) AS rs, n_chars, lang FROM fr LEFT JOIN bm USING (question_id, doc_id) LEFT JOIN c USING (question_id, doc_id) JOIN docs USING (doc_id)),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY rs DESC, doc_id) AS r FROM hit) WHERE r <= 10), x AS (SELECT question_id, doc_id, round(CASE WHEN doc_id % 7 = 0 THEN 0 ELSE rs * CASE WHEN lang = 'en' THEN 1.15 ELSE 1.0 END * (1 + 0.1 * CAST(n_chars % 10 AS double) / 10) END, 6) AS score FROM kept)
SELECT question_id, doc_id, CAST(score AS double) AS score, CAST(rank AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank FROM x) WHERE rank <= 5"""
)
def search_pipeline(spark, d):
    """Fusion, reranking by both scores together, and boosts for a language and a popularity; documents out of stock score 0."""
    docs, asked = view(spark, d, "docs"), view(spark, d, "questions")
    args = docs, asked, "doc_id", "text", "question_id", "question"
    of_docs = cut(norms(docs, "doc_id", "text"))
    bm, dense = _hits(spark, d, of_docs)
    hits = cut(bm.select("question_id", "doc_id").union(dense.select("question_id", "doc_id")).distinct())
    lexical = R.bm25_scores(*args, pairs=hits).select("question_id", "doc_id", F.round("bm25", 6).alias("bm25"))
    cosine = R.tfidf_cosine(*args, pairs=hits, of_docs=of_docs).select("question_id", "doc_id", F.round("cosine", 6).alias("cosine"))
    found = hits.join(lexical, ["question_id", "doc_id"], "left").join(cosine, ["question_id", "doc_id"], "left").join(docs.select("doc_id", "lang", "n_chars"), "doc_id")
    scored = found.withColumn("rerank_score", F.round(F.coalesce(F.col("bm25"), F.lit(0.0)) / 100 + F.coalesce(F.col("cosine"), F.lit(0.0)), 6))
    boost = R.business_boost(F.lit(1.0), F.lit(False), F.col("lang") == "en", F.lit(False), (F.col("n_chars") % 10).cast("double") / 10, F.col("doc_id") % 7 != 0)
    return R.search_pipeline([bm, dense], scored, boost, "question_id", "doc_id", 5)


@query(
    _BM25
    + f""", {_VECTOR_HITS}, f AS (SELECT question_id, doc_id, round(sum(1.0 / (59 + rank)), 9) AS rrf FROM (SELECT question_id, doc_id, rank FROM b UNION ALL SELECT question_id, doc_id, rank FROM dd) GROUP BY ALL)
SELECT question_id, doc_id, CAST(rrf AS double) AS rrf, CAST(rank AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY rrf DESC, doc_id) AS rank FROM f) WHERE rank <= {K}"""
)
def rrf_fusion(spark, d):
    return R.reciprocal_rank_fusion(list(_hits(spark, d)), "question_id", "doc_id", K)


@query(
    _BM25
    + f""", {_VECTOR_HITS}, h AS (SELECT question_id, doc_id, b.rank AS br, dd.rank AS dr FROM b FULL JOIN dd USING (question_id, doc_id)), x AS (SELECT h.*, docs.lang AS ic, question_id % 4 AS m FROM h JOIN docs USING (doc_id))
SELECT question_id, count(br) AS bm25_hits, count(dr) AS dense_hits, count_if(br IS NOT NULL AND dr IS NOT NULL) AS overlap, count(*) AS in_either, count_if(br IS NULL) AS dense_only,
  round(avg(CASE WHEN dr IS NOT NULL THEN CAST(ic = CASE m WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'fr' ELSE 'es' END AS int) END), 6) AS dense_category_rate,
  round(CAST(count_if(br IS NOT NULL AND dr IS NOT NULL) AS double) / count(*), 6) AS jaccard FROM x GROUP BY 1"""
)
def retrieval_eval_overlap(spark, d):
    items = view(spark, d, "docs").select("doc_id", F.col("lang").alias("category"))
    queries = view(spark, d, "questions").selectExpr("question_id", "CASE question_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'fr' ELSE 'es' END AS category")
    return R.evaluate_retrieval(*_hits(spark, d), items, queries, "question_id", "doc_id")


def _latent_hits(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """BM25 hits, and dense hits of all documents in one latent space; SQL cannot repeat its decomposition."""
    dense = R.latent_search(view(spark, d, "docs"), view(spark, d, "questions"), "doc_id", "text", "question_id", "question", K)
    return _bm25(spark, d).select("question_id", "doc_id", F.col("bm25").alias("score"), "rank"), cut(dense)


@query()
def hybrid_search_latent(spark, d):
    """Hybrid search with dense hits from text vectors."""
    return R.hybrid(*_latent_hits(spark, d), "question_id", "doc_id", K)


@query()
def rrf_fusion_latent(spark, d):
    """Rank fusion of BM25 and dense hits from text vectors."""
    return R.reciprocal_rank_fusion(list(_latent_hits(spark, d)), "question_id", "doc_id", K)


@query()
def retrieval_eval_overlap_latent(spark, d):
    """Overlap of BM25 and dense hits from text vectors; a question's category is the language of its best BM25 document."""
    bm, dense = _latent_hits(spark, d)
    items = view(spark, d, "docs").select("doc_id", F.col("lang").alias("category"))
    queries = bm.where("rank = 1").join(items, "doc_id").select("question_id", "category")
    return R.evaluate_retrieval(bm, dense, items, queries, "question_id", "doc_id")


@query(cte("items", "terms") + """, q AS (SELECT term_id, concat('Brand#', term_id % 25 + 1) AS brand FROM terms), r AS (SELECT brand, item_id, row_number() OVER (PARTITION BY brand ORDER BY item_id) AS place FROM items)
SELECT term_id, item_id, brand, CAST(place AS int) AS rank, CAST(1 AS double) AS score FROM q JOIN r USING (brand) WHERE place <= 5""")
def brand_pool(spark, d):
    queries = view(spark, d, "terms").selectExpr("term_id", "concat('Brand#', term_id % 25 + 1) AS brand")
    return R.same_value_pool(queries, view(spark, d, "items"), "brand", "term_id", "item_id", 5)


_ITEM_VALUES = "CASE size % 4 WHEN 0 THEN 'red|blue' WHEN 1 THEN 'blue' WHEN 2 THEN '' ELSE 'black' END AS color, CASE size % 3 WHEN 0 THEN 'leather' WHEN 1 THEN 'cotton' END AS material"
_TERM_VALUES = "CASE term_id % 3 WHEN 0 THEN 'red' WHEN 1 THEN 'blue|black' ELSE '' END AS colors, CASE term_id % 4 WHEN 0 THEN 'leather' WHEN 1 THEN 'cotton|metal' END AS materials"


@query(
    cte("items", "terms")
    + f""", i AS (SELECT item_id, {_ITEM_VALUES} FROM items), t AS (SELECT term_id, {_TERM_VALUES} FROM terms), s AS (SELECT term_id, item_id, CAST(list_has_any(list_filter(string_split(colors, '|'), lambda x: x <> ''), string_split(color, '|')) AS int)
  + CAST(coalesce(list_has_any(string_split(materials, '|'), string_split(material, '|')), false) AS int) AS score FROM t, i)
SELECT term_id, item_id, CAST(score AS double) AS score, CAST(rank AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY term_id ORDER BY score DESC, item_id) AS rank FROM s WHERE score > 0) WHERE rank <= 5"""
)
def attribute_pool(spark, d):
    items = view(spark, d, "items").selectExpr("item_id", *_ITEM_VALUES.replace(", CASE", ";CASE").split(";"))
    terms = view(spark, d, "terms").selectExpr("term_id", *_TERM_VALUES.replace(", CASE", ";CASE").split(";"))
    return R.attribute_pool(terms, items, {"color": ("colors", "color"), "material": ("materials", "material")}, "term_id", "item_id", 5)


@query(cte("items", "terms") + """, q AS (SELECT term_id, CASE term_id % 3 WHEN 0 THEN 'Parts > PROMO' WHEN 1 THEN 'Parts > SMALL' ELSE 'Parts > LARGE' END AS category FROM terms), r AS (SELECT category, item_id, row_number() OVER (PARTITION BY category ORDER BY item_id) AS place FROM items)
SELECT term_id, item_id, category, CAST(place AS int) AS rank, CAST(1 AS double) AS score FROM q JOIN r USING (category) WHERE place <= 5""")
def category_pool(spark, d):
    queries = view(spark, d, "terms").selectExpr("term_id", "CASE term_id % 3 WHEN 0 THEN 'Parts > PROMO' WHEN 1 THEN 'Parts > SMALL' ELSE 'Parts > LARGE' END AS category")
    return R.same_value_pool(queries, view(spark, d, "items"), "category", "term_id", "item_id", 5)


@query(
    cte("items")
    + """ SELECT item_id, round(CASE WHEN size % 10 = 0 THEN 0.0 ELSE price / 1000 * (CASE WHEN brand = 'Brand#1' THEN 1.3 ELSE 1.0 END) * (CASE WHEN gender = 'kadın' THEN 1.15 ELSE 1.0 END) * (CASE WHEN contains(title, 'red') THEN 1.1 ELSE 1.0 END)
  * (1 + 0.1 * CAST(size AS double) / 50) END, 6) AS boosted FROM items"""
)
def business_boost(spark, d):
    score = R.business_boost(F.col("price") / 1000, F.col("brand") == "Brand#1", F.col("gender") == "kadın", F.col("title").contains("red"), F.col("size").cast("double") / 50, F.col("size") % 10 != 0)
    return view(spark, d, "items").select("item_id", F.round(score, 6).alias("boosted"))


def _cosine_sql(dims: int) -> str:
    dot = lambda a, b: f"list_sum(list_transform(list_zip({a}[1:{dims}], {b}[1:{dims}]), lambda z: z[1] * z[2]))"
    return f"round({dot('a.v', 'b.v')} / (sqrt({dot('a.v', 'a.v')}) * sqrt({dot('b.v', 'b.v')})), 6)"


@query(_VECTORS.split(",\np AS")[0] + f" SELECT a.vec_id, {', '.join(f'{_cosine_sql(n)} AS cos_{n}' for n in (16, 32, 64))} FROM e a JOIN e b ON b.vec_id = a.vec_id + 1")
def matryoshka_cosine(spark, d):
    v = view(spark, d, "vectors").where("embedding IS NOT NULL")
    other = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return v.join(other, "vec_id").select("vec_id", *(F.round(R.matryoshka(F.col("embedding"), F.col("other"), n), 6).alias(f"cos_{n}") for n in (16, 32, 64)))


@query(
    _VECTORS.split(",\np AS")[0]
    + """, x AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e), c AS (SELECT label, i, avg(x) AS c FROM x GROUP BY ALL)
SELECT vec_id, round(sum(x * c) / (sqrt(sum(x * x)) * sqrt(sum(c * c))), 5) AS similarity FROM x JOIN c USING (label, i) GROUP BY 1"""
)
def centroid_similarity(spark, d):
    rows = R.centroid_similarity(view(spark, d, "vectors").where("embedding IS NOT NULL"), "label", "embedding")
    return rows.select("vec_id", F.round("centroid_similarity", 5).alias("similarity"))


@query()
def svd_dense(spark, d):
    """Latent vectors of all documents: how many, and whether all are unit vectors."""
    rows = fit_latent(view(spark, d, "docs").select("doc_id", "text"), "doc_id", "text", 16).vectors
    norm = F.aggregate(F.col("embedding"), F.lit(0.0), lambda s, x: s + x * x)
    return rows.agg(F.count("*").alias("n"), F.count_if(F.abs(norm - 1) < 1e-6).alias("unit"), F.count_if(norm == 0).alias("empty"))


@query(query.sql["bm25_topk"])
def bm25_stored_topk(spark, d):
    """The hits of ``bm25_topk`` from a stored index, whose texts are not read by the search."""
    index = build_lexical(view(spark, d, "docs").select("doc_id", "text"), "doc_id", "text", block_docs=64)
    return index.search(view(spark, d, "questions"), "question_id", "question", K).select("question_id", "doc_id", "bm25", "rank")


@query()
def bm25_index_blocks(spark, d):
    """Per question the blocks with an asked term and how many of them a search for 10 hits reads."""
    index = build_lexical(view(spark, d, "docs").select("doc_id", "text"), "doc_id", "text", block_docs=64)
    blocks, _ = index.reading(view(spark, d, "questions"), "question_id", "question", K)
    return blocks.groupBy("question_id").agg(F.count("*").alias("blocks"), F.count_if("read").alias("read"))


@query()
def hybrid_search_stored(spark, d):
    """Hybrid search from stored indexes: BM25 postings and a latent space that the questions took no part in."""
    return build_hybrid(view(spark, d, "docs").select("doc_id", "text"), "doc_id", "text").search(view(spark, d, "questions"), "question_id", "question", K, K)
