"""The relevance tables as views of the driver's tables, for Spark and SQL alike.

Each view is a list of expressions that both dialects read, so a query and its
SQL start from the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

COLOR = "CASE p_size % 6 WHEN 0 THEN 'Kırmızı' WHEN 1 THEN 'siyah / beyaz' WHEN 2 THEN 'lacivert' WHEN 3 THEN 'BLUE' WHEN 4 THEN 'fuşya' ELSE 'gri' END"
MATERIAL = "CASE p_size % 5 WHEN 0 THEN 'hakiki deri' WHEN 1 THEN 'Pamuk' WHEN 2 THEN 'keten + yün' WHEN 3 THEN 'metal' ELSE 'deri' END"
ADJECTIVE = "CASE s_suppkey % 8 WHEN 0 THEN 'red' WHEN 1 THEN 'blue' WHEN 2 THEN 'hot' WHEN 3 THEN 'cold' WHEN 4 THEN 'small' WHEN 5 THEN 'large' WHEN 6 THEN 'old' ELSE 'siyah' END"
NOUN = "CASE s_suppkey % 7 WHEN 0 THEN 'widget' WHEN 1 THEN 'bolt' WHEN 2 THEN 'gear' WHEN 3 THEN 'ring' WHEN 4 THEN 'plate' WHEN 5 THEN 'rod' ELSE 'ayakkabı' END"
EXTRA = "CASE s_suppkey % 6 WHEN 0 THEN 'kadın deri' WHEN 1 THEN '42 numara' WHEN 2 THEN 'çocuk' WHEN 3 THEN 'promo' WHEN 4 THEN 'oversize klasik erkek' ELSE '' END"

#: View name to (source table, expressions).
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "items": (
        "part",
        (
            "p_partkey AS item_id", "p_name AS title", "concat('Parts > ', p_type) AS category", "p_brand AS brand",
            "CASE p_size % 4 WHEN 0 THEN 'kadın' WHEN 1 THEN 'erkek' WHEN 2 THEN 'unisex' ELSE 'unknown' END AS gender",
            "CASE p_size % 3 WHEN 0 THEN 'bebek' WHEN 1 THEN 'çocuk' ELSE '' END AS age_group",
            f"concat('Ürün Rengi: ', {COLOR}, ', Kumaş Tipi: ', {MATERIAL}, ', stil: klasik, beden: ', CAST(p_size AS varchar(10)), ', el işi') AS attributes",
            "p_size AS size", "p_retailprice AS price",
        ),
    ),
    "terms": ("supplier", ("s_suppkey AS term_id", f"trim(concat({ADJECTIVE}, ' ', {NOUN}, ' ', {EXTRA})) AS query", "s_acctbal AS weight")),
    "pairs": ("lineitem", ("l_orderkey * 10 + l_linenumber AS id", "l_suppkey AS term_id", "l_partkey AS item_id", "CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS label", "l_orderkey AS session_id", "l_shipdate AS ts")),
    "docs": ("documents", ("doc_id", "text", "lang", "source", "n_chars")),
    "questions": ("benchmark", ("item_id AS question_id", "text AS question")),
    "vectors": ("embeddings", ("vec_id", "embedding", "label")),
    "registry": (
        "customer",
        (
            "c_custkey AS experiment_id", "c_mktsegment AS family", "concat(CASE c_custkey % 5 WHEN 0 THEN 'lgbm' WHEN 1 THEN 'cross-enc' WHEN 2 THEN 'blend' WHEN 3 THEN 'tfidf' ELSE 'misc' END, '-', CAST(c_nationkey AS varchar(10))) AS name",
            "CAST((c_custkey * 37) % 1000 AS double) / 1000 AS oof_macro_f1", "CAST((c_custkey * 53) % 1000 AS double) / 1000 AS public_score", "CAST((c_custkey * 71) % 1000 AS double) / 1000 AS class0_f1", "CAST((c_custkey * 29) % 1000 AS double) / 1000 AS class1_f1",
            "CAST((c_custkey * 17) % 100 AS double) / 100 AS threshold", "CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE 0 END AS threshold_fragile", "CAST(c_custkey % 20 AS double) / 1000 AS seed_std", "c_nationkey AS splitter",
        ),
    ),
    "experiments": (
        "customer",
        (
            "c_custkey AS ord", "CAST(c_custkey AS varchar(12)) AS experiment_id",
            "concat(CASE c_custkey % 8 WHEN 0 THEN 'tabular-lgb' WHEN 1 THEN 'ce_best' WHEN 2 THEN 'blend' WHEN 3 THEN 'sklearn_text' WHEN 4 THEN 'Dense' WHEN 5 THEN 'retrieval' WHEN 6 THEN 'a+b' ELSE 'misc' END, '-', CAST(c_nationkey AS varchar(10))) AS experiment_name",
            "CASE c_nationkey % 3 WHEN 0 THEN 'term_group' WHEN 1 THEN 'query_group' END AS validation_version",
            "CASE WHEN c_custkey % 17 = 0 THEN 'none' ELSE CAST(CAST((c_custkey * 17) % 100 AS double) / 100 AS varchar(12)) END AS best_threshold",
            "CASE WHEN c_custkey % 13 = 0 THEN '' ELSE CAST(CAST((c_custkey * 37) % 1000 AS double) / 1000 AS varchar(12)) END AS oof_macro_f1",
            "CAST((c_custkey * 71) % 1000 AS double) / 1000 AS class0_f1", "CAST((c_custkey * 29) % 1000 AS double) / 1000 AS class1_f1",
            "CASE c_custkey % 9 WHEN 0 THEN 'True' WHEN 1 THEN '' ELSE 'False' END AS threshold_fragile",
            "CAST(c_custkey % 20 AS double) / 1000 AS seed_std", "CASE WHEN c_custkey % 4 = 0 THEN CAST((c_custkey * 53) % 1000 AS double) / 1000 END AS public_lb_score",
            "CASE c_custkey % 6 WHEN 0 THEN 'public only' WHEN 1 THEN 'by fold' WHEN 2 THEN '' END AS submission_note",
            "CASE c_custkey % 5 WHEN 0 THEN 'feature' WHEN 1 THEN 'negative' WHEN 2 THEN 'retrieval' ELSE 'dense' END AS category",
            "CASE c_custkey % 7 WHEN 0 THEN 'dense pool' WHEN 1 THEN 'retrieval top k' ELSE 'none' END AS changed_component", "CASE WHEN c_custkey % 11 = 0 THEN 'not_run' ELSE 'completed' END AS status",
        ),
    ),
    "submissions": (
        "orders",
        (
            "CAST(o_custkey AS varchar(12)) AS experiment_id", "CAST(CAST(o_orderdate AS date) AS varchar(12)) AS submission_timestamp", "concat('s', CAST(o_orderkey AS varchar(12)), '.csv') AS file_path",
            "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST((o_orderkey * 53) % 1000 AS double) / 1000 END AS public_lb_score", "CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'family_A' END AS chosen_family_label",
            "CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'sent late' END AS submission_notes", "o_orderkey % 7 = 0 AS manual",
        ),
    ),
}

#: Expressions over labels joined with documents.
SCORED = (
    "doc_id AS id", "quality AS label", "toxic", "lang", "source", "n_chars", "CAST(doc_id % 5 AS int) AS fold",
    "CAST((doc_id * 7919 + quality * 3500 + n_chars) % 10000 AS double) / 10000 AS proba",
    "CAST((doc_id * 6101 + quality * 4500 + n_chars * 3) % 10000 AS double) / 10000 AS proba_b",
    "CAST((doc_id * 104729 + quality * 2500) % 10000 AS double) / 10000 AS proba_c",
)


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "scored":
        return source(spark, sf_dir, "labels").join(source(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id").selectExpr(*SCORED)
    table, expressions = VIEWS[name]
    return source(spark, sf_dir, table).selectExpr(*expressions)


def cte(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` of the named views."""
    parts = [f"{n} AS (SELECT {', '.join(SCORED)} FROM labels JOIN documents USING (doc_id))" if n == "scored" else f"{n} AS (SELECT {', '.join(VIEWS[n][1])} FROM {VIEWS[n][0]})" for n in names]
    return "WITH " + ",\n".join(parts)


class Registry:
    """Queries with their SQL, by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable[[Query], Query]:
        def register(function: Query) -> Query:
            self.queries[function.__name__] = function
            if sql is not None:
                self.sql[function.__name__] = sql
            return function

        return register
