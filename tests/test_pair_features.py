"""Pair features where ids repeat, and their means without a row per pair."""

import pytest
from pyspark.sql import functions as F

from quillon.functions.attributes import with_attributes
from quillon.functions.intent import query_intent
from quillon.operators import features, joins
from quillon.operators.features import feature_means, pair_features
from quillon.operators.latent import fit_latent
from quillon.plans import relational
from quillon.sources.work import Work

ITEMS = [
    (1, "red shoe 42", "Shoes > Women", "acme", "kadın", "", "renk: kırmızı, materyal: deri"), (2, "blue cotton shirt", "Shirts > Men", "Red", "erkek", "çocuk", "renk: mavi"), (3, "green wool coat", None, None, "unisex", "bebek", "stil: klasik, beden: 42"),
    (4, "red shoe 42", "Shoes > Women", "acme", "kadın", "", "renk: kırmızı, materyal: deri"), (5, None, "", "", None, None, None), (6, "klasik deri ayakkabı", "Shoes > Men", "acme", "erkek", "bebek", "materyal: hakiki deri, renk: siyah / beyaz"),
]
TERMS = [(10, "red shoe"), (11, "çocuk kadın deri 42"), (12, None), (13, "red shoe"), (14, "siyah oversize klasik erkek"), (15, "acme shirts"), (16, "")]
#: Ids repeat; item 7 and term 17 are in no table.
PAIRS = [(i % 23, 10 + i * 5 % 8, 1 + i * 3 % 7) for i in range(70)] + [(100, 10, 1), (100, 10, 1), (101, None, 2), (102, 11, None)]
HITS = [(10, 1, 3.5, 1, 0.9, 1), (10, 4, 3.5, 2, None, None), (11, 6, None, None, 0.4, 70), (14, 6, 1.0, 3, 0.36, 5), (14, 2, 0.1, 4, 0.5, 2), (11, 2, 0.2, 9, 0.7, 3)]


@pytest.fixture
def tables(spark):
    pairs = spark.createDataFrame(PAIRS, "id int, term_id int, item_id int")
    items = with_attributes(spark.createDataFrame(ITEMS, "item_id int, title string, category string, brand string, gender string, age_group string, attributes string"))
    terms = spark.createDataFrame(TERMS, "term_id int, query string")
    hits = spark.createDataFrame(HITS, "asked int, item_id int, bm25_score double, bm25_rank int, dense_score double, dense_rank int")
    asked = terms.groupBy("query").agg(F.min("term_id").alias("asked"))
    asks = terms.alias("t").join(asked.alias("a"), F.col("t.query").eqNullSafe(F.col("a.query"))).select("term_id", "asked")
    return pairs, terms, asks, query_intent(asked), items, hits


def test_means_are_those_of_all_pairs(spark, tables, monkeypatch):
    monkeypatch.setattr(features, "BROADCAST_QUERIES", 0)
    pairs, terms, asks, queries, items, hits = tables
    got = {r.feature: (r.n, r.mean) for r in feature_means(pairs, asks, queries, items, hits, relational._retrieval_flags()).collect()}
    wide = joins.star_join(pairs, query_intent(terms), items, check=False).join(hits.join(asks, "asked").drop("asked"), ["term_id", "item_id"], "left").withColumns(relational._retrieval_flags())
    rows = pair_features(joins.cut(wide))
    expected = rows.agg(*(F.avg(c).alias(c) for c in rows.columns if c != "id")).first().asDict()
    assert len(expected) == 110 and set(got) == set(expected)
    assert {n for n, _ in got.values()} == {len(PAIRS)}
    assert {c: mean for c, (_, mean) in got.items()} == pytest.approx(expected, abs=1e-6)


def test_tables_that_are_written_do_not_grow_with_pairs_of_the_same_texts(spark, tables, monkeypatch):
    pairs, _, asks, queries, items, hits = tables
    sizes = []
    written = Work.written

    def noted(self, df, what, *by):
        out = written(self, df, what, *by)
        sizes.append((what, out.count()))
        return out

    monkeypatch.setattr(Work, "written", noted)
    many = pairs.crossJoin(spark.range(40)).drop("id").withColumn("id", F.monotonically_increasing_id())
    got = {r.feature: r.n for r in feature_means(many, asks, queries, items, hits, relational._retrieval_flags()).collect()}
    assert len(got) == 110 and set(got.values()) == {40 * len(PAIRS)}
    assert max(n for _, n in sizes) < 8 * 7 * 8


def test_rows_of_one_id_have_features_of_their_own(spark):
    texts = [("red shoe", "red shoe"), ("red shoe", "blue shirt"), ("blue shirt", "blue cotton shirt"), ("wool coat", "red shoe")]
    rows = spark.createDataFrame([(i, q, t) for i, (q, t) in enumerate(texts)], "row int, query string, title string").withColumns({c: F.lit("") for c in ("category", "brand", "gender", "age_group", "attributes")})
    expected = sorted((r.query, r.title, r.x) for r in pair_features(rows, "row", ("semantic",)).join(rows, "row").select("query", "title", F.round("sem_query_title_cosine", 9).alias("x")).collect())
    same = pair_features(rows.withColumn("id", F.lit(1)), "id", ("semantic",)).select(F.round("sem_query_title_cosine", 9).alias("x")).collect()
    assert sorted(r.x for r in same) == sorted(x for *_, x in expected) and len({x for *_, x in expected}) > 2


def test_a_fit_keeps_two_thin_sides_at_most(spark, tmp_path, monkeypatch):
    most = []
    written = Work.written

    def noted(self, df, what, *by):
        out = written(self, df, what, *by)
        most.append(sum(name.startswith("steps") for name, _ in self.paths))
        return out

    monkeypatch.setattr(Work, "written", noted)
    texts = spark.createDataFrame([(i, f"word{i % 3} other{i % 4} lone{i}") for i in range(20)], "doc_id int, text string")
    space = fit_latent(texts, "doc_id", "text", dims=2, oversample=2, folder=str(tmp_path / "space"))
    assert max(most) == 2 and space.vectors.count() == 20
