"""Exact expectations of the text, attribute and intent functions."""

import json

import pytest
from pyspark.sql import functions as F

from quillon.functions import text as X
from quillon.functions.attributes import attribute_map_of_json, leaf_category, with_attributes
from quillon.functions.intent import query_intent
from quillon.operators import blending, decisions, folds, metrics, negatives
from quillon.sources.contracts import CONTRACTS, validated, violations


def parsed(spark, raw):
    row = with_attributes(spark.createDataFrame([(raw,)], "attributes string")).first()
    return json.loads(row.attribute_dict), row


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("", {}),
        (None, {}),
        ("nan", {}),
        ("renk: siyah, materyal: hakiki deri, stil: klasik", {"color": ["black"], "material": ["genuine_leather"], "style": ["classic"]}),
        ("COLOR: White, Fabric: Cotton", {"color": ["white"], "material": ["cotton"]}),
        ("Ürün Rengi: Kırmızı, Kumaş Tipi: Pamuk", {"color": ["red"], "material": ["cotton"]}),
        ("renk: siyah / beyaz, color: black", {"color": ["black", "white"]}),
        ("materyal: deri, materyal: hakiki deri, materyal: suni deri", {"material": ["leather", "genuine_leather", "faux_leather"]}),
        ("renk siyah, materyal: deri", {"material": ["leather"], "unknown": ["renk_siyah"]}),
    ],
)
def test_attributes(spark, raw, expected):
    assert parsed(spark, raw)[0] == expected


def test_attribute_outputs(spark):
    _, row = parsed(spark, "renk: siyah / beyaz, beden: 42")
    assert (row.attribute_keys, row.attribute_values, row.color_value) == ("color|size", "black|white|42", "black|white")
    assert row.normalized_attribute_text == "color: black white ; size: 42"


def test_attribute_json(spark):
    rows = spark.createDataFrame([('{"a": ["x", "y"], "b": "z"}',), ("[1]",), (None,), ("broken",)], "j string").select(attribute_map_of_json(F.col("j")).alias("m")).collect()
    assert [r.m for r in rows] == [{"a": ["x", "y"], "b": ["z"]}, {}, {}, {}]


def test_leaf_category(spark):
    rows = spark.createDataFrame([("a > b / c",), ("x/y",), ("plain",), (None,)], "c string").select(leaf_category(F.col("c")).alias("l")).collect()
    assert [r.l for r in rows] == ["b / c", "y", "plain", ""]


@pytest.mark.parametrize(
    ("query", "flags"),
    [
        ("beyaz kadın sneaker", {"has_color_token": 1, "has_gender_token": 1, "has_category_token": 1, "detected_gender_candidates": "female"}),
        ("42 numara koşu ayakkabısı", {"has_size_token": 1, "has_category_token": 1}),
        ("siyah oversize sweatshirt", {"has_color_token": 1, "has_style_token": 1, "has_category_token": 1, "is_attribute_heavy": 1}),
        ("", {"query_length_tokens": 0, "possible_typo_or_ambiguous": 1}),
        (None, {"query_length_tokens": 0, "query_char_length": 0}),
        ("ayyyakkabı", {"possible_typo_or_ambiguous": 1}),
    ],
)
def test_intent(spark, query, flags):
    row = query_intent(spark.createDataFrame([(query,)], "query string")).first().asDict()
    assert {k: row[k] for k in flags} == flags


def test_token_span_and_sets(spark):
    df = spark.createDataFrame([("a b c d", "x b c y"), ("", "a"), ("a", "")], "a string, b string")
    rows = df.select(X.longest_token_span(X.tokens(F.col("a")), X.tokens(F.col("b"))).alias("n"), X.token_set_ratio(X.token_set(F.col("a")), X.token_set(F.col("b"))).alias("r")).collect()
    assert [(r.n, r.r) for r in rows] == [(2, 0.5), (0, 0.0), (0, 0.0)]


def test_contract_reports_all_violations(spark):
    rows = spark.createDataFrame([(1, 1, 1, 1), (1, 2, 2, 3), (2, 1, 1, 0)], "id int, term_id int, item_id int, label int")
    found = {(r["check"], r["column"]): r.n for r in violations(rows, CONTRACTS["training_pairs"]).collect()}
    assert found == {("not_binary", "label"): 1, ("repeated", "id"): 2, ("repeated", "term_id+item_id"): 2}
    with pytest.raises(ValueError, match="not_binary"):
        validated(rows, "training_pairs")
    with pytest.raises(ValueError, match="missing_column"):
        validated(rows.drop("label"), "training_pairs")


def test_threshold_curve_counts_every_row(spark):
    rows = spark.range(200).selectExpr("CAST(id % 2 AS int) AS label", "CAST(id * 37 % 100 AS double) / 100 AS proba")
    for r in metrics.threshold_curve(rows).collect():
        assert r.tp + r.fp + r.fn + r.tn == 200
        assert 0 <= r.macro_f1 <= 1
    assert {(r.tp, r.fp, r.fn, r.tn) for r in metrics.threshold_curve(rows.limit(0)).collect()} == {(0, 0, 0, 0)}


def test_quota_is_never_exceeded(spark):
    rows = spark.range(100).selectExpr("id % 3 AS k", "id")
    taken = negatives.take_quota(rows, "k", [F.asc("id")], F.col("id") % 2 == 0, 4).groupBy("k").agg(F.count_if(F.col("id") % 2 == 0).alias("n")).collect()
    assert all(r.n == 4 for r in taken)


def test_folds_are_balanced_and_stable(spark):
    rows = spark.range(103).selectExpr("id", "CAST(id % 4 = 0 AS int) AS label")
    a = {r.id: r.fold for r in folds.stratified_folds(rows, "label", "id", 5).collect()}
    b = {r.id: r.fold for r in folds.stratified_folds(rows.repartition(7), "label", "id", 5).collect()}
    assert a == b
    sizes = [sum(1 for i, f in a.items() if f == k and i % 4 == 0) for k in range(5)]
    assert max(sizes) - min(sizes) <= 1


def test_global_place_is_a_permutation(spark):
    rows = spark.range(500).selectExpr("id", "CAST(id % 7 AS double) / 10 AS s")
    places = blending.global_place(rows, "s", "id", "p").orderBy("p").collect()
    assert [r.p for r in places] == list(range(500))
    assert [r.s for r in places] == sorted(r.s for r in places)


def test_submission_with_repeated_ids_is_rejected(spark):
    ref = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    good = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id int, prediction int")
    assert decisions.submission_report(good, ref).first().valid == 1
    bad = decisions.submission_report(good.union(good.limit(1)), ref).first()
    assert (bad.valid, bad.repeated_ids) == (0, 1)
