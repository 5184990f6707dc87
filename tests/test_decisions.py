"""Error tags, risk, families, pseudo-labels, submissions and negative pools on small tables with known results."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.functions.attributes import with_attributes
from quillon.functions.intent import query_intent
from quillon.operators import decisions as D
from quillon.operators import negatives as N
from quillon.operators import ordering, registry
from quillon.operators.retrieval import tfidf_search


def test_errors_have_tags(spark):
    rows = [(1, 1, 0.2, "nike ayakkabı", "adidas sneaker", 1, 0, "positive"), (2, 0, 0.8, "nike ayakkabı", "nike şort", 0, 0, "same_brand"), (3, 1, 0.9, "erkek ceket", "erkek ceket", 0, 0, "positive"), (4, 0, 0.1, "erkek ceket", "kadın elbise", 0, 1, "easy")]
    out = {r.id: r for r in D.error_tags(spark.createDataFrame(rows, "id int, label int, proba double, query string, title string, brand_contradiction_flag int, gender_conflict_flag int, negative_type string")).collect()}
    assert [out[i].is_error for i in (1, 2, 3, 4)] == [1, 1, 0, 0]
    assert "brand_mismatch" in out[1].tags and "title_ambiguity" in out[1].tags and "gender_conflict" in out[4].tags
    assert (out[1].error_type, out[2].error_type, out[3].error_type) == ("FN", "FP", None)


def test_pseudo_labels_need_support_and_conflict(spark):
    rows = [(5, 0.97, 0.5, 1.0, 0, 0), (6, 0.02, 0.0, 0.0, 1, 1), (7, 0.97, 0.05, 0.0, 0, 0), (8, 0.02, 0.5, 0.0, 0, 0), (9, 0.7, 0.5, 1.0, 0, 0)]
    df = spark.createDataFrame(rows, "id int, proba double, lex_token_overlap_ratio double, retrieval_bm25_score double, attr_conflict_count int, gender_conflict_flag int")
    out = {r.id: (r.pseudo_label, r.pseudo_reason) for r in D.pseudo_labels(df, "dual", [], least_margin=0.3).collect()}
    assert out == {5: (1, "high_confidence_positive"), 6: (0, "high_confidence_negative"), 7: (None, "positive_without_support_signals"), 8: (None, "negative_without_conflict_signal"), 9: (None, "low_agreement_or_margin")}
    assert D.pseudo_labels(df, "positive_only", []).where("pseudo_label = 0").count() == 0
    assert D.pseudo_labels(df, "disabled", []).where("pseudo_label IS NOT NULL").count() == 0


def test_public_scores_are_linked_and_flagged(spark):
    log = spark.createDataFrame([("e1", "tab_base", "tabular", "term_group", 0.47, 0.70, 0.65, "False", ""), ("e2", "dense_aggressive", "tabular", "term_group", 0.91, 0.69, 0.62, "True", "")], "experiment_id string, experiment_name string, model_type string, validation_version string, best_threshold double, oof_macro_f1 double, class0_f1 double, threshold_fragile string, public_lb_score string")
    manual = spark.createDataFrame([("e1", 0.5, "s0.csv", "2024-01-01"), ("e1", 0.71, "s1.csv", "2024-01-02"), ("e2", 0.72, "s2.csv", "2024-01-02")], "experiment_id string, public_lb_score double, file_path string, submission_timestamp string")
    table = registry.linked(registry.normalized_log(log, "experiment"), manual.limit(0), manual).withColumn("ord", F.substring("experiment_id", 2, 1).cast("int"))
    out = {r.experiment_id: r for r in registry.risk_flags(table, "ord").collect()}
    assert (out["e1"].public_lb_score, out["e2"].public_lb_score) == (0.71, 0.72)
    assert {"PUBLIC_UP_OOF_DOWN", "PUBLIC_UP_CLASS0_DOWN", "THRESHOLD_FRAGILE", "DENSE_ARTIFACT_RISK"} <= set(out["e2"].flags)
    assert (out["e1"].strategic_status, out["e2"].strategic_status) == ("private_safe", "public_optimistic")
    assert registry.recommended_splitter(registry.splitter_reliability(registry.risk_flags(table, "ord"))) == "term_group"
    assert registry.recommended_splitter(registry.splitter_reliability(registry.risk_flags(table.limit(0), "ord"))) == "term_group"


def test_weights_of_families_sum_to_one(spark):
    rows = [("m1", "tabular", 0.7, 0.66, 0.47, 0.8), ("m2", "dense_enhanced", 0.71, 0.64, 0.43, 0.7)]
    pool = spark.createDataFrame(rows, "experiment_id string, model_family string, oof double, class0 double, threshold double, selection_score double").withColumn("flags", F.array().cast("array<string>"))
    found = registry.final_families(pool).collect()
    for name, offset, members in (("family_A_balanced", 0.45, 2), ("family_B_defensive", 0.49, 2), ("family_C_aggressive", 0.40, 1)):
        own = [r for r in found if r.family_name == name]
        assert len(own) == members and sum(r.weight for r in own) == pytest.approx(1) and {r.threshold for r in own} == {offset}


def test_unsafe_submissions_are_set_aside(spark, tmp_path):
    reference = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    good, bad = (spark.createDataFrame(rows, "id int, prediction int") for rows in ([(1, 0), (2, 1), (3, 1)], [(1, 1), (2, 0), (2, 1)]))
    assert D.save_submission(good, reference, str(tmp_path / "sub"))["valid"] == 1
    assert (tmp_path / "sub").is_dir()
    with pytest.raises(ValueError, match="repeated_ids"):
        D.save_submission(bad, reference, str(tmp_path / "bad"))
    assert (tmp_path / "bad.unsafe.csv").is_dir() and not (tmp_path / "bad").exists()
    with pytest.raises(ValueError, match="warnings"):
        D.save_submission(good, reference, str(tmp_path / "same"), spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "id int, prediction int"), fail_on_warning=True)


def test_places_and_quantiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    rows = [("a" if i % 3 else None, float(v)) for i, v in enumerate(np.round(rng.normal(size=2000), 2))] + [("a", 0.5)] * 700 + [("a", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    out = {r.g: (r.p10, r.p50, r.p95) for r in ordering.quantiles(df, "x", {"p10": 0.1, "p50": 0.5, "p95": 0.95}, ["g"]).collect()}
    for g in ("a", None):
        assert out[g] == pytest.approx(np.percentile([v for k, v in rows if k == g and v is not None], [10, 50, 95]))
    ranks = {(r.g, r.x): r.r for r in ordering.average_ranks(df.where("x IS NOT NULL"), "x", ["g"], "r").collect()}
    held = np.array([v for k, v in rows if k == "a" and v is not None])
    assert ranks["a", 0.5] == (held < 0.5).sum() + ((held == 0.5).sum() + 1) / 2
    assert ordering.quantiles(df.limit(0), "x", {"p": 0.5}).where("p IS NOT NULL").count() == 0


def test_previous_row_of_the_whole_table(spark):
    df = spark.range(0, 5000, 3).selectExpr("id AS k", "id * 2 AS v")
    out = {r.k: r.prev_v for r in ordering.with_previous(df, "k", ["v"]).collect()}
    assert out == {k: (k - 3) * 2 if k else None for k in range(0, 5000, 3)}


ITEMS = [
    (1, "Nike beyaz kadın sneaker", "sneaker", "Nike", "Kadın", "Yetişkin", "renk: beyaz, stil: spor"), (2, "Nike erkek şort", "şort", "Nike", "Erkek", "Yetişkin", "renk: siyah"),
    (3, "Adidas beyaz spor çorap", "çorap", "Adidas", "Kadın", "Yetişkin", "renk: beyaz"), (4, "Erkek suni deri ceket", "ceket", "Derimod", "Erkek", "Yetişkin", "renk: siyah, materyal: suni deri"),
    (5, "Kadın siyah hakiki deri ceket", "ceket", "Derimod", "Kadın", "Yetişkin", "renk: siyah, materyal: hakiki deri"), (6, "Bebek pamuk zıbın", "zıbın", "MiniCo", "Bebek", "Bebek", "materyal: pamuk"),
    (7, "Unisex okul çantası", "okul çantası", "BagCo", "Unisex", "Çocuk", "renk: siyah"), (8, "Koşu ayakkabısı 42", "ayakkabı", "RunCo", "Erkek", "Yetişkin", "numara: 42"),
]


def test_pools_hold_real_candidates_and_no_known_positive(spark):
    items = with_attributes(spark.createDataFrame(ITEMS, "item_id bigint, title string, category string, brand string, gender string, age_group string, attributes string"))
    terms = query_intent(spark.createDataFrame([(11, "nike beyaz kadın sneaker"), (12, "erkek deri ceket")], "term_id bigint, query string"))
    positives = spark.createDataFrame([(11, 1), (12, 5)], "term_id bigint, item_id bigint")
    hits = tfidf_search(items, terms, "item_id", "title", "term_id", "query", 20)
    found = N.decided(N.pool_candidates(terms, items, positives, hits, hits, 10))
    mined = N.mine_by_pools(found, {p: 2 for _, p in N.POOLS}, "term_id", "item_id", "pool", [F.col("item_id")], F.col("accepted")).collect()
    pairs = [(r.term_id, r.item_id) for r in mined if r.selected]
    assert len(pairs) == len(set(pairs)) and not {(11, 1), (12, 5)} & set(pairs)
    pool = lambda name, term: {r.item_id for r in found.where(f"pool = '{name}' AND term_id = {term}").collect()}
    assert pool("category_filtered_pool", 12) == {4} and pool("brand_aware_pool", 11) == {2}
    assert pool("lexical_nearest_pool", 11) == {2, 3, 5} and pool("attribute_conflict_pool", 11) == {2, 3, 5}
    assert 4 in pool("dense_nearest_pool", 12) and not pool("random_far_pool", 11) & {2, 3}
    conflict = found.where("item_id = 2 AND term_id = 11").first()
    assert (conflict.gender_conflict_flag, conflict.category_match_flag, conflict.brand_match_flag) == (1, False, True)


def test_running_sums_by_range_take_what_one_window_takes(spark):
    rows = spark.createDataFrame([(k, i, i * 7919 % 1000) for k, n in ((1, 500), (2, 40), (None, 30)) for i in range(n)], "k bigint, i bigint, place bigint")
    order, accepted = [F.col("place"), F.col("i")], F.col("i") % 3 != 0
    for quota in (1, 25, 1000):
        one = {tuple(r) for r in N.take_quota(rows, "k", order, accepted, quota).collect()}
        assert {tuple(r) for r in N.take_quota(rows, "k", order, accepted, quota, (F.col("place") / 100).cast("int")).collect()} == one


def test_every_pool_is_deep_enough_for_its_quota(spark):
    """Two terms of three and five positives among 900 items: each pool offers twelve a wanted negative, and its quota binds."""
    items = [(i, f"siyah ceket model {i % 50}" if i % 2 else f"beyaz ceket model {i % 50}", "ceket" if i % 3 else "mont", "Nike" if i % 4 else "Puma", "Kadın", "Yetişkin", "renk: siyah" if i % 2 else "renk: beyaz") for i in range(900)]
    items = with_attributes(spark.createDataFrame(items, "item_id bigint, title string, category string, brand string, gender string, age_group string, attributes string"))
    terms = query_intent(spark.createDataFrame([(1, "siyah ceket"), (2, "beyaz ceket model")], "term_id bigint, query string"))
    positives = spark.createDataFrame([(1, i) for i in (1, 5, 7)] + [(2, i) for i in (2, 4, 8, 10, 14)], "term_id bigint, item_id bigint")
    size = positives.groupBy("term_id").agg(F.count("*").alias("n_pos")).withColumn("depth", N.request_depth(F.col("n_pos")))
    hits = tfidf_search(items, terms, "item_id", "title", "term_id", "query", 2000)
    # scores that no rule calls too close, so that a pool's candidates are accepted
    hits = hits.withColumn("score", F.lit(0.5) + F.col("item_id") / 10000).select("term_id", "item_id", "score")
    found = N.decided(N.pool_candidates(terms, items, positives, hits, hits, size, far=0.9)).join(size, "term_id")
    offered = {(r.term_id, r.pool): r.n for r in found.groupBy("term_id", "pool").agg(F.count("*").alias("n")).collect()}
    for (term, pool), n in offered.items():
        assert n == {1: 36, 2: 60}[term], pool
    out = N.mine_by_pools(found, {p: F.col("n_pos") for _, p in N.POOLS}, "term_id", "item_id", "pool", [F.md5(F.col("item_id").cast("string"))], F.col("accepted"), F.conv(F.substring(F.md5(F.col("item_id").cast("string")), 1, 2), 16, 10).cast("int"))
    taken = {(r.term_id, r.pool): r.n for r in out.groupBy("term_id", "pool").agg(F.sum("selected").alias("n")).collect()}
    assert len(offered) == len(taken) == 12
    for (term, _), n in taken.items():
        assert n == {1: 3, 2: 5}[term]


DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are absent")
def test_stacked_and_iterated_models_cover_all_rows(spark):
    from quillon.plans import QUERIES
    from quillon.plans.catalog import view

    n = view(spark, DATA, "scored").count()
    row = QUERIES["stacked_oof"](spark, DATA).first()
    assert row.tp + row.fp + row.fn + row.tn == n
    out = QUERIES["iterated_pseudo_labels"](spark, DATA).collect()
    assert sum(r.n for r in out if r.pseudo_iter is None) == view(spark, DATA, "scored").where("id % 5 < 2").count()
