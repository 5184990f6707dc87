"""Queries: error analysis, risk, candidates, pseudo-labels, submissions and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillon.functions.text import token_set
from quillon.operators import decisions as D
from quillon.operators import registry as G
from quillon.operators.blending import normalized_weight
from quillon.operators.joins import star_join
from quillon.streaming.answers import answered
from quillon.streaming.windows import sessions, tumbling_counts

from .catalog import Registry, cte, source, view
from .relational import TOKENS, WIDE

query = Registry()

#: Flags of the error rules, made from a pair's id.
_FLAGS = (
    "CAST((id * 7919) % 10007 AS double) / 10007 AS proba",
    "CASE WHEN id % 11 = 0 THEN NULL ELSE CAST(id % 3 = 0 AS int) END AS brand_contradiction_flag",
    "CAST(id % 5 = 0 AS int) AS has_brand_token",
    "CAST(id % 2 = 0 AS int) AS brand_exact_match",
    "CAST(id % 4 AS int) AS cat_token_overlap_count",
    "CAST(id % 3 = 1 AS int) AS has_category_token",
    "CAST(id % 8 = 0 AS int) AS attr_conflict_count",
    "CAST(id % 9 = 0 AS int) AS attr_color_conflict_flag",
    "CAST(id % 10 = 0 AS int) AS gender_conflict_flag",
    "CAST(id % 12 = 0 AS int) AS age_conflict_flag",
    "CAST(id % 13 = 0 AS int) AS is_short_query",
    "CAST(id % 14 = 0 AS int) AS possible_typo_or_ambiguous",
    "CAST(id % 15 = 0 AS int) AS attr_color_missing_when_query_has_color",
    "CASE id % 6 WHEN 0 THEN 'easy' WHEN 1 THEN '' ELSE 'positive' END AS negative_type",
    "CASE id % 7 WHEN 0 THEN 'dense_nearest_pool' WHEN 1 THEN 'random_far_pool' END AS source_pool",
)
_Q, _T = TOKENS.format("query"), TOKENS.format("title")
_on = lambda c: f"coalesce({c}, 0) <> 0"
_ERRORS = (
    WIDE
    + f""", p AS (SELECT id, label, attributes, list_distinct({_Q}) AS q, list_distinct({_T}) AS t, {", ".join(_FLAGS)} FROM wide), w AS (SELECT *, CAST(proba >= 0.5 AS int) AS pred FROM p), e AS (SELECT *, pred <> label AS wrong FROM w),
g AS (SELECT *, list_filter([
  CASE WHEN {_on("brand_contradiction_flag")} OR ({_on("has_brand_token")} AND NOT {_on("brand_exact_match")} AND wrong) THEN 'brand_mismatch' END,
  CASE WHEN cat_token_overlap_count = 0 AND {_on("has_category_token")} AND wrong THEN 'category_mismatch' END,
  CASE WHEN {_on("attr_conflict_count")} OR {_on("attr_color_conflict_flag")} THEN 'attribute_mismatch' END, CASE WHEN {_on("gender_conflict_flag")} THEN 'gender_conflict' END, CASE WHEN {_on("age_conflict_flag")} THEN 'age_group_conflict' END,
  CASE WHEN len(t) <= 2 OR (len(q) > 0 AND len(list_intersect(q, t)) = 0 AND wrong) THEN 'title_ambiguity' END, CASE WHEN {_on("is_short_query")} OR len(q) <= 2 THEN 'query_ambiguity' END, CASE WHEN {_on("possible_typo_or_ambiguous")} THEN 'typo_spelling_issue' END,
  CASE WHEN trim(coalesce(attributes, '')) = '' OR {_on("attr_color_missing_when_query_has_color")} THEN 'missing_attribute_issue' END, CASE WHEN label = 1 AND negative_type NOT IN ('', 'positive') THEN 'false_negative_sampling_issue' END,
  CASE WHEN source_pool IN ('lexical_nearest_pool', 'dense_nearest_pool', 'category_filtered_pool', 'brand_aware_pool') AND wrong THEN 'retrieval_source_issue' END,
  CASE WHEN abs(proba - 0.5) <= 0.05 THEN 'threshold_error' END, CASE WHEN (label = 0 AND proba >= 0.9) OR (label = 1 AND proba <= 0.1) THEN 'calibration_error' END], lambda x: x IS NOT NULL) AS tags FROM e),
f AS (SELECT id, wrong, CASE WHEN wrong THEN CASE WHEN pred = 1 THEN 'FP' ELSE 'FN' END END AS error_type, round(abs(proba - 0.5) * 2, 6) AS confidence,
  CASE WHEN len(tags) > 0 THEN list_sort(tags) WHEN len(q) > 0 AND len(t) > 0 AND len(list_intersect(q, t)) = 0 THEN ['synonym_vocabulary_issue'] ELSE ['query_ambiguity'] END AS tags FROM g)"""
)


def _wide(spark, d):
    return star_join(view(spark, d, "pairs"), view(spark, d, "terms"), view(spark, d, "items"), check=False)


def _errors(spark, d):
    terms = view(spark, d, "terms").withColumn("_query_set", token_set(F.col("query")))
    items = view(spark, d, "items").withColumn("_title_set", token_set(F.col("title")))
    wide = star_join(view(spark, d, "pairs"), terms, items, check=False)
    return D.error_tags(wide.selectExpr("id", "label", "query", "title", "attributes", "_query_set", "_title_set", *_FLAGS))


@query(_ERRORS + " SELECT id, CAST(wrong AS int) AS is_error, error_type, confidence, array_to_string(tags, '|') AS tags FROM f")
def error_taxonomy(spark, d):
    """Tags of all pairs, right and wrong ones."""
    return _errors(spark, d).select("id", "is_error", "error_type", "confidence", F.array_join("tags", "|").alias("tags"))


@query(_ERRORS + " SELECT error_type, tag, count(*) AS n FROM (SELECT error_type, unnest(tags) AS tag FROM f WHERE wrong) GROUP BY ALL")
def error_tag_counts(spark, d):
    return D.tag_counts(_errors(spark, d).where("is_error = 1"))


@query(_ERRORS + """, s AS (SELECT DISTINCT unnest(tags) AS tag FROM f WHERE wrong), a AS (SELECT * FROM (VALUES (1, ['attribute_mismatch', 'missing_attribute_issue'], 'widen attribute parsing and features'), (2, ['brand_mismatch'], 'raise the share of same-brand negatives'),
(3, ['gender_conflict', 'age_group_conflict'], 'strengthen gender and age rules'), (4, ['category_mismatch'], 'add category hierarchy features'), (5, ['retrieval_source_issue'], 'analyse the quality of retrieval pools'), (6, ['threshold_error'], 'analyse the trade-off around the threshold'),
(7, ['calibration_error'], 'calibrate probabilities or blend weights'), (8, ['false_negative_sampling_issue'], 'tighten the safety of negatives')) AS v(n, tags, action))
SELECT coalesce(string_agg(action, '|' ORDER BY n), 'review segments and disagreement of models') AS actions FROM a WHERE EXISTS (SELECT 1 FROM s WHERE list_contains(a.tags, s.tag))""")
def action_suggestions(spark, d):
    return D.suggested_actions(D.tag_counts(_errors(spark, d).where("is_error = 1"))).select(F.array_join("actions", "|").alias("actions"))


@query(_ERRORS + " SELECT error_type, id, confidence, CAST(place AS int) AS place FROM (SELECT *, row_number() OVER (PARTITION BY error_type ORDER BY confidence DESC, id) AS place FROM f WHERE wrong) WHERE place <= 3")
def top_confident_errors(spark, d):
    return D.examples_per_class(_errors(spark, d).where("is_error = 1"), "error_type", [F.desc("confidence"), F.asc("id")]).select("error_type", "id", "confidence", "place")


_words = lambda c: f"list_filter(string_split_regex(trim({c}), '\\s+'), lambda w: w <> '')"
_CLASSES = (
    WIDE
    + f""", c AS (SELECT id, label, CAST((id * 7919) % 10007 >= 5000 AS int) AS pred, CAST((id * 104729) % 1009 AS double) / 1009 AS confidence, lower(query) AS q, lower(title) AS p, CASE id % 4 WHEN 0 THEN 'red' WHEN 1 THEN 'unknown' ELSE lower(brand) END AS b, lower(category) AS k FROM wide),
x AS (SELECT *, list_distinct({_words("q")}) AS qs, list_distinct({_words("p")}) AS ps, list_distinct({_words("replace(k, '>', ' ')")}) AS ks, {_words("q")} AS ws, label = 0 AND pred >= 1 AS over, label >= 1 AND pred = 0 AS under FROM c WHERE label <> pred),
y AS (SELECT id, CASE WHEN b NOT IN ('', 'unknown') AND contains(q, b) AND over THEN 'BRAND_MISMATCH' WHEN len(list_intersect(ks, qs)) = 0 AND len(qs) >= 3 AND under THEN 'CATEGORY_MISMATCH'
  WHEN regexp_matches(q, 'canta|cuzdan|kemer|sapka|atki|eldiven|kolye|bileklik|saat|gozluk|aksesuar') AND under THEN 'ACCESSORY_CONFUSION' WHEN len(list_intersect(qs, ps)) >= 2 AND (over OR under) THEN 'SEMANTIC_ERROR' WHEN len(ws) <= 1 THEN 'DATA_NOISE'
  WHEN confidence > 0.9 THEN 'CONFIDENCE_ERROR' WHEN confidence > 0.4 AND confidence < 0.6 THEN 'BOUNDARY_ERROR' ELSE 'OTHER' END AS error_class, confidence FROM x)"""
)


@query(_CLASSES + " SELECT error_class, id, CAST(place AS int) AS place, n FROM (SELECT *, row_number() OVER (PARTITION BY error_class ORDER BY confidence DESC, id) AS place, count(*) OVER (PARTITION BY error_class) AS n FROM y) WHERE place <= 3")
def error_classes(spark, d):
    """Three examples of each class of wrong predictions, with the size of the class."""
    brand = "CASE id % 4 WHEN 0 THEN 'red' WHEN 1 THEN 'unknown' ELSE brand END AS brand"
    rows = _wide(spark, d).selectExpr("id", "label", "query", "title", "category", brand, "CAST((id * 7919) % 10007 >= 5000 AS int) AS pred", "CAST((id * 104729) % 1009 AS double) / 1009 AS confidence").where("label <> pred")
    classed = rows.withColumn("error_class", D.error_class(*map(F.col, ("query", "title", "brand", "category", "label", "pred", "confidence"))))
    sizes = classed.groupBy("error_class").agg(F.count("*").alias("n"))
    return D.examples_per_class(classed, "error_class", [F.desc("confidence"), F.asc("id")]).join(sizes, "error_class").select("error_class", "id", "place", "n")


_FAMILY = """CASE WHEN contains(x, 'ensemble') OR contains(x, 'blend') OR contains(x, '+') THEN 'ensemble' WHEN contains(x, 'transformer') OR contains(x, 'ce_best') THEN 'transformer_ce' WHEN contains(x, 'sklearn_text') OR contains(x, 'cross_encoder') OR contains(x, 'pair-text') THEN 'sklearn_text'
  WHEN contains(x, 'dense') THEN 'dense_enhanced' WHEN contains(x, 'retrieval') THEN 'retrieval_heavy' WHEN contains(x, 'tab') THEN 'tabular' ELSE 'unknown' END"""
#: The log of odd experiments as it is, and that of even ones as a table of ablations, under common names.
_LOGS = (
    cte("experiments", "submissions")
    + f""", base AS (SELECT ord, experiment_id, experiment_name, validation_version AS splitter, try_cast(best_threshold AS double) AS threshold, try_cast(oof_macro_f1 AS double) AS oof, class0_f1 AS class0, class1_f1 AS class1, threshold_fragile AS threshold_fragility,
  CASE WHEN ord % 2 = 0 THEN seed_std END AS seed_std, public_lb_score, submission_note AS notes, CASE WHEN ord % 2 = 0 THEN changed_component END AS changed_component, CASE WHEN ord % 2 = 0 THEN status END AS status,
  lower(concat_ws(' ', experiment_name, category, changed_component, submission_note)) AS x FROM experiments),
log AS (SELECT * EXCLUDE (x), {_FAMILY} AS model_family FROM base),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY submission_timestamp DESC, file_path DESC) AS r FROM submissions WHERE NOT manual) WHERE r = 1),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY submission_timestamp DESC, file_path DESC) AS r FROM submissions WHERE manual) WHERE r = 1),
linked AS (SELECT log.* EXCLUDE (public_lb_score, notes), coalesce(m.public_lb_score, s.public_lb_score, log.public_lb_score) AS public_lb_score, coalesce(nullif(m.file_path, ''), nullif(s.file_path, '')) AS file_path,
  coalesce(nullif(m.submission_timestamp, ''), nullif(s.submission_timestamp, '')) AS submission_timestamp, coalesce(nullif(m.chosen_family_label, ''), nullif(s.chosen_family_label, ''), model_family) AS chosen_family_label,
  concat_ws(' | ', nullif(log.notes, ''), nullif(s.submission_notes, ''), nullif(m.submission_notes, '')) AS notes FROM log LEFT JOIN s USING (experiment_id) LEFT JOIN m USING (experiment_id)),
moved AS (SELECT *, public_lb_score - oof AS gap, oof - lag(oof) OVER (ORDER BY ord) AS od, class0 - lag(class0) OVER (ORDER BY ord) AS cd, public_lb_score - lag(public_lb_score) OVER (ORDER BY ord) AS pd, lower(concat_ws(' ', model_family, changed_component, experiment_name, notes)) AS x FROM linked),
risky AS (SELECT *, list_filter([CASE WHEN pd > 0 AND od < 0 THEN 'PUBLIC_UP_OOF_DOWN' END, CASE WHEN pd > 0 AND cd < 0 THEN 'PUBLIC_UP_CLASS0_DOWN' END, CASE WHEN lower(threshold_fragility) IN ('true', '1', 'yes', 'y') THEN 'THRESHOLD_FRAGILE' END, CASE WHEN seed_std > 0.015 THEN 'SPLITTER_INCONSISTENT' END,
  CASE WHEN contains(model_family, 'ensemble') AND gap > 0.02 THEN 'ENSEMBLE_OVERFIT_RISK' END, CASE WHEN contains(x, 'dense') THEN 'DENSE_ARTIFACT_RISK' END, CASE WHEN contains(x, 'retrieval') THEN 'RETRIEVAL_FEATURE_DRIFT' END, CASE WHEN gap > 0.03 THEN 'PRIVATE_UNSAFE_CANDIDATE' END], lambda v: v IS NOT NULL) AS flags FROM moved),
flagged AS (SELECT *, array_to_string(flags, '|') AS risk_flag, CASE WHEN list_has_any(flags, ['PRIVATE_UNSAFE_CANDIDATE', 'PUBLIC_UP_OOF_DOWN', 'PUBLIC_UP_CLASS0_DOWN']) THEN 'public_optimistic'
  WHEN len(list_intersect(flags, ['DENSE_ARTIFACT_RISK', 'RETRIEVAL_FEATURE_DRIFT', 'ENSEMBLE_OVERFIT_RISK', 'THRESHOLD_FRAGILE', 'SPLITTER_INCONSISTENT'])) >= 2 THEN 'high_risk_experimental' WHEN oof IS NOT NULL AND class0 IS NOT NULL AND len(flags) = 0 THEN 'private_safe'
  WHEN oof IS NOT NULL AND len(flags) <= 1 THEN 'balanced_candidate' WHEN oof IS NULL AND public_lb_score IS NOT NULL THEN 'do_not_use_for_final' ELSE 'high_risk_experimental' END AS strategic_status FROM risky)"""
)


def _linked(spark, d):
    raw = view(spark, d, "experiments").withColumn("_o", F.col("ord"))
    named = {"experiment_id": "ablation_id", "validation_version": "splitter", "oof_macro_f1": "OOF macro-F1", "class0_f1": "class0 F1", "class1_f1": "class1 F1", "threshold_fragile": "threshold_fragility", "submission_note": "note"}
    own = G.normalized_log(raw.where("ord % 2 = 1"), "experiment")
    ablations = G.normalized_log(raw.where("ord % 2 = 0").withColumnsRenamed(named), "ablation")
    log = own.unionByName(ablations, allowMissingColumns=True)
    sent = view(spark, d, "submissions")
    manual = sent.where("manual").drop("manual").withColumnRenamed("submission_notes", "notes")
    return G.linked(log, sent.where("NOT manual").drop("manual"), manual).withColumn("ord", F.col("experiment_id").cast("bigint"))


def _flagged(spark, d):
    return G.risk_flags(_linked(spark, d), "ord")


_LINKED = ("experiment_id", "experiment_name", "model_family", "splitter", "threshold", "oof", "public_lb_score", "file_path", "submission_timestamp", "chosen_family_label", "notes")


@query(_LOGS + f" SELECT {', '.join(_LINKED)} FROM linked")
def linked_experiments(spark, d):
    """Normalised logs with their latest submission and latest manual entry."""
    return _linked(spark, d).select(*_LINKED)


@query(_LOGS + " SELECT experiment_id, risk_flag AS flags, strategic_status FROM flagged")
def risk_flags_lag(spark, d):
    return _flagged(spark, d).select("experiment_id", F.array_join("flags", "|").alias("flags"), "strategic_status")


@query(cte("registry") + """, m AS (SELECT *, oof_macro_f1 - lag(oof_macro_f1) OVER (PARTITION BY family ORDER BY experiment_id) AS od, public_score - lag(public_score) OVER (PARTITION BY family ORDER BY experiment_id) AS pd FROM registry)
SELECT family, count(*) AS steps, round(avg(CAST(sign(od) = sign(pd) AS int)), 6) AS agreement FROM m WHERE od IS NOT NULL GROUP BY 1""")
def sign_agreement(spark, d):
    return D.sign_agreement(view(spark, d, "registry"), "experiment_id", "oof_macro_f1", "public_score", "family")


@query(_LOGS + """ SELECT model_family, count(*) AS n_experiments, count(gap) AS n_public, round(avg(oof), 6) AS oof_mean, round(avg(class0), 6) AS class0_mean, round(avg(gap), 6) AS gap_mean, round(stddev_pop(gap), 6) AS gap_std,
count_if(regexp_matches(risk_flag, 'PUBLIC_UP|PRIVATE_UNSAFE')) AS public_optimistic_count, count_if(regexp_matches(risk_flag, 'DENSE_ARTIFACT|RETRIEVAL_FEATURE')) AS dense_or_retrieval_risk_count FROM flagged GROUP BY 1""")
def model_family_drift(spark, d):
    return G.family_drift(_flagged(spark, d))


@query(_LOGS + """, r AS (SELECT coalesce(splitter, 'unknown') AS splitter, count(*) AS n_experiments, count(gap) AS n_public, round(avg(gap), 6) AS gap_mean, round(stddev_pop(gap), 6) AS gap_std, round(coalesce(-avg(gap), 0), 6) AS conservative_score, count_if(regexp_matches(risk_flag, 'PRIVATE_UNSAFE|PUBLIC_UP')) AS high_risk_count FROM flagged GROUP BY 1)
SELECT *, round(n_public * 0.1 - high_risk_count - coalesce(gap_std, 0), 6) AS score FROM r""")
def splitter_reliability(spark, d):
    return G.splitter_reliability(_flagged(spark, d))


@query(_LOGS + """ SELECT coalesce(threshold < 0.2 OR threshold > 0.8, false) AS threshold_extreme_flag, coalesce(lower(threshold_fragility), '') IN ('true', '1') AND public_lb_score IS NOT NULL AS threshold_public_risk_flag, count(*) AS n FROM flagged GROUP BY ALL""")
def threshold_reliability(spark, d):
    return G.threshold_reliability(_flagged(spark, d)).groupBy("threshold_extreme_flag", "threshold_public_risk_flag").agg(F.count("*").alias("n"))


_POOL = _LOGS + """, pool AS (SELECT *, round(oof + 0.15 * coalesce(class0, 0) + 0.02 * coalesce(public_lb_score, 0) - CASE WHEN regexp_matches(risk_flag, 'PUBLIC_UP_OOF_DOWN|PUBLIC_UP_CLASS0_DOWN|PRIVATE_UNSAFE') THEN 0.1 ELSE 0 END, 6) AS selection_score FROM flagged WHERE oof IS NOT NULL
ORDER BY selection_score DESC, experiment_id LIMIT 20)"""


@query(_POOL + " SELECT experiment_id, model_family, selection_score FROM pool")
def candidate_score(spark, d):
    return G.candidate_pool(_flagged(spark, d)).select("experiment_id", "model_family", "selection_score")


_FAMILIES = _POOL + """, c AS (SELECT *, regexp_matches(model_family, 'dense|ce|text|ensemble|semantic') AS sem FROM pool),
f AS (SELECT 'family_A_balanced' AS family_name, * FROM (SELECT * FROM c WHERE NOT regexp_matches(risk_flag, 'PUBLIC_UP|PRIVATE_UNSAFE') ORDER BY selection_score DESC, experiment_id LIMIT 3)
UNION ALL SELECT 'family_B_defensive', * FROM (SELECT * FROM c ORDER BY class0 DESC, selection_score DESC, experiment_id LIMIT 3)
UNION ALL SELECT 'family_C_aggressive', * FROM (SELECT * FROM c WHERE sem OR NOT EXISTS (SELECT 1 FROM c WHERE sem) ORDER BY selection_score DESC, experiment_id LIMIT 3)),
t AS (SELECT family_name, sum(greatest(selection_score, 0)) AS total, count(*) AS k, median(threshold) AS mid, max(oof) AS best_oof, max(class0) AS best_class0 FROM f GROUP BY 1),
families AS (SELECT family_name, experiment_id, round(CASE WHEN total > 0 THEN greatest(selection_score, 0) / total ELSE 1.0 / k END, 6) AS weight,
  round(coalesce(CASE family_name WHEN 'family_B_defensive' THEN least(0.95, mid + 0.04) WHEN 'family_C_aggressive' THEN greatest(0.05, mid - 0.03) ELSE mid END, 0.5), 6) AS threshold, best_oof, best_class0 FROM f JOIN t USING (family_name))"""


@query(_FAMILIES + " SELECT * FROM families")
def final_families(spark, d):
    return G.final_families(G.candidate_pool(_flagged(spark, d)))


_PREDICTED = "CAST((l_orderkey * 10 + l_linenumber) * (CAST(experiment_id AS bigint) + 7919) % 1000 AS double) / 1000"


@query(_FAMILIES + f""", members AS (SELECT DISTINCT experiment_id FROM families), preds AS (SELECT experiment_id, l_orderkey * 10 + l_linenumber AS id, {_PREDICTED} AS proba FROM lineitem, members WHERE l_linenumber = 1 AND NOT (CAST(experiment_id AS bigint) % 5 = 0 AND l_orderkey % 1000 = 1)),
refs AS (SELECT l_orderkey * 10 + l_linenumber AS id FROM lineitem WHERE l_linenumber = 1), b AS (SELECT family_name, id, sum(weight * proba) AS proba, count(proba) AS n, any_value(threshold) AS threshold FROM preds JOIN families USING (experiment_id) GROUP BY ALL), z AS (SELECT family_name, count(*) AS members FROM families GROUP BY 1),
r AS (SELECT z.family_name, refs.id, b.proba, b.threshold, coalesce(b.n = members, false) AS whole FROM refs CROSS JOIN z LEFT JOIN b ON b.family_name = z.family_name AND b.id = refs.id), w AS (SELECT family_name, bool_and(whole) AS complete FROM r GROUP BY 1)
SELECT family_name, complete, count(prediction) AS predicted, CAST(coalesce(sum(prediction), 0) AS bigint) AS positives FROM (SELECT family_name, complete, CASE WHEN complete THEN CAST(proba >= threshold AS int) END AS prediction FROM r JOIN w USING (family_name)) GROUP BY ALL""")
def family_submissions(spark, d):
    """Blended predictions of the final families over all orders' first lines; a family that misses an id makes none."""
    families = G.final_families(G.candidate_pool(_flagged(spark, d))).persist()
    lines = source(spark, d, "lineitem").where("l_linenumber = 1")
    members = families.select("experiment_id").distinct()
    # at most nine members
    preds = lines.join(F.broadcast(members)).where("NOT (CAST(experiment_id AS bigint) % 5 = 0 AND l_orderkey % 1000 = 1)").selectExpr("experiment_id", "l_orderkey * 10 + l_linenumber AS id", f"{_PREDICTED} AS proba")
    made = G.family_predictions(families, preds, lines.selectExpr("l_orderkey * 10 + l_linenumber AS id"))
    return made.groupBy("family_name").agg((F.count("proba") > 0).alias("complete"), F.count("prediction").alias("predicted"), F.coalesce(F.sum("prediction"), F.lit(0)).cast("bigint").alias("positives"))


@query(cte("registry") + """, t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY oof_macro_f1 DESC, experiment_id) AS place FROM registry) WHERE place <= 3)
SELECT family, experiment_id, round(oof_macro_f1 / sum(oof_macro_f1) OVER (PARTITION BY family), 6) AS weight, round(median(threshold) OVER (PARTITION BY family), 6) AS median_threshold FROM t""")
def family_top3(spark, d):
    """The three best experiments per market segment with normalised weights and their median threshold."""
    top = D.examples_per_class(view(spark, d, "registry"), "family", [F.desc("oof_macro_f1"), F.asc("experiment_id")])
    whole = Window.partitionBy("family")
    return top.select("family", "experiment_id", F.round(normalized_weight(F.col("oof_macro_f1"), whole), 6).alias("weight"), F.round(F.percentile("threshold", 0.5).over(whole), 6).alias("median_threshold"))


@query(cte("experiments") + """, a AS (SELECT experiment_id AS ablation_id, category, lower(changed_component) AS c, lower(coalesce(submission_note, '')) AS note, status, coalesce(try_cast(oof_macro_f1 AS double), 0) AS oof, class0_f1 AS class0, lower(threshold_fragile) IN ('true', '1', 'yes') AS fragile, seed_std FROM experiments),
b AS (SELECT oof AS bo, class0 AS bc FROM a WHERE ablation_id = '1'), g AS (SELECT a.*, oof - bo AS gain, class0 - bc AS gain0, category IN ('retrieval', 'dense', 'negative') AS late FROM a, b),
r AS (SELECT *, CASE WHEN status NOT IN ('completed', 'ok') THEN 'needs_fold_safe_recheck' WHEN contains(note, 'public') AND gain < 0 THEN 'high_risk_public_only' WHEN late AND (contains(c, 'dense') OR contains(c, 'retrieval')) AND NOT contains(note, 'fold') AND gain > 0.002 THEN 'needs_fold_safe_recheck'
  WHEN fragile OR seed_std > 0.015 THEN 'medium_risk_monitor' WHEN gain > 0.003 AND gain0 >= -0.002 THEN 'low_risk_keep' WHEN gain < -0.003 OR gain0 < -0.006 THEN CASE WHEN late THEN 'artifact_suspected' ELSE 'medium_risk_monitor' END ELSE 'medium_risk_monitor' END AS risk FROM g)
SELECT ablation_id, risk, CASE WHEN status <> 'completed' THEN 'Good but risky' WHEN risk = 'low_risk_keep' AND gain >= 0 THEN 'Keep no matter what' WHEN risk IN ('needs_fold_safe_recheck', 'medium_risk_monitor', 'high_risk_public_only') AND gain >= 0 THEN 'Good but risky' WHEN abs(gain) < 0.002 THEN 'Segment benefit only' ELSE 'Drop from final pipeline' END AS decision FROM r""")
def ablation_decisions(spark, d):
    log = view(spark, d, "experiments").selectExpr("experiment_id AS ablation_id", "category", "changed_component", "submission_note AS note", "status", "try_cast(oof_macro_f1 AS double) AS oof", "class0_f1 AS class0", "threshold_fragile AS threshold_fragility", "seed_std")
    return G.ablation_decisions(log, "1").select("ablation_id", "risk", "decision")


@query(cte("scored") + """, x AS (SELECT 'lang' AS segment, lang AS value, label, proba FROM scored UNION ALL SELECT 'gender', CASE id % 3 WHEN 0 THEN 'kadın' ELSE 'erkek' END, label, proba FROM scored),
c AS (SELECT segment, value, count_if(proba >= 0.5 AND label = 1) AS tp, count_if(proba >= 0.5 AND label <> 1) AS fp, count_if(proba < 0.5 AND label = 1) AS fn, count_if(proba < 0.5 AND label <> 1) AS tn FROM x GROUP BY ALL),
s AS (SELECT segment, coalesce(value, 'null') AS value, round(coalesce(2.0 * tn / nullif(2 * tn + fn + fp, 0), 0), 6) AS class0_f1, round((coalesce(2.0 * tn / nullif(2 * tn + fn + fp, 0), 0) + coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)) / 2, 6) AS macro_f1 FROM c)
SELECT segment, value, macro_f1, class0_f1, macro_f1 < 0.45 OR class0_f1 < 0.45 AS segment_collapse_flag FROM s WHERE segment = 'gender' OR macro_f1 < 0.45 OR class0_f1 < 0.45""")
def segment_collapse(spark, d):
    from quillon.operators.metrics import segment_scores

    rows = view(spark, d, "scored").withColumn("gender", F.expr("CASE id % 3 WHEN 0 THEN 'kadın' ELSE 'erkek' END"))
    return G.segment_risk(segment_scores(rows, ["lang", "gender"]).withColumnRenamed("f1_0", "class0_f1")).select("segment", "value", "macro_f1", "class0_f1", "segment_collapse_flag")


#: Signals of the pseudo-label rules, made from an id.
_SIGNALS = (
    "CASE WHEN id % 17 = 0 THEN NULL ELSE proba END AS proba",
    "CASE WHEN id % 3 = 0 THEN NULL ELSE proba_b END AS m1",
    "proba_c AS m2",
    "CASE WHEN id % 6 = 0 THEN NULL ELSE CAST(id % 10 AS double) / 25 END AS lex_token_overlap_ratio",
    "CAST(id % 4 AS double) - 2 AS retrieval_bm25_score",
    "CAST(id % 7 = 0 AS int) AS attr_conflict_count",
    "CAST(id % 9 = 0 AS int) AS gender_conflict_flag",
)
_PSEUDO = (
    cte("scored")
    + f""", v AS (SELECT id, {", ".join(_SIGNALS)} FROM scored), a AS (SELECT *, coalesce(proba, 0.5) AS p, CAST(m1 IS NOT NULL AS int) + 1 AS k, CAST(coalesce(m1 >= 0.5, false) AS int) + CAST(m2 >= 0.5 AS int) AS high FROM v),
g AS (SELECT *, CAST(greatest(high, k - high) AS double) / k AS agree FROM a),
decided AS (SELECT id, round(agree, 6) AS agreement_score, round(abs(p - 0.5), 6) AS margin, CASE WHEN agree < 0.66 OR abs(p - 0.5) < 0.35 THEN 'low_agreement_or_margin'
  WHEN p >= 0.9 THEN CASE WHEN coalesce(lex_token_overlap_ratio > 0.1, false) OR retrieval_bm25_score > 0 THEN 'high_confidence_positive' ELSE 'positive_without_support_signals' END
  WHEN p <= 0.1 THEN CASE WHEN attr_conflict_count > 0 OR gender_conflict_flag > 0 OR coalesce(lex_token_overlap_ratio < 0.05, false) THEN 'high_confidence_negative' ELSE 'negative_without_conflict_signal' END ELSE 'threshold_not_met' END AS pseudo_reason FROM g)"""
)


def _pseudo(spark, d):
    rows = view(spark, d, "scored").selectExpr("id", *_SIGNALS)
    return D.pseudo_labels(rows, "dual", ["m1", "m2"], high=0.9, low=0.1)


@query(_PSEUDO + " SELECT id, agreement_score, margin, pseudo_reason, CASE pseudo_reason WHEN 'high_confidence_positive' THEN 1 WHEN 'high_confidence_negative' THEN 0 END AS pseudo_label FROM decided")
def pseudo_labels(spark, d):
    return _pseudo(spark, d).select("id", "agreement_score", "margin", "pseudo_reason", "pseudo_label")


@query(_PSEUDO + """, c AS (SELECT count_if(pseudo_reason LIKE 'high%') AS pseudo_count, count_if(pseudo_reason NOT LIKE 'high%') AS rejected_count, count_if(pseudo_reason = 'high_confidence_positive') AS positive_count, count_if(pseudo_reason = 'high_confidence_negative') AS negative_count FROM decided)
SELECT *, CASE WHEN positive_count > 0.9 * pseudo_count THEN 'positive_skew' ELSE '' END AS risk_notes FROM c""")
def pseudo_label_report(spark, d):
    return D.pseudo_label_report(_pseudo(spark, d))


@query(cte("scored") + """, sub AS (SELECT id + CAST(id % 50 = 0 AS int) * 1000000 AS id, CASE WHEN id % 60 = 0 THEN NULL WHEN id % 70 = 0 THEN '2' ELSE CAST(CAST(proba >= 0.5 AS int) AS varchar) END AS prediction, id + CAST(id % 40 = 0 AS int) AS ord FROM scored UNION ALL SELECT id, '1', id FROM scored WHERE id % 90 = 1),
prev AS (SELECT id, CAST(proba_b >= 0.5 AS int) AS before FROM scored), own AS (SELECT count(*) AS n_rows, count(*) - count(DISTINCT id) AS repeated_ids, count_if(prediction IS NULL) AS null_predictions, count_if(prediction NOT IN ('0', '1')) AS non_binary, round(coalesce(avg(CAST(prediction AS double)), 0), 6) AS positive_rate FROM sub),
r AS (SELECT id, id AS ord FROM scored), theirs AS (SELECT count(*) AS n_reference, count(*) - count(DISTINCT id) AS repeated_reference_ids FROM r), u AS (SELECT id, min(ord) AS ord FROM sub GROUP BY 1),
ids AS (SELECT count_if(u.id IS NULL) AS missing_ids, count_if(r.id IS NULL) AS extra_ids, count_if(u.ord <> r.ord) AS out_of_order FROM r FULL JOIN u ON r.id = u.id), ch AS (SELECT round(avg(CAST(before IS NULL OR prediction IS NULL OR CAST(prediction AS double) <> before AS int)), 6) AS changed_rate FROM sub LEFT JOIN prev USING (id)),
al AS (SELECT * FROM own, theirs, ids, ch), e AS (SELECT *, concat_ws('|', CASE WHEN n_rows <> n_reference THEN 'row_count' END, CASE WHEN repeated_ids > 0 THEN 'repeated_ids' END, CASE WHEN repeated_reference_ids > 0 THEN 'repeated_reference_ids' END, CASE WHEN missing_ids + extra_ids > 0 THEN 'id_set' END,
  CASE WHEN n_rows = n_reference AND out_of_order > 0 THEN 'order' END, CASE WHEN null_predictions > 0 THEN 'null_predictions' END, CASE WHEN non_binary > 0 THEN 'non_binary' END) AS errors, concat_ws('|', CASE WHEN positive_rate < 0.001 OR positive_rate > 0.999 THEN 'positive_rate' END, CASE WHEN changed_rate > 0.25 THEN 'changed' END) AS warnings FROM al)
SELECT *, CAST(errors = '' AS int) AS valid FROM e""")
def submission_validate(spark, d):
    rows = view(spark, d, "scored")
    shifted = (F.col("id") + (F.col("id") % 50 == 0).cast("int") * 1000000).alias("id")
    made = F.when(F.col("id") % 60 == 0, None).when(F.col("id") % 70 == 0, "2").otherwise(D.binarize(F.col("proba"), 0.5).cast("string")).alias("prediction")
    given = rows.select(shifted, made, (F.col("id") + (F.col("id") % 40 == 0).cast("int")).alias("ord")).union(rows.where("id % 90 = 1").select("id", F.lit("1"), "id"))
    previous = rows.select("id", D.binarize(F.col("proba_b"), 0.5).alias("prediction"))
    return D.submission_report(given, rows.select("id", F.col("id").alias("ord")), previous)


_IMPACT = cte("scored") + """, v AS (SELECT id, round(proba * 100, 4) AS fuzzy_brand_match_score, proba_b AS jaccard_similarity, floor(proba_c * 1000) / 100 AS bm25_score, proba AS query_coverage FROM scored),
f AS (SELECT id, 'fuzzy_brand_match_score' AS feature, fuzzy_brand_match_score AS value, CASE WHEN fuzzy_brand_match_score > 85 THEN 'positive' WHEN fuzzy_brand_match_score < 40 THEN 'negative' ELSE 'neutral' END AS impact, 100.0 AS mx FROM v
UNION ALL SELECT id, 'jaccard_similarity', jaccard_similarity, CASE WHEN jaccard_similarity > 0.5 THEN 'positive' WHEN jaccard_similarity < 0.1 THEN 'negative' ELSE 'neutral' END, 1.0 FROM v
UNION ALL SELECT id, 'bm25_score', bm25_score, CASE WHEN bm25_score > 5 THEN 'positive' ELSE 'neutral' END, 20.0 FROM v UNION ALL SELECT id, 'query_coverage', query_coverage, 'neutral', 1.0 FROM v)"""


@query(_IMPACT + " SELECT id, feature, round(value, 4) AS value, impact, round(least(value / CAST(mx AS double), 1), 4) AS normalized, CAST(row_number() OVER (PARTITION BY id ORDER BY round(value, 4) DESC, feature) AS int) AS place FROM f")
def feature_impacts(spark, d):
    rows = view(spark, d, "scored").select("id", F.round(F.col("proba") * 100, 4).alias("fuzzy_brand_match_score"), F.col("proba_b").alias("jaccard_similarity"), (F.floor(F.col("proba_c") * 1000) / 100).alias("bm25_score"), F.col("proba").alias("query_coverage"))
    return D.feature_impacts(rows, "id", ["fuzzy_brand_match_score", "jaccard_similarity", "bm25_score", "query_coverage"])


@query(WIDE + f""", p AS (SELECT DISTINCT query, title, brand, category FROM wide), w AS (SELECT *, {_words("lower(query)")} AS t, lower(concat_ws(' ', title, brand, category)) AS c FROM p)
SELECT query, title, brand, category, array_to_string(list_concat(list_filter(t, lambda x: contains(c, x)), list_filter(t, lambda x: NOT contains(c, x)))[1:8], ' ') AS tokens, len(list_filter(list_concat(list_filter(t, lambda x: contains(c, x)), list_filter(t, lambda x: NOT contains(c, x)))[1:8], lambda x: contains(c, x))) AS found FROM w""")
def overlap_attention(spark, d):
    pairs = _wide(spark, d).select("query", "title", "brand", "category").distinct()
    top = pairs.withColumn("top", D.overlap_attention(F.col("query"), F.col("title"), F.col("brand"), F.col("category")))
    return top.select("query", "title", "brand", "category", F.array_join(F.transform("top", lambda t: t["token"]), " ").alias("tokens"), F.size(F.filter("top", lambda t: t["score"] == 1.0)).alias("found"))


@query(cte("scored") + """, s AS (SELECT count_if(label >= 1) AS p, count_if(label = 0) AS q FROM scored), r AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(id AS varchar)), id) AS place FROM scored WHERE label >= 1)
SELECT round(avg(proba_b + proba_c - proba), 6) AS teacher_margin_mean, count(*) AS n FROM r, s WHERE place <= least(p, q, 32)""")
def teacher_margin(spark, d):
    return D.teacher_margin(view(spark, d, "scored"), ["proba", "proba_b", "proba_c"])


@query(cte("scored") + """, s AS (SELECT id, greatest(0, least(1, (proba + proba_b + proba_c) / 3)) AS s FROM scored), c AS (SELECT id, greatest(0.02, pow(1 - s, 1.15)) AS a, greatest(0.02, 1 - abs(s - 0.5) * 1.55) AS b, greatest(0.02, pow(s, 1.25)) AS c FROM s)
SELECT id, round(a / (a + b + c), 6) AS p0, round(b / (a + b + c), 6) AS p1, round(c / (a + b + c), 6) AS p2 FROM c""")
def heuristic_classes(spark, d):
    mean = (F.col("proba") + F.col("proba_b") + F.col("proba_c")) / 3
    made = D.heuristic_classes(F.greatest(F.lit(0.0), F.least(F.lit(1.0), mean)))
    return view(spark, d, "scored").select("id", made.alias("p")).select("id", *(F.col("p")[i].alias(f"p{i}") for i in range(3)))


@query(cte("scored") + " SELECT lang, count(*) AS n FROM scored WHERE proba_b > 0.6 AND proba < 0.5 GROUP BY 1")
def alike_but_rejected(spark, d):
    """Rows predicted irrelevant although their similarity is high, by language."""
    rows = view(spark, d, "scored").withColumn("pred", D.binarize(F.col("proba"), 0.5))
    return D.confident_false_negatives(rows, "proba_b").groupBy("lang").agg(F.count("*").alias("n"))


@query()
def iterated_pseudo_labels(spark, d):
    """Rounds of pseudo-labels by a logistic model: training and added rows of the last round."""
    from quillon.operators.models import fitted_logistic

    rows = view(spark, d, "scored").select("id", "label", "proba_b", "proba_c", F.col("n_chars").cast("double").alias("size"))
    train, test = rows.where("id % 5 < 2"), rows.where("id % 5 >= 2").drop("label").withColumn("label", F.lit(None).cast("int"))
    out = D.iterated_pseudo_labels(train, test, lambda t: fitted_logistic(t, ["proba_b", "proba_c", "size"], "label"), high=0.7, low=0.3)
    return out.groupBy("pseudo_iter", "label").agg(F.count("*").alias("n"))


@query(cte("scored") + " SELECT id, round(0.08 + 0.84 * greatest(0, least(1, 0.30 * proba + 0.24 * proba_b + 0.18 * proba_c + 0.18 * label + 0.10 * toxic)), 6) AS score FROM scored")
def heuristic_scorer(spark, d):
    return view(spark, d, "scored").select("id", D.heuristic_score(F.col("proba"), F.col("proba_b"), F.col("proba_c"), F.col("label"), F.col("toxic")).alias("score"))


@query("SELECT time_bucket(INTERVAL 1 hour, ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def event_windows(spark, d):
    """Tumbling windows, an extension; the same function serves a stream."""
    return tumbling_counts(source(spark, d, "events"))


@query("""WITH o AS (SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 minutes OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM o) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 minutes AS "end", count(*) AS n FROM s GROUP BY user_id, s""")
def user_sessions(spark, d):
    return sessions(source(spark, d, "events"))


_REQUESTS = "SELECT event_id AS request_id, concat(event_type, ' ', CAST(user_id % 3 AS varchar(3))) AS query, ts FROM events"


@query(
    f"""WITH RECURSIVE r AS ({_REQUESTS}), n AS (SELECT *, min(ts) OVER (PARTITION BY query ORDER BY ts RANGE BETWEEN INTERVAL 900 SECONDS FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM r),
d AS (SELECT query, ts, any_value(nxt) AS nxt FROM n GROUP BY ALL), c AS (SELECT query, min(ts) AS ts FROM r GROUP BY 1 UNION ALL SELECT c.query, d.nxt FROM c JOIN d ON d.query = c.query AND d.ts = c.ts WHERE d.nxt IS NOT NULL),
f AS (SELECT query, ts, min(request_id) AS request_id FROM r JOIN c USING (query, ts) GROUP BY ALL)
SELECT r.request_id, r.query, r.ts, CAST(length(r.query) AS double) AS score, f.request_id IS NULL AS cached FROM r LEFT JOIN f USING (query, ts, request_id)"""
)
def scored_requests(spark, d):
    """Events as requests; the score of a query is remembered for 900 seconds. The same function serves a stream."""
    requests = source(spark, d, "events").selectExpr("event_id AS request_id", "concat(event_type, ' ', CAST(user_id % 3 AS string)) AS query", "ts")
    return answered(requests, lambda texts: texts.str.len().astype("float64"))
