"""Queries: metrics, thresholds, folds, blends and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.operators import blending as B
from quillon.operators import folds as G
from quillon.operators import metrics as M

from .catalog import Registry, cte, source, view

query = Registry()


def _confusion(by: str, threshold: str = "0.5") -> str:
    """SQL of counts and scores; ``by`` is empty or ends in a comma."""
    c = {"tp": f"count_if(proba >= {threshold} AND label = 1)", "fp": f"count_if(proba >= {threshold} AND label <> 1)", "fn": f"count_if(proba < {threshold} AND label = 1)", "tn": f"count_if(proba < {threshold} AND label <> 1)"}
    return f"SELECT {by} " + ", ".join(f"{v} AS {k}" for k, v in c.items())


_S = lambda a, b: f"CASE WHEN {b} = 0 THEN 0.0 ELSE CAST({a} AS double) / ({b}) END"
_F1, _F0 = _S("2 * tp", "2 * tp + fp + fn"), _S("2 * tn", "2 * tn + fn + fp")
_MACRO = f"round(({_F1} + {_F0}) / 2, 6)"
_ALL = f"""round({_S("tp", "tp + fp")}, 6) AS precision_1, round({_S("tp", "tp + fn")}, 6) AS recall_1, round({_F1}, 6) AS f1_1, round({_S("tn", "tn + fn")}, 6) AS precision_0, round({_S("tn", "tn + fp")}, 6) AS recall_0,
  round({_F0}, 6) AS f1_0, {_MACRO} AS macro_f1, round({_S("tp + fp", "tp + fp + fn + tn")}, 6) AS positive_rate"""
_GRID = "grid AS (SELECT round(0.05 + i * 0.01, 10) AS threshold FROM (SELECT unnest(range(0, 91)) AS i))"


def _curve(by: str = "", rows: str = "scored") -> str:
    own = f"{by}, " if by else ""
    return f"""{_GRID}, n AS ({_confusion(own + "threshold,", "threshold")} FROM {rows}, grid GROUP BY ALL), curve AS (SELECT {own}CAST(threshold AS double) AS threshold, tp, fp, fn, tn, round({_F0}, 6) AS f1_0, round({_F1}, 6) AS f1_1, {_MACRO} AS macro_f1 FROM n)"""


_SCORED = cte("scored")


@query(f"{_SCORED}, n AS ({_confusion('')} FROM scored) SELECT tp, fp, fn, tn, {_ALL} FROM n")
def confusion_at_threshold(spark, d):
    return M.confusion(view(spark, d, "scored"))


@query(f"{_SCORED}, {_curve()} SELECT * FROM curve")
def threshold_curve(spark, d):
    return M.threshold_curve(view(spark, d, "scored"))


@query(f"{_SCORED}, {_curve()} SELECT * FROM curve ORDER BY macro_f1 DESC, threshold LIMIT 1")
def best_threshold(spark, d):
    return M.best_threshold(M.threshold_curve(view(spark, d, "scored")))


_BEST = ", b AS (SELECT threshold AS best_threshold, macro_f1 AS best_macro_f1 FROM curve ORDER BY macro_f1 DESC, threshold LIMIT 1)"


@query(f"""{_SCORED}, {_curve()}{_BEST} SELECT best_threshold, best_macro_f1, round(max(best_macro_f1) - min(macro_f1), 6) AS max_drop, count(*) AS n_thresholds, CAST(round(max(best_macro_f1) - min(macro_f1), 6) > 0.01 AS int) AS fragile
FROM curve, b WHERE abs(threshold - best_threshold) <= 0.03 + 1e-9 GROUP BY 1, 2""")
def threshold_sensitivity(spark, d):
    return M.threshold_sensitivity(M.threshold_curve(view(spark, d, "scored")))


@query(f"""{_SCORED}, {_curve()}{_BEST} SELECT best_threshold AS best, round((min(threshold) + max(threshold)) / 2, 4) AS stable_midpoint, CAST(0.5 AS double) AS fixed, round(best_threshold - 0.05, 4) AS lower, round(best_threshold + 0.05, 4) AS higher
FROM curve, b WHERE macro_f1 >= best_macro_f1 - 0.002 - 1e-9 GROUP BY best_threshold""")
def stable_midpoint(spark, d):
    return M.stable_midpoint(M.threshold_curve(view(spark, d, "scored")))


@query(f"{_SCORED}, {_curve('fold')}, r AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY macro_f1 DESC, threshold) AS r FROM curve) SELECT fold, threshold, macro_f1 FROM r WHERE r = 1")
def fold_thresholds(spark, d):
    return M.best_threshold(M.threshold_curve(view(spark, d, "scored"), ["fold"]), ["fold"]).select("fold", "threshold", "macro_f1")


@query(
    f"""{_SCORED}, {_curve("lang")}, w AS ({_confusion("threshold,", "threshold")} FROM scored, grid GROUP BY ALL), g AS (SELECT CAST(threshold AS double) AS gt FROM w ORDER BY {_MACRO} DESC, threshold LIMIT 1),
k AS (SELECT lang, count(*) AS n FROM scored GROUP BY 1 HAVING count(*) >= 20 AND count(DISTINCT label) > 1), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY macro_f1 DESC, threshold) AS r FROM curve)
SELECT r.lang, r.threshold AS best_threshold, r.macro_f1 AS best_macro_f1, c.macro_f1 AS global_macro_f1, n, round(r.macro_f1 - c.macro_f1, 6) AS gain FROM r JOIN k USING (lang) JOIN g ON true JOIN curve c ON c.lang = r.lang AND abs(c.threshold - gt) < 1e-9 WHERE r = 1"""
)
def language_thresholds(spark, d):
    return M.group_thresholds(view(spark, d, "scored"), "lang")


@query(
    f"""{_SCORED}, s AS (SELECT 'lang' AS segment, coalesce(lang, 'null') AS value, proba, label FROM scored UNION ALL SELECT 'source', coalesce(source, 'null'), proba, label FROM scored UNION ALL SELECT 'toxic', coalesce(CAST(toxic AS varchar), 'null'), proba, label FROM scored),
n AS ({_confusion("segment, value,")} FROM s GROUP BY ALL) SELECT segment, value, tp, fp, fn, tn, {_ALL} FROM n"""
)
def segment_scores(spark, d):
    return M.segment_scores(view(spark, d, "scored"), ["lang", "source", "toxic"])


@query(f"{_SCORED}, n AS ({_confusion('fold,')} FROM scored GROUP BY ALL), m AS (SELECT {_MACRO} AS m FROM n) SELECT round(avg(m), 6) AS mean, round(stddev_pop(m), 6) AS std, count(*) AS n FROM m")
def seed_stability(spark, d):
    return M.seed_stability(M.confusion(view(spark, d, "scored"), by=["fold"]))


@query(f"{_SCORED} SELECT lang, count(proba) AS n, round(avg(proba), 6) AS mean, round(stddev_samp(proba), 6) AS std, min(proba) AS low, round(quantile_cont(proba, 0.25), 6) AS q25, round(quantile_cont(proba, 0.5), 6) AS q50, round(quantile_cont(proba, 0.75), 6) AS q75, max(proba) AS high FROM scored GROUP BY 1")
def describe_scores(spark, d):
    return M.describe(view(spark, d, "scored"), "proba", ["lang"])


_HASH = "CAST(('0x' || substr(md5(concat('0:', CAST({0} AS varchar))), 1, 8)) AS bigint)"


@query(f"SELECT o_custkey % 100 AS c, CAST({_HASH.format('o_custkey')} % 5 AS int) AS fold, count(*) AS n FROM orders GROUP BY ALL")
def group_fold_assignment(spark, d):
    return source(spark, d, "orders").withColumn("fold", G.group_fold(F.col("o_custkey"), 5)).groupBy((F.col("o_custkey") % 100).alias("c"), "fold").agg(F.count("*").alias("n"))


@query(f"{_SCORED}, r AS (SELECT id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {_HASH.format('id')}, id) - 1) % 5 AS int) AS fold FROM scored) SELECT id, label, fold FROM r")
def stratified_folds(spark, d):
    return G.stratified_folds(view(spark, d, "scored").drop("fold"), "label", "id", 5).select("id", "label", "fold")


@query(
    f"{_SCORED}, r AS (SELECT id, CAST((row_number() OVER (PARTITION BY label ORDER BY {_HASH.format('id')}, id) - 1) % 5 AS int) AS by_lang, CAST({_HASH.format('source')} % 5 AS int) AS by_source, (SELECT count(DISTINCT lang) FROM scored) AS langs, (SELECT count(DISTINCT source) FROM scored) AS sources FROM scored) SELECT id, by_lang, by_source FROM r WHERE langs < 5 AND sources >= 5"
)
def grouped_folds(spark, d):
    """Folds by language, which has too few groups and falls back to labels, and by source."""
    rows = view(spark, d, "scored")
    by_lang = G.grouped_folds(rows, "lang", "label", "id", 5).select("id", F.col("fold").alias("by_lang"))
    return by_lang.join(G.grouped_folds(rows, "source", "label", "id", 5).select("id", F.col("fold").alias("by_source")), "id")


@query(
    cte("pairs")
    + f""", g AS (SELECT term_id, CAST(floor(avg(label) * 10) AS int) AS band FROM pairs GROUP BY 1), f AS (SELECT term_id, CAST((row_number() OVER (PARTITION BY band ORDER BY {_HASH.format('term_id')}, term_id) - 1) % 5 AS int) AS fold FROM g)
SELECT fold, count(*) AS n, count(DISTINCT term_id) AS terms, sum(label) AS positives FROM pairs JOIN f USING (term_id) GROUP BY 1"""
)
def stratified_group_folds(spark, d):
    made = G.stratified_group_folds(view(spark, d, "pairs"), "term_id", "label", 5)
    return made.groupBy("fold").agg(F.count("*").alias("n"), F.count_distinct("term_id").alias("terms"), F.sum("label").alias("positives"))


@query("SELECT part, count(*) AS n, min(event_id) AS low, max(event_id) AS high FROM (SELECT event_id, CASE WHEN epoch_us(ts) <= (SELECT quantile_cont(CAST(epoch_us(ts) AS double), 0.8) FROM events) THEN 'train' ELSE 'test' END AS part FROM events) GROUP BY 1")
def temporal_split(spark, d):
    return G.temporal_split(source(spark, d, "events"), "ts").groupBy("part").agg(F.count("*").alias("n"), F.min("event_id").alias("low"), F.max("event_id").alias("high"))


_GREEDY = f"""g AS (SELECT term_id, n, row_number() OVER (ORDER BY n DESC, {_HASH.format('term_id')}, CAST(term_id AS varchar)) - 1 AS i FROM (SELECT term_id, count(*) AS n FROM rows GROUP BY 1)),
t AS (SELECT CAST(0 AS bigint) AS i, CAST([0, 0, 0, 0, 0] AS bigint[]) AS loads, CAST(NULL AS bigint) AS term_id, CAST(NULL AS bigint) AS n, 0 AS fold
  UNION ALL SELECT i + 1, list_transform(loads, lambda x, j: CASE WHEN j = p THEN x + m ELSE x END), group_id, m, p - 1
  FROM (SELECT t.i, t.loads, g.term_id AS group_id, g.n AS m, list_position(t.loads, list_min(t.loads)) AS p FROM t JOIN g ON g.i = t.i))
SELECT term_id, n, CAST(fold AS int) AS fold FROM t WHERE term_id IS NOT NULL"""
_UNEVEN = "SELECT * FROM pairs WHERE term_id % 7 <> 0 OR item_id % 3 = 0"


@query(cte("pairs").replace("WITH ", "WITH RECURSIVE ") + f", rows AS ({_UNEVEN}), {_GREEDY}")
def balanced_group_folds(spark, d):
    """Five folds of whole terms, the largest first into the lightest fold; a seventh of the terms is thinned out so that sizes differ."""
    rows = view(spark, d, "pairs").where("term_id % 7 <> 0 OR item_id % 3 = 0")
    return G.balanced_group_folds(rows, "term_id", 5).groupBy("term_id", "fold").agg(F.count("*").alias("n")).select("term_id", "n", "fold")


@query(
    cte("pairs")
    + f""", rows AS ({_UNEVEN}), s AS (SELECT term_id, count(*) AS n FROM rows GROUP BY 1), h AS (SELECT n, count(*) * n AS held FROM s GROUP BY n), u AS (SELECT n, sum(held) OVER (ORDER BY n) AS upto, sum(held) OVER () AS total FROM h)
SELECT term_id, n, n <= (SELECT coalesce(max(n), 0) FROM u WHERE upto <= 0.2 * total) AS tail FROM s"""
)
def tail_terms(spark, d):
    """Terms with their number of pairs, and whether they are in the tail that holds a fifth of the pairs."""
    rows = view(spark, d, "pairs").where("term_id % 7 <> 0 OR item_id % 3 = 0")
    return G.tail_groups(rows, "term_id").groupBy("term_id", "tail").agg(F.count("*").alias("n")).select("term_id", "n", "tail")


@query("SELECT o_custkey, count(DISTINCT o_orderkey % 3) AS folds, count(*) AS n FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderkey % 3) > 1")
def fold_leak_check(spark, d):
    return G.leaking_groups(source(spark, d, "orders").withColumn("fold", F.col("o_orderkey") % 3), "o_custkey")


_MODELS = _SCORED + ", m AS (SELECT id, label, proba AS a, coalesce(CASE WHEN id % 7 <> 0 THEN proba_b END, 0) AS b, proba_c AS c FROM scored)"


def _wide(spark, d):
    s = view(spark, d, "scored")
    models = {"a": s.select("id", "proba"), "b": s.where("id % 7 <> 0").select("id", F.col("proba_b").alias("proba")), "c": s.select("id", F.col("proba_c").alias("proba"))}
    return B.wide_scores(models).join(s.select("id", "label"), "id")


@query(_MODELS + " SELECT id, round(0.5 * a + 0.3 * b + 0.2 * c, 6) AS blend, CAST(round(0.5 * a + 0.3 * b + 0.2 * c, 6) >= 0.5 AS int) AS prediction FROM m")
def weighted_blend(spark, d):
    return _wide(spark, d).select("id", F.round(B.weighted({"a": 5, "b": 3, "c": 2}), 6).alias("blend")).withColumn("prediction", (F.col("blend") >= 0.5).cast("int"))


@query(_MODELS + ", n AS (SELECT greatest(count(*) - 1, 1) AS n FROM m) SELECT id, round(CAST(row_number() OVER (ORDER BY a, md5(CAST(id AS varchar)), id) - 1 AS double) / n, 6) AS a_rank, round(CAST(row_number() OVER (ORDER BY b, md5(CAST(id AS varchar)), id) - 1 AS double) / n, 6) AS b_rank FROM m, n")
def rank_blend(spark, d):
    return B.rank_scores(_wide(spark, d), ["a", "b"]).select("id", "a_rank", "b_rank")


@query(_SCORED + " SELECT id, round((rank() OVER (PARTITION BY lang ORDER BY q) + (count(*) OVER (PARTITION BY lang, q) - 1) / 2.0) / count(*) OVER (PARTITION BY lang), 6) AS average_rank FROM (SELECT id, lang, round(proba, 1) AS q FROM scored)")
def avg_rank_blend(spark, d):
    return B.average_ranks(view(spark, d, "scored").select("id", "lang", F.round("proba", 1).alias("q")), "q", ["lang"]).select("id", "average_rank")


@query(_MODELS + " SELECT 'a' AS a, 'b' AS b, round(corr(a, b), 6) AS corr FROM m UNION ALL SELECT 'a', 'c', round(corr(a, c), 6) FROM m UNION ALL SELECT 'b', 'c', round(corr(b, c), 6) FROM m")
def model_correlation(spark, d):
    return B.model_correlations(_wide(spark, d), ["a", "b", "c"])


@query(
    _SCORED
    + """, r AS (SELECT lang, proba, proba_b, rank() OVER (PARTITION BY lang ORDER BY proba) + (count(*) OVER (PARTITION BY lang, proba) - 1) / 2.0 AS x, rank() OVER (PARTITION BY lang ORDER BY proba_b) + (count(*) OVER (PARTITION BY lang, proba_b) - 1) / 2.0 AS y FROM scored)
SELECT lang, count(*) AS n, CASE WHEN count(*) >= 3 THEN round(corr(proba, proba_b), 6) END AS pearson, CASE WHEN count(*) >= 3 THEN round(corr(x, y), 6) END AS spearman FROM r GROUP BY 1"""
)
def spearman_corr(spark, d):
    return M.spearman(view(spark, d, "scored"), "proba", "proba_b", ["lang"])


@query(_MODELS + " SELECT id, label, round(abs(a - b), 6) AS gap FROM m WHERE (a >= 0.5) <> (b >= 0.5)")
def model_disagreement(spark, d):
    return B.disagreements(_wide(spark, d), "a", "b").select("id", "label", "gap")


@query()
def blend_search(spark, d):
    """Best threshold of every blend of up to three models."""
    return B.blend_search(_wide(spark, d), {"a": 0.5, "b": 0.3, "c": 0.2})


@query(_MODELS + f""", w AS (SELECT i, j, 4 - i - j AS k FROM (SELECT unnest(range(0, 5)) AS i), (SELECT unnest(range(0, 5)) AS j) WHERE i + j <= 4), p AS (SELECT concat_ws('|', i, j, k) AS weights, label, round(a * i / 4 + b * j / 4 + c * k / 4, 6) AS proba FROM m, w), n AS ({_confusion("weights,")} FROM p GROUP BY 1) SELECT weights, {_MACRO} AS macro_f1 FROM n""")
def weight_search(spark, d):
    return B.weight_search(_wide(spark, d), ["a", "b", "c"])


@query(_SCORED + """, x AS (SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7]) AS threshold), c AS (SELECT id % 3 AS y, [proba, proba_b, proba_c] AS p FROM scored), k AS (SELECT unnest([0, 1, 2]) AS class),
n AS (SELECT class, threshold, count_if(p[class + 1] >= threshold AND y = class) AS tp, count_if(p[class + 1] >= threshold) AS hits, count_if(y = class) AS t FROM c, x, k GROUP BY ALL), f AS (SELECT class, threshold, round(CASE WHEN hits + t = 0 THEN 0 ELSE CAST(2 * tp AS double) / (hits + t) END, 6) AS f1 FROM n)
SELECT CAST(class AS int) AS class, CAST(threshold AS double) AS threshold, f1 FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY f1 DESC, threshold) AS r FROM f) WHERE r = 1""")
def class_thresholds(spark, d):
    rows = view(spark, d, "scored").withColumn("y", F.col("id") % 3)
    return M.class_thresholds(rows, ["proba", "proba_b", "proba_c"], "y")


@query(_SCORED + " SELECT lang, count(*) AS n, CASE WHEN count(*) < 100 THEN 'high' WHEN count(*) < 500 THEN 'medium' ELSE 'lower' END AS noise FROM scored GROUP BY 1")
def segment_noise(spark, d):
    return view(spark, d, "scored").groupBy("lang").agg(F.count("*").alias("n")).withColumn("noise", M.size_band(F.col("n")))


@query()
def stacked_oof(spark, d):
    """A logistic model over three models' scores, out of fold: rows and macro F1 at one half."""
    from quillon.operators.models import stacked

    wide = _wide(spark, d).withColumn("fold", F.col("id") % 3)
    return M.confusion(stacked(wide, ["a", "b", "c"], 3), proba="stacked").select("tp", "fp", "fn", "tn", "macro_f1")


@query(_SCORED + " SELECT id, round((0.7 * proba + 0.3 * proba_b) / (0.7 * proba + 0.3 * proba_b + 0.7 * (1 - proba) + 0.3 * (1 - proba_b)), 6) AS p1 FROM scored")
def fused_probabilities(spark, d):
    pair = lambda c: F.array(1 - F.col(c), F.col(c))
    return view(spark, d, "scored").select("id", F.round(F.get(B.fused(pair("proba"), pair("proba_b")), 1), 6).alias("p1"))


@query()
def gbt_oof(spark, d):
    """Out-of-fold boosted trees: every row is scored once, in its own fold."""
    from quillon.operators.models import out_of_fold, tabular_pipeline

    rows = G.stratified_folds(view(spark, d, "scored").drop("fold"), "label", "id", 2)
    oof = out_of_fold(rows, tabular_pipeline(["proba", "proba_b", "n_chars"], iterations=4), 2, model="gbt")
    return oof.groupBy("fold", "model_name").agg(F.count("*").alias("n"), F.count_if(F.col("proba").between(0, 1)).alias("in_range"))


@query()
def logreg_oof(spark, d):
    """Out-of-fold logistic regression over the exact words and word pairs of labelled documents, weighted by the training folds."""
    from quillon.operators.models import out_of_fold
    from quillon.operators.term_weights import pair_text_pipeline

    rows = view(spark, d, "scored").drop("fold").join(view(spark, d, "docs").select(F.col("doc_id").alias("id"), F.col("text").alias("item")), "id").withColumn("query", F.col("lang"))
    rows = G.stratified_folds(rows.withColumn("pair", F.concat_ws(" [SEP] ", "query", "item")), "label", "id", 2)
    oof = out_of_fold(rows.select("id", "label", "fold", "query", "item", "pair"), pair_text_pipeline(), 2, model="logreg")
    return oof.groupBy("fold", "model_name").agg(F.count("*").alias("n"), F.count_if(F.col("proba").between(0, 1)).alias("in_range"))


@query()
def feature_importance(spark, d):
    """Mean importance of three features over the folds' boosted trees."""
    from quillon.operators.models import mean_importance, tabular_pipeline

    columns = ["proba", "proba_b", "n_chars"]
    rows = G.stratified_folds(view(spark, d, "scored").drop("fold"), "label", "id", 2)
    return mean_importance(rows, {"all": (tabular_pipeline(columns, iterations=4), columns), "two": (tabular_pipeline(columns[:2], iterations=4), columns[:2])}, 2).select("feature", F.round("importance", 6).alias("importance"))
