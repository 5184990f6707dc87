"""Experiment logs: normalisation, the link to submissions and manual scores, risk, reliability and ablations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import first_filled, latest_per_key
from .ordering import with_previous

#: Substrings of an experiment's descriptive texts and the model family they stand for; the first that occurs counts.
FAMILIES = (
    (("ensemble", "blend", "+"), "ensemble"),
    (("transformer", "ce_best"), "transformer_ce"),
    (("sklearn_text", "cross_encoder", "pair-text"), "sklearn_text"),
    (("dense",), "dense_enhanced"),
    (("retrieval",), "retrieval_heavy"),
    (("tab",), "tabular"),
)
#: Texts that are searched for a family.
FAMILY_TEXTS = ("model_type", "experiment_name", "models", "category", "changed_component", "note", "submission_note")


def first_of(choices: list[tuple[Column, str]], otherwise: str) -> Column:
    """The name of the first condition that holds."""
    chain = reduce(lambda c, item: c.when(item[0], F.lit(item[1])), choices[1:], F.when(choices[0][0], F.lit(choices[0][1])))
    return chain.otherwise(otherwise)


def either(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions)


def model_family(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return first_of([(either([low.contains(p) for p in parts]), family) for parts, family in FAMILIES], "unknown")


def _truth(c: Column) -> Column:
    """Logs hold truth values as text."""
    return F.lower(F.coalesce(c.cast("string"), F.lit(""))).isin("true", "1", "yes", "y")


#: For each kind of log its columns by the name they get (no name where it has none), and the names that are numbers.
LOGS = {
    "experiment": {"experiment_id": "experiment_id", "experiment_name": "experiment_name", "splitter": "validation_version", "threshold": "best_threshold", "oof": "oof_macro_f1", "class0": "class0_f1", "class1": "class1_f1", "threshold_fragility": "threshold_fragile", "seed_std": "", "public_lb_score": "public_lb_score", "notes": "submission_note"},
    "ablation": {"experiment_id": "ablation_id", "experiment_name": "experiment_name", "splitter": "splitter", "threshold": "best_threshold", "oof": "OOF macro-F1", "class0": "class0 F1", "class1": "class1 F1", "threshold_fragility": "threshold_fragility", "seed_std": "seed_std", "public_lb_score": "public_lb_score", "notes": "note", "changed_component": "changed_component", "status": "status"},
    "submission": {"experiment_id": "experiment_id", "file_path": "file_path", "submission_timestamp": "timestamp", "public_lb_score": "public_lb_score", "chosen_family_label": "chosen_family_label", "submission_notes": "note", "validation_score": "validation_score", "threshold": "threshold"},
}
NUMBERS = ("threshold", "oof", "class0", "class1", "seed_std", "public_lb_score", "validation_score")


def normalized_log(log: DataFrame, kind: str) -> DataFrame:
    """A log under common column names: numbers where they can be read as such, other values as text, absent columns null."""
    held = {c: F.col(f"`{c}`") for c in log.columns}
    value = lambda source: held.get(source, F.lit(None)).cast("string")
    columns = [(F.expr("double(null)") if source not in held else held[source].cast("string").try_cast("double")).alias(name) if name in NUMBERS else value(source).alias(name) for name, source in LOGS[kind].items()]
    if kind != "submission":
        texts = F.concat_ws(" ", *(value(c) for c in FAMILY_TEXTS if c in held))
        columns.append(model_family(texts).alias("model_family"))
    return log.select(*columns)


def linked(experiments: DataFrame, submissions: DataFrame, manual: DataFrame) -> DataFrame:
    """Each experiment with its latest submission and its latest manual entry.

    Manual values come before the submission's, and these before the log's own;
    empty texts count as absent.  The three notes are joined.
    """
    renamed = lambda df, mark: df.select("experiment_id", *(F.col(c).alias(f"{c}_{mark}") for c in df.columns if c != "experiment_id"))
    newest = F.desc("submission_timestamp"), F.desc("file_path")
    sub = renamed(latest_per_key(submissions, "experiment_id", *newest), "s")
    man = renamed(latest_per_key(manual, "experiment_id", *newest), "m")
    both = experiments.join(sub, "experiment_id", "left").join(man, "experiment_id", "left")
    has = set(both.columns)
    pick = lambda *names: first_filled(*(F.col(n) for n in names if n in has))
    kept = [F.col(c) for c in experiments.columns if c not in ("public_lb_score", "notes")]
    out = both.select(
        *kept,
        pick("public_lb_score_m", "public_lb_score_s", "public_lb_score").try_cast("double").alias("public_lb_score"),
        pick("file_path_m", "file_path_s").alias("file_path"),
        pick("submission_timestamp_m", "submission_timestamp_s").alias("submission_timestamp"),
        pick("chosen_family_label_m", "chosen_family_label_s", "model_family").alias("chosen_family_label"),
        F.concat_ws(" | ", *(F.nullif(F.col(c), F.lit("")) for c in ("notes", "submission_notes_s", "notes_m") if c in has)).alias("notes"),
    )
    return out.withColumn("public_minus_oof", F.col("public_lb_score") - F.col("oof"))


#: Flags that make a candidate's public score suspect, and those that add up.
OPTIMISTIC = ("PRIVATE_UNSAFE_CANDIDATE", "PUBLIC_UP_OOF_DOWN", "PUBLIC_UP_CLASS0_DOWN")
EXPERIMENTAL = ("DENSE_ARTIFACT_RISK", "RETRIEVAL_FEATURE_DRIFT", "ENSEMBLE_OVERFIT_RISK", "THRESHOLD_FRAGILE", "SPLITTER_INCONSISTENT")


def named(rules: dict[str, Column]) -> Column:
    """Names of the rules that hold, in the order of the rules; a rule over nulls does not hold."""
    return F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in rules.items())))


def risk_flags(log: DataFrame, order: str) -> DataFrame:
    """Flags of each experiment, some of them against the row before it in the order of ``order``, and its status.

    ``log`` has ``oof``, ``class0``, ``public_lb_score``, ``seed_std``,
    ``threshold_fragility``, ``model_family`` and, if they exist, the texts
    ``changed_component``, ``experiment_name`` and ``notes``.
    """
    moved = with_previous(log, order, ["oof", "class0", "public_lb_score"])
    gap, public = F.col("public_lb_score") - F.col("oof"), F.col("public_lb_score") - F.col("prev_public_lb_score")
    family = F.lower(F.col("model_family"))
    texts = F.lower(F.concat_ws(" ", family, *(F.col(c) for c in ("changed_component", "experiment_name", "notes") if c in log.columns)))
    rules = {
        "PUBLIC_UP_OOF_DOWN": (public > 0) & (F.col("oof") < F.col("prev_oof")),
        "PUBLIC_UP_CLASS0_DOWN": (public > 0) & (F.col("class0") < F.col("prev_class0")),
        "THRESHOLD_FRAGILE": _truth(F.col("threshold_fragility")),
        "SPLITTER_INCONSISTENT": F.col("seed_std") > 0.015,
        "ENSEMBLE_OVERFIT_RISK": family.contains("ensemble") & (gap > 0.02),
        "DENSE_ARTIFACT_RISK": texts.contains("dense"),
        "RETRIEVAL_FEATURE_DRIFT": texts.contains("retrieval"),
        "PRIVATE_UNSAFE_CANDIDATE": gap > 0.03,
    }
    shared = lambda names: F.size(F.array_intersect("flags", F.array(*map(F.lit, names))))
    oof = F.col("oof").isNotNull()
    status = first_of(
        [
            (shared(OPTIMISTIC) > 0, "public_optimistic"),
            (shared(EXPERIMENTAL) > 1, "high_risk_experimental"),
            (oof & F.col("class0").isNotNull() & (F.size("flags") == 0), "private_safe"),
            (oof & (F.size("flags") <= 1), "balanced_candidate"),
            (~oof & F.col("public_lb_score").isNotNull(), "do_not_use_for_final"),
        ],
        "high_risk_experimental",
    )
    return moved.withColumn("public_minus_oof", gap).withColumn("flags", named(rules)).withColumn("strategic_status", status)


def _flagged(pattern: str) -> Column:
    return F.count_if(F.array_join("flags", "|").rlike(pattern))


def _gap(measure: Column) -> Column:
    return F.round(measure, 6)


def family_drift(flagged: DataFrame) -> DataFrame:
    """Per model family its experiments, mean scores, the gap of public to out-of-fold scores, and counts of risk."""
    gap = F.col("public_minus_oof")
    return flagged.groupBy(F.coalesce("model_family", F.lit("unknown")).alias("model_family")).agg(
        F.count("*").alias("n_experiments"), F.count(gap).alias("n_public"), _gap(F.avg("oof")).alias("oof_mean"), _gap(F.avg("class0")).alias("class0_mean"), _gap(F.avg(gap)).alias("gap_mean"), _gap(F.stddev_pop(gap)).alias("gap_std"),
        _flagged("PUBLIC_UP|PRIVATE_UNSAFE").alias("public_optimistic_count"), _flagged("DENSE_ARTIFACT|RETRIEVAL_FEATURE").alias("dense_or_retrieval_risk_count"),
    )


def splitter_reliability(flagged: DataFrame) -> DataFrame:
    """Per splitter its public scores, their gap, the count of risky rows, and the score by which one is recommended."""
    gap = F.col("public_minus_oof")
    table = flagged.groupBy(F.coalesce("splitter", F.lit("unknown")).alias("splitter")).agg(
        F.count("*").alias("n_experiments"), F.count(gap).alias("n_public"), _gap(F.avg(gap)).alias("gap_mean"), _gap(F.stddev_pop(gap)).alias("gap_std"), _gap(F.coalesce(-F.avg(gap), F.lit(0.0))).alias("conservative_score"), _flagged("PRIVATE_UNSAFE|PUBLIC_UP").alias("high_risk_count")
    )
    return table.withColumn("score", F.round(0.1 * F.col("n_public") - F.col("high_risk_count") - F.coalesce("gap_std", F.lit(0.0)), 6))


def recommended_splitter(reliability: DataFrame) -> str:
    """The splitter of the highest score; ``term_group`` where there is none."""
    best = reliability.orderBy(F.desc("score"), "splitter").first()
    return best.splitter if best else "term_group"


def threshold_reliability(flagged: DataFrame) -> DataFrame:
    """Whether an experiment's threshold is extreme, and whether it is fragile and scored in public."""
    extreme = F.coalesce((F.col("threshold") < 0.2) | (F.col("threshold") > 0.8), F.lit(False))
    risky = F.lower(F.coalesce(F.col("threshold_fragility").cast("string"), F.lit(""))).isin("true", "1") & F.col("public_lb_score").isNotNull()
    return flagged.withColumns({"threshold_extreme_flag": extreme, "threshold_public_risk_flag": risky})


#: Segments that are always reported.
WATCHED = ("is_short_query", "is_long_query", "is_brand_heavy", "is_attribute_heavy", "is_category_heavy", "has_gender_token", "has_age_token", "negative_type", "source_pool", "gender", "age_group")


def segment_risk(scores: DataFrame, least: float = 0.45) -> DataFrame:
    """Segments that are watched or whose macro or class-0 score falls below ``least``."""
    collapsed = (F.coalesce("macro_f1", F.lit(0.0)) < least) | (F.coalesce("class0_f1", F.lit(0.0)) < least)
    return scores.withColumn("segment_collapse_flag", collapsed).where(F.col("segment").isin(*WATCHED) | collapsed)


def selection_score() -> Column:
    """Out-of-fold score, 0.15 of class 0, 0.02 of the public score, less 0.10 for a suspect public score; -1 without an out-of-fold score."""
    doubtful = F.array_join("flags", "|").rlike("PUBLIC_UP_OOF_DOWN|PUBLIC_UP_CLASS0_DOWN|PRIVATE_UNSAFE")
    zero = F.lit(0.0)
    return F.coalesce("oof", F.lit(-1.0)) + 0.15 * F.coalesce("class0", zero) + 0.02 * F.coalesce("public_lb_score", zero) - F.when(doubtful, 0.10).otherwise(0.0)


def candidate_pool(flagged: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` best experiments that have an out-of-fold score; none gives an empty pool."""
    return flagged.where("oof IS NOT NULL").withColumn("selection_score", F.round(selection_score(), 6)).orderBy(F.desc("selection_score"), "experiment_id").limit(n)


#: The three families of final submissions and how far their thresholds move.
OFFSETS = {"family_A_balanced": 0.0, "family_B_defensive": 0.04, "family_C_aggressive": -0.03}


def final_families(pool: DataFrame, n: int = 3) -> DataFrame:
    """Members of the families with their weights, and each family's threshold and best scores.

    A takes the best candidates without a suspect public score, B the best on
    class 0, C the best of the semantic models, or of all where there is none.
    Weights follow the selection score, negative ones counting as 0; if all are
    0 they are equal.  The threshold is the members' median, moved by the
    family's offset within 0.05 and 0.95.
    """
    key = F.asc("experiment_id")
    best = [F.desc("selection_score"), key]
    semantic = F.lower("model_family").rlike("dense|ce|text|ensemble|semantic")
    top = lambda df, name, order: df.orderBy(*order).limit(n).withColumn("family_name", F.lit(name))
    a = top(pool.where(~F.array_join("flags", "|").rlike("PUBLIC_UP|PRIVATE_UNSAFE")), "family_A_balanced", best)
    b = top(pool, "family_B_defensive", [F.desc("class0"), *best])
    own = top(pool.where(semantic), "family_C_aggressive", best).withColumn("_sem", F.lit(1))
    rest = top(pool, "family_C_aggressive", best).withColumn("_sem", F.lit(0))
    either_ = own.unionByName(rest)
    # at most 2 * n rows
    c = either_.withColumn("_most", F.max("_sem").over(Window.partitionBy("family_name"))).where("_sem = _most").drop("_sem", "_most")
    members = a.unionByName(b).unionByName(c)
    whole = Window.partitionBy("family_name")
    raw = F.greatest(F.lit(0.0), F.coalesce("selection_score", F.lit(0.1)))
    offset = F.element_at(F.create_map(*(F.lit(v) for item in OFFSETS.items() for v in item)), F.col("family_name"))
    moved = F.median("threshold").over(whole) + offset
    bounded = F.when(offset > 0, F.least(F.lit(0.95), moved)).when(offset < 0, F.greatest(F.lit(0.05), moved)).otherwise(moved)
    weight = F.coalesce(F.try_divide(raw, F.sum(raw).over(whole)), 1 / F.count("*").over(whole))
    return members.select(
        "family_name", "experiment_id", F.round(weight, 6).alias("weight"), F.round(F.coalesce(bounded, F.lit(0.5)), 6).alias("threshold"),
        F.max("oof").over(whole).alias("best_oof"), F.max("class0").over(whole).alias("best_class0"),
    )


def family_predictions(families: DataFrame, predictions: DataFrame, reference: DataFrame) -> DataFrame:
    """(family_name, id, proba, prediction) of every reference id; a family with a member that misses an id has null predictions.

    ``predictions`` holds (experiment_id, id, proba).  ``families`` has at most
    three members a family, so it is small whatever the predictions are.
    """
    blended = predictions.join(F.broadcast(families), "experiment_id").groupBy("family_name", "id").agg(F.sum(F.col("weight") * F.col("proba")).alias("proba"), F.count("proba").alias("n"), F.first("threshold").alias("threshold"))
    size = families.groupBy("family_name").agg(F.count("*").alias("members"))
    # at most three families
    wanted = reference.select("id").withColumn("family_name", F.explode(F.array(*map(F.lit, OFFSETS)))).join(F.broadcast(size), "family_name")
    rows = wanted.join(blended, ["family_name", "id"], "left").withColumn("whole", F.coalesce(F.col("n") == F.col("members"), F.lit(False)))
    complete = rows.groupBy("family_name").agg(F.bool_and("whole").alias("complete"))
    proba = F.when(F.col("complete"), F.round("proba", 6))
    return rows.join(F.broadcast(complete), "family_name").select("family_name", "id", proba.alias("proba"), F.when(F.col("complete"), (F.col("proba") >= F.col("threshold")).cast("int")).alias("prediction"))


def ablation_decisions(log: DataFrame, baseline: str) -> DataFrame:
    """A risk label and a keep, risky or drop decision for each ablation against the row ``baseline``.

    ``log`` has ``ablation_id``, ``category``, ``changed_component``, ``note``,
    ``status``, ``oof``, ``class0``, ``threshold_fragility`` and ``seed_std``.
    """
    base = log.where(F.col("ablation_id") == baseline).agg(F.first("oof").alias("base_oof"), F.first("class0").alias("base_class0"), F.first("status").alias("base_status"))
    text = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    zero = F.lit(0.0)
    oof, class0 = F.coalesce("oof", zero), F.coalesce("class0", zero)
    gain, gain0 = F.coalesce(oof - F.col("base_oof"), zero), F.coalesce(class0 - F.col("base_class0"), zero)
    late = F.col("category").isin("retrieval", "dense", "negative")
    risk = first_of(
        [
            (~F.coalesce("status", F.lit("completed")).isin("completed", "ok"), "needs_fold_safe_recheck"),
            (text("note").contains("public") & (gain < 0), "high_risk_public_only"),
            (late & text("changed_component").rlike("dense|retrieval") & ~text("note").contains("fold") & (gain > 0.002), "needs_fold_safe_recheck"),
            (F.lower(F.coalesce(F.col("threshold_fragility").cast("string"), F.lit(""))).isin("true", "1", "yes") | (F.coalesce("seed_std", zero) > 0.015), "medium_risk_monitor"),
            ((gain > 0.003) & (gain0 >= -0.002), "low_risk_keep"),
            (((gain < -0.003) | (gain0 < -0.006)) & late, "artifact_suspected"),
        ],
        "medium_risk_monitor",
    )
    # the decision compares with the baseline only where that was completed
    change = F.when(F.col("base_status") == "completed", gain).otherwise(0.0)
    decision = first_of(
        [
            (F.coalesce("status", F.lit("completed")) != "completed", "Good but risky"),
            ((F.col("risk") == "low_risk_keep") & (change >= 0), "Keep no matter what"),
            (F.col("risk").isin("needs_fold_safe_recheck", "medium_risk_monitor", "high_risk_public_only") & (change >= 0), "Good but risky"),
            (F.abs(change) < 0.002, "Segment benefit only"),
        ],
        "Drop from final pipeline",
    )
    # the baseline is one row
    return log.crossJoin(F.broadcast(base)).withColumn("risk", risk).withColumn("decision", decision).drop("base_oof", "base_class0", "base_status")
