"""Diagnostics and decisions: error tags, pseudo-labels, submissions, explanations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.text import normalize_text, token_set

from .metrics import describe
from .registry import either, first_of, named

#: Pools whose candidates were retrieved.
RETRIEVED = ("lexical_nearest_pool", "dense_nearest_pool", "category_filtered_pool", "brand_aware_pool")
#: Error tags that follow from one flag alone.
FLAG_TAGS = {
    "attribute_mismatch": ("attr_conflict_count", "attr_color_conflict_flag", "attr_material_conflict_flag"),
    "gender_conflict": ("gender_conflict_flag",),
    "age_group_conflict": ("age_conflict_flag",),
    "typo_spelling_issue": ("possible_typo_or_ambiguous",),
}


def error_tags(rows: DataFrame, threshold: float = 0.5, proba: str = "proba", label: str = "label") -> DataFrame:
    """Each row with ``pred``, ``is_error``, ``error_type``, ``confidence`` and its sorted ``tags``.

    ``_query_set`` and ``_title_set``, if the rows have them, are the distinct
    words of both sides, split before they met; else both are split here.
    A column that is absent or null counts as 0 or empty; a row without any tag
    is a vocabulary issue if query and title share no word, else an ambiguity.
    """
    held = set(rows.columns)
    on = lambda c: (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) != 0) if c in held else F.lit(False)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in held else F.lit("")
    p = F.coalesce(F.col(proba), F.lit(0.5))
    rows = rows.withColumns({"pred": (p >= threshold).cast("int"), "_q": F.col("_query_set") if "_query_set" in held else token_set(text("query")), "_t": F.col("_title_set") if "_title_set" in held else token_set(text("title"))})
    wrong, relevant = F.col("pred") != F.col(label), F.col(label) == 1
    words, apart = F.size("_q"), ~F.arrays_overlap("_q", "_t")
    overlap = F.coalesce(F.col("cat_token_overlap_count"), F.lit(0)) == 0 if "cat_token_overlap_count" in held else F.lit(True)
    rules = {tag: either([on(c) for c in flags]) for tag, flags in FLAG_TAGS.items()} | {
        "brand_mismatch": on("brand_contradiction_flag") | (on("has_brand_token") & ~on("brand_exact_match") & wrong),
        "category_mismatch": overlap & on("has_category_token") & wrong,
        "title_ambiguity": (F.size("_t") <= 2) | ((words > 0) & apart & wrong),
        "query_ambiguity": on("is_short_query") | (words <= 2),
        "missing_attribute_issue": ~text("attributes").rlike(r"\S") | on("attr_color_missing_when_query_has_color") | on("attr_material_missing_when_query_has_material"),
        "false_negative_sampling_issue": relevant & ~text("negative_type").isin("", "positive"),
        "retrieval_source_issue": text("source_pool").isin(*RETRIEVED) & wrong,
        "threshold_error": F.abs(p - threshold) <= 0.05,
        "calibration_error": (~relevant & (p >= 0.9)) | (relevant & (p <= 0.1)),
    }
    rest = F.when((words > 0) & (F.size("_t") > 0) & apart, F.lit("synonym_vocabulary_issue")).otherwise(F.lit("query_ambiguity"))
    tagged = rows.withColumn("tags", F.array_sort(named(rules)))
    return tagged.withColumns(
        {
            "is_error": wrong.cast("int"),
            "error_type": F.when(wrong, F.when(F.col("pred") == 1, "FP").otherwise("FN")),
            "confidence": F.round(F.abs(p - 0.5) * 2, 6),
            "tags": F.when(F.size("tags") > 0, F.col("tags")).otherwise(F.array(rest)),
        }
    ).drop("_q", "_t", "_query_set", "_title_set")


def tag_counts(errors: DataFrame) -> DataFrame:
    return errors.select("error_type", F.explode("tags").alias("tag")).groupBy("error_type", "tag").agg(F.count("*").alias("n"))


def examples_per_class(errors: DataFrame, by: str, order: list[Column], n: int = 3) -> DataFrame:
    return errors.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("place") <= n)


#: What to do, in this order, where one of the tags occurs.
ACTIONS = (
    (("attribute_mismatch", "missing_attribute_issue"), "widen attribute parsing and features"),
    (("brand_mismatch",), "raise the share of same-brand negatives"),
    (("gender_conflict", "age_group_conflict"), "strengthen gender and age rules"),
    (("category_mismatch",), "add category hierarchy features"),
    (("retrieval_source_issue",), "analyse the quality of retrieval pools"),
    (("threshold_error",), "analyse the trade-off around the threshold"),
    (("calibration_error",), "calibrate probabilities or blend weights"),
    (("false_negative_sampling_issue",), "tighten the safety of negatives"),
)
NO_ACTION = "review segments and disagreement of models"


def suggested_actions(counts: DataFrame) -> DataFrame:
    """One row: the actions for the tags of ``counts`` (tag, n), in order; the general one if there is none."""
    # tags are a closed list, so this set is small
    seen = counts.agg(F.collect_set("tag").alias("seen"))
    chosen = named({action: F.arrays_overlap("seen", F.array(*map(F.lit, found))) for found, action in ACTIONS})
    return seen.select(F.when(F.size(chosen) > 0, chosen).otherwise(F.array(F.lit(NO_ACTION))).alias("actions"))


#: Words of accessories.
ACCESSORIES = ("canta", "cuzdan", "kemer", "sapka", "atki", "eldiven", "kolye", "bileklik", "saat", "gozluk", "aksesuar")


def error_class(query: Column, product: Column, brand: Column, category: Column, label: Column, pred: Column, confidence: Column) -> Column:
    """One of eight classes of a wrong prediction, the first whose rule holds."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    words = lambda c: F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != "")
    q, b, kinds = low(query), low(brand), F.array_distinct(words(F.translate(low(category), ">", " ")))
    own, names = F.array_distinct(words(q)), F.array_distinct(words(low(product)))
    over, under = (label == 0) & (pred >= 1), (label >= 1) & (pred == 0)
    return first_of(
        [
            (~b.isin("", "unknown") & q.contains(b) & over, "BRAND_MISMATCH"),
            (~F.arrays_overlap(kinds, own) & (F.size(own) >= 3) & under, "CATEGORY_MISMATCH"),
            (either([q.contains(w) for w in ACCESSORIES]) & under, "ACCESSORY_CONFUSION"),
            ((F.size(F.array_intersect(own, names)) >= 2) & (over | under), "SEMANTIC_ERROR"),
            (F.size(words(q)) <= 1, "DATA_NOISE"),
            (confidence > 0.9, "CONFIDENCE_ERROR"),
            ((confidence > 0.4) & (confidence < 0.6), "BOUNDARY_ERROR"),
        ],
        "OTHER",
    )


def sign_agreement(log: DataFrame, order: str, a: str, b: str, by: str) -> DataFrame:
    """Share of steps on which two scores move in the same direction."""
    before = Window.partitionBy(by).orderBy(order)
    steps = log.withColumns({"_a": F.signum(F.col(a) - F.lag(a).over(before)), "_b": F.signum(F.col(b) - F.lag(b).over(before))}).where("_a IS NOT NULL AND _b IS NOT NULL")
    return steps.groupBy(by).agg(F.count("*").alias("steps"), F.round(F.avg((F.col("_a") == F.col("_b")).cast("int")), 6).alias("agreement"))


def agreement(probabilities: list[Column]) -> Column:
    """Share of the models on the side of the majority; 1 where no model has a probability."""
    given = F.array_compact(F.array(*probabilities)) if probabilities else F.array()
    high = F.size(F.filter(given, lambda p: p >= 0.5))
    return F.coalesce(F.try_divide(F.greatest(high, F.size(given) - high).cast("double"), F.size(given).cast("double")), F.lit(1.0))


#: Signals that back a positive, and signals that speak against one, with what each must exceed.
SUPPORT = {"lex_token_overlap_ratio": 0.1, "retrieval_bm25_score": 0.0, "sem_query_title_cosine": 0.1}
CONFLICT = ("attr_conflict_count", "gender_conflict_flag", "age_conflict_flag")


def pseudo_labels(
    rows: DataFrame, mode: str, models: list[str], high: float = 0.95, low: float = 0.05, least_agreement: float = 0.66, least_margin: float = 0.35, support: bool = True, conflict: bool = True, proba: str = "proba"
) -> DataFrame:
    """Adds ``pseudo_label`` (null if none), ``pseudo_reason``, ``agreement_score`` and ``margin``.

    Modes are ``positive_only``, ``negative_only``, ``dual`` and ``disabled``.
    With ``support`` a positive needs a signal that backs it, with ``conflict``
    a negative one that speaks against it; an absent signal does neither.
    """
    if mode not in ("positive_only", "negative_only", "dual", "disabled"):
        raise ValueError(f"unknown mode {mode!r}")
    held = set(rows.columns)
    above = lambda c, t: F.coalesce(F.col(c) > t, F.lit(False)) if c in held else F.lit(False)
    backed = either([above(c, t) for c, t in SUPPORT.items()]) if support else F.lit(True)
    against = either([*(above(c, 0) for c in CONFLICT), F.coalesce(F.col("lex_token_overlap_ratio") < 0.05, F.lit(False)) if "lex_token_overlap_ratio" in held else F.lit(False)]) if conflict else F.lit(True)
    p, agree = F.coalesce(F.col(proba), F.lit(0.5)), agreement([F.col(c) for c in models if c in held])
    positive, negative = (F.lit(mode in (m, "dual")) & c for m, c in (("positive_only", p >= high), ("negative_only", p <= low)))
    reason = first_of(
        [
            (F.lit(mode == "disabled"), "disabled"),
            ((agree < least_agreement) | (F.abs(p - 0.5) < least_margin), "low_agreement_or_margin"),
            (positive & ~backed, "positive_without_support_signals"),
            (positive, "high_confidence_positive"),
            (negative & ~against, "negative_without_conflict_signal"),
            (negative, "high_confidence_negative"),
        ],
        "threshold_not_met",
    )
    label = F.when(F.col("pseudo_reason") == "high_confidence_positive", 1).when(F.col("pseudo_reason") == "high_confidence_negative", 0)
    return rows.withColumns({"pseudo_reason": reason, "agreement_score": F.round(agree, 6), "margin": F.round(F.abs(p - 0.5), 6)}).withColumn("pseudo_label", label)


def pseudo_label_report(decided: DataFrame, warn_at: int = 50_000) -> DataFrame:
    """One row: accepted and rejected rows, both classes, and what to watch."""
    taken = F.col("pseudo_label").isNotNull()
    counts = decided.agg(F.count_if(taken).alias("pseudo_count"), F.count_if(~taken).alias("rejected_count"), F.count_if(F.col("pseudo_label") == 1).alias("positive_count"), F.count_if(F.col("pseudo_label") == 0).alias("negative_count"))
    notes = named({"positive_skew": F.col("positive_count") > 0.9 * F.col("pseudo_count"), "large_volume": F.col("pseudo_count") > warn_at})
    return counts.withColumn("risk_notes", F.array_join(notes, "|"))


def pseudo_label_scores(decided: DataFrame, proba: str = "proba") -> DataFrame:
    """Scores described per reason."""
    return describe(decided, proba, ["pseudo_reason"])


def iterated_pseudo_labels(train: DataFrame, test: DataFrame, fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]], rounds: int = 3, high: float = 0.95, low: float = 0.05, decay: float = 0.05, id_col: str = "id", label_col: str = "label") -> DataFrame:
    """Training rows and the pseudo-labelled rows of the last round.

    Each round fits on what the round before made, scores ``test`` (``fit``
    returns what adds a column ``proba``) and labels the rows beyond thresholds
    that widen by ``decay`` a round.  An id in training is never labelled, and a
    round without new rows ends the loop.
    """
    marks = {"pseudo_confidence": F.lit(None).cast("double"), "pseudo_iter": F.lit(None).cast("int")}
    own = now = train.withColumns(marks)
    for n in range(rounds):
        score = fit(now.drop(*marks))
        p = F.col("proba")
        sure = score(test).where((p > high - decay * n) | (p < low + decay * n))
        fresh = sure.join(train.select(id_col).distinct(), id_col, "left_anti").withColumns({label_col: (p > 0.5).cast(train.schema[label_col].dataType), "pseudo_confidence": F.greatest(p, 1 - p), "pseudo_iter": F.lit(n)})
        if fresh.isEmpty():
            break
        now = own.unionByName(fresh.select(*own.columns))
    return now


def submission_report(submission: DataFrame, reference: DataFrame, previous: DataFrame | None = None, low: float = 0.001, high: float = 0.999, drift: float = 0.25) -> DataFrame:
    """One row: counts of what is wrong with a submission, its errors and warnings, and whether it is valid.

    Both sides have ``id``, the submission ``prediction``; order is compared by
    ``ord`` where both have it.  A rate of positives out of bounds, or more than
    ``drift`` of the predictions changed since ``previous``, is a warning only.
    """
    n = F.count("*")
    number = F.col("prediction").cast("string").try_cast("double")
    own = submission.agg(
        n.alias("n_rows"), (n - F.count_distinct("id")).alias("repeated_ids"), F.count_if(F.col("prediction").isNull()).alias("null_predictions"),
        F.count_if(F.col("prediction").isNotNull() & ~F.coalesce(number.isin(0.0, 1.0), F.lit(False))).alias("non_binary"), F.round(F.coalesce(F.avg(number), F.lit(0.0)), 6).alias("positive_rate"),
    )
    theirs = reference.agg(n.alias("n_reference"), (n - F.count_distinct("id")).alias("repeated_reference_ids"))
    ordered = "ord" in submission.columns and "ord" in reference.columns
    side = lambda df, name: df.groupBy("id").agg(F.lit(1).alias(name), *([F.min("ord").alias(f"{name}_ord")] if ordered else []))
    both = side(reference, "r").join(side(submission, "s"), "id", "full")
    ids = both.agg(F.count_if(F.col("s").isNull()).alias("missing_ids"), F.count_if(F.col("r").isNull()).alias("extra_ids"), (F.count_if(F.col("r_ord") != F.col("s_ord")) if ordered else F.lit(0).cast("bigint")).alias("out_of_order"))
    out = own.join(theirs).join(ids)
    if previous is not None:
        before = previous.groupBy("id").agg(F.first(F.col("prediction").cast("string").try_cast("double")).alias("_before"))
        changed = submission.join(before, "id", "left").agg(F.round(F.coalesce(F.avg(F.coalesce((number != F.col("_before")).cast("int"), F.lit(1))), F.lit(0.0)), 6).alias("changed_rate"))
        out = out.join(changed)
    else:
        out = out.withColumn("changed_rate", F.lit(0.0))
    errors = {
        "row_count": F.col("n_rows") != F.col("n_reference"), "repeated_ids": F.col("repeated_ids") > 0, "repeated_reference_ids": F.col("repeated_reference_ids") > 0, "id_set": F.col("missing_ids") + F.col("extra_ids") > 0,
        "order": (F.col("n_rows") == F.col("n_reference")) & (F.col("out_of_order") > 0), "null_predictions": F.col("null_predictions") > 0, "non_binary": F.col("non_binary") > 0,
    }
    warnings = {"positive_rate": ~F.col("positive_rate").between(low, high), "changed": F.col("changed_rate") > drift}
    return out.withColumns({"errors": F.array_join(named(errors), "|"), "warnings": F.array_join(named(warnings), "|")}).withColumn("valid", (F.col("errors") == "").cast("int"))


def save_submission(submission: DataFrame, reference: DataFrame, path: str, previous: DataFrame | None = None, fail_on_warning: bool = False) -> dict:
    """Write a valid submission; an invalid one goes to ``path`` with ``.unsafe.csv`` added and raises."""
    if submission.columns[:2] != ["id", "prediction"] or set(submission.columns) - {"id", "prediction", "ord"}:
        raise ValueError(f"columns must be id and prediction, not {submission.columns}")
    report = submission_report(submission, reference, previous).first().asDict()
    rows = submission.orderBy("ord").select("id", "prediction") if "ord" in submission.columns else submission
    if not report["valid"]:
        rows.write.option("header", True).mode("overwrite").csv(path + ".unsafe.csv")
        raise ValueError(f"unsafe submission, not saved as final: {report['errors']}")
    if fail_on_warning and report["warnings"]:
        raise ValueError(f"submission warnings: {report['warnings']}")
    rows.write.option("header", True).mode("overwrite").csv(path)
    return report


#: For each explained feature what it must exceed to speak for a match, fall below to speak against one, and its scale.
IMPACTS = {"fuzzy_brand_match_score": (85.0, 40.0, 100.0), "jaccard_similarity": (0.5, 0.1, 1.0), "bm25_score": (5.0, None, 20.0)}


def feature_impacts(rows: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """(id, feature, value, impact, normalized, place): features by falling size, and how each bears on the decision."""

    def impact(name: str) -> Column:
        above, below, _ = IMPACTS.get(name, (None, None, 1.0))
        value, chain = F.col(name), F.when(F.lit(False), "")
        chain = chain if above is None else chain.when(value > above, "positive")
        return (chain if below is None else chain.when(value < below, "negative")).otherwise("neutral")

    each = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.round(F.col(c).cast("double"), 4).alias("value"), impact(c).alias("impact"), F.round(F.least(F.col(c) / IMPACTS.get(c, (0, 0, 1.0))[2], F.lit(1.0)), 4).alias("normalized")) for c in columns)))
    out = rows.select(id_col, each.alias("f")).select(id_col, "f.*")
    # a window holds the features of one row
    return out.withColumn("place", F.row_number().over(Window.partitionBy(id_col).orderBy(F.desc(F.abs("value")), "feature")))


def overlap_attention(query: Column, *context: Column, n: int = 8) -> Column:
    """The first ``n`` words of a query, those found in the context (1.0) before the others (0.35), each with its score."""
    text = F.lower(F.concat_ws(" ", *(F.coalesce(c.cast("string"), F.lit("")) for c in context)))
    words = F.filter(F.split(F.trim(F.lower(F.coalesce(query, F.lit("")))), r"\s+"), lambda w: w != "")
    scored = lambda score, keep: F.transform(F.filter(words, keep), lambda w: F.struct(w.alias("token"), F.lit(score).alias("score")))
    return F.slice(F.concat(scored(1.0, lambda w: text.contains(w)), scored(0.35, lambda w: ~text.contains(w))), 1, n)


def teacher_margin(rows: DataFrame, classes: list[str], label: str = "label", n: int = 32, id_col: str = "id") -> DataFrame:
    """One row: the mean margin of a teacher's relevant over its irrelevant probability over relevant rows drawn by hash.

    ``n`` rows of each side are drawn, fewer where a side has fewer; without
    rows of both sides the margin is null.
    """
    order = F.md5(F.col(id_col).cast("string"))
    sides = rows.groupBy().agg(F.count_if(F.col(label) >= 1).alias("p"), F.count_if(F.col(label) == 0).alias("q"))
    relevant = rows.where(F.col(label) >= 1).orderBy(order, id_col).limit(n).select(F.row_number().over(Window.orderBy(order, id_col)).alias("place"), *classes)
    margin = sum((F.col(c) for c in classes[1:]), F.lit(0.0)) - F.col(classes[0])
    return relevant.join(F.broadcast(sides)).where("place <= least(p, q)").agg(F.round(F.avg(margin), 6).alias("teacher_margin_mean"), F.count("*").alias("n"))


def binarize(proba: Column, threshold: float) -> Column:
    return (proba >= threshold).cast("int")


def leakage_flags(test: DataFrame, train: DataFrame, keys: list[str]) -> DataFrame:
    """Whether each test row's keys occur in training, one flag per key and a verdict by the first that does."""
    out = test
    for k in keys:
        out = out.join(train.select(k).distinct().withColumn(f"seen_{k}", F.lit(1)), k, "left").na.fill(0, [f"seen_{k}"])
    chain = F.when(F.lit(False), F.lit(""))
    for k in keys:
        chain = chain.when(F.col(f"seen_{k}") == 1, F.lit(f"seen_{k}"))
    return out.withColumn("leak", chain.otherwise("clean"))


def heuristic_score(coverage: Column, overlap: Column, jaccard: Column, brand: Column, bm25: Column) -> Column:
    """A fixed linear score of five signals, mapped to 0.08 to 0.92."""
    s = 0.30 * coverage + 0.24 * overlap + 0.18 * jaccard + 0.18 * brand + 0.10 * bm25
    return F.round(0.08 + 0.84 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), s)), 6)


def heuristic_classes(score: Column) -> Column:
    """Probabilities of three classes, irrelevant to highly relevant, from a score of 0 to 1."""
    raw = [F.greatest(F.lit(0.02), p) for p in (F.pow(1.0 - score, F.lit(1.15)), 1.0 - F.abs(score - 0.5) * 1.55, F.pow(score, F.lit(1.25)))]
    total = raw[0] + raw[1] + raw[2]
    return F.array(*(F.round(p / total, 6) for p in raw))


def confident_false_negatives(rows: DataFrame, similarity: str = "similarity", pred: str = "pred", above: float = 0.6) -> DataFrame:
    """Rows predicted irrelevant although query and title are alike."""
    return rows.where((F.col(similarity) > above) & (F.col(pred) == 0))
