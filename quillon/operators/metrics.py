"""Scores against labels: confusion, threshold curves, segments and stability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import average_ranks, joined, quantiles

#: The 91 thresholds 0.05, 0.06 to 0.95.
GRID = [round(0.05 + i * 0.01, 10) for i in range(91)]


def _share(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def scores_of_counts(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Precision, recall and F1 per class and macro F1; a share without a denominator is 0."""
    f1 = lambda t, p, n: _share(2 * t, 2 * t + p + n)
    return {
        "precision_1": _share(tp, tp + fp), "recall_1": _share(tp, tp + fn), "f1_1": f1(tp, fp, fn),
        "precision_0": _share(tn, tn + fn), "recall_0": _share(tn, tn + fp), "f1_0": f1(tn, fn, fp),
        "macro_f1": (f1(tp, fp, fn) + f1(tn, fn, fp)) / 2, "positive_rate": _share(tp + fp, tp + fp + fn + tn),
    }


def confusion(rows: DataFrame, threshold: float = 0.5, by: list[str] | None = None, proba: str = "proba", label: str = "label") -> DataFrame:
    """One row of counts and scores, or one per group of ``by``."""
    hit, true = F.col(proba) >= threshold, F.col(label) == 1
    counts = rows.groupBy(*(by or [])).agg(F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"), F.count_if(~hit & true).alias("fn"), F.count_if(~hit & ~true).alias("tn"))
    c = [F.col(x) for x in ("tp", "fp", "fn", "tn")]
    return counts.withColumns({k: F.round(v, 6) for k, v in scores_of_counts(*c).items()})


def threshold_curve(rows: DataFrame, by: list[str] | None = None, proba: str = "proba", label: str = "label") -> DataFrame:
    """Macro F1 and counts at each threshold of the grid, per group of ``by``.

    Rows become at most 92 counts per group (how many thresholds a score
    reaches); the curve is a running sum over those, so its cost does not
    depend on the number of thresholds.
    """
    by = by or []
    reached = F.size(F.filter(F.array(*map(F.lit, GRID)), lambda t: t <= F.col(proba)))
    bins = rows.groupBy(*by, reached.alias("bin")).agg(F.sum(F.col(label).cast("bigint")).alias("p"), F.count("*").alias("n"))
    grid = F.explode(F.array(*(F.struct(F.lit(i + 1).alias("bin"), F.lit(t).alias("threshold")) for i, t in enumerate(GRID))))
    totals = bins.groupBy(*by).agg(F.coalesce(F.sum("p"), F.lit(0)).alias("all_p"), F.coalesce(F.sum("n"), F.lit(0)).alias("all_n"))
    full = totals.withColumn("g", grid).select(*by, "all_p", "all_n", "g.bin", "g.threshold").join(bins, [*by, "bin"], "left")
    above = Window.partitionBy(*by).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    tp, hits = F.coalesce(F.sum("p").over(above), F.lit(0)), F.coalesce(F.sum("n").over(above), F.lit(0))
    counted = full.withColumns({"tp": tp, "fp": hits - tp}).withColumns({"fn": F.col("all_p") - F.col("tp"), "tn": F.col("all_n") - F.col("all_p") - F.col("fp")})
    s = scores_of_counts(*(F.col(x) for x in ("tp", "fp", "fn", "tn")))
    return counted.select(*by, "threshold", "tp", "fp", "fn", "tn", *(F.round(s[k], 6).alias(k) for k in ("f1_0", "f1_1", "macro_f1")))


def best_threshold(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The row of highest macro F1, the lowest threshold of equal ones."""
    by = by or []
    first = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("macro_f1"), F.asc("threshold")))
    return curve.withColumn("_r", first).where("_r = 1").drop("_r")


def threshold_sensitivity(curve: DataFrame, width: float = 0.03, limit: float = 0.01) -> DataFrame:
    """Largest drop of macro F1 within ``width`` of the best threshold; fragile above ``limit``."""
    best = best_threshold(curve).select(F.col("threshold").alias("best_threshold"), F.col("macro_f1").alias("best_macro_f1"))
    near = curve.join(F.broadcast(best), F.abs(F.col("threshold") - F.col("best_threshold")) <= width + 1e-9)
    drop = F.round(F.max("best_macro_f1") - F.min("macro_f1"), 6)
    return near.groupBy("best_threshold", "best_macro_f1").agg(drop.alias("max_drop"), F.count("*").alias("n_thresholds")).withColumn("fragile", (F.col("max_drop") > limit).cast("int"))


def stable_midpoint(curve: DataFrame, slack: float = 0.002) -> DataFrame:
    """The middle of the thresholds whose macro F1 is within ``slack`` of the best, beside the best and its neighbours."""
    best = best_threshold(curve).select(F.col("threshold").alias("best"), F.col("macro_f1").alias("top"))
    near = curve.join(F.broadcast(best), F.col("macro_f1") >= F.col("top") - slack - 1e-9)
    mid = F.round((F.min("threshold") + F.max("threshold")) / 2, 4)
    return near.groupBy("best").agg(mid.alias("stable_midpoint")).withColumns({"fixed": F.lit(0.5), "lower": F.round(F.col("best") - 0.05, 4), "higher": F.round(F.col("best") + 0.05, 4)})


def group_thresholds(rows: DataFrame, by: str, least_rows: int = 20, proba: str = "proba", label: str = "label") -> DataFrame:
    """Best threshold per group against the global one; small groups and groups of one class are left out."""
    whole = best_threshold(threshold_curve(rows, None, proba, label)).first()
    kept = rows.groupBy(by).agg(F.count("*").alias("n"), F.count_distinct(label).alias("classes")).where((F.col("n") >= least_rows) & (F.col("classes") > 1))
    curve = threshold_curve(rows.join(kept.select(by), by, "left_semi"), [by], proba, label)
    own = best_threshold(curve, [by]).select(by, F.col("threshold").alias("best_threshold"), F.col("macro_f1").alias("best_macro_f1"))
    at_global = curve.where(F.abs(F.col("threshold") - (whole.threshold if whole else 0.5)) < 1e-9).select(by, F.col("macro_f1").alias("global_macro_f1"))
    return own.join(at_global, by).join(kept.select(by, "n"), by).withColumn("gain", F.round(F.col("best_macro_f1") - F.col("global_macro_f1"), 6))


def segment_scores(rows: DataFrame, segments: list[str], threshold: float = 0.5) -> DataFrame:
    """Confusion per value of each segment column, null being a value of its own."""
    pairs = F.explode(F.array(*(F.struct(F.lit(s).alias("segment"), F.coalesce(F.col(s).cast("string"), F.lit("null")).alias("value")) for s in segments)))
    return confusion(rows.withColumn("_s", pairs).select("*", "_s.segment", "_s.value"), threshold, ["segment", "value"])


def seed_stability(scores: DataFrame, score: str = "macro_f1") -> DataFrame:
    """Mean and population deviation over seeds."""
    return scores.agg(F.round(F.avg(score), 6).alias("mean"), F.round(F.stddev_pop(score), 6).alias("std"), F.count("*").alias("n"))


def describe(rows: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact interpolated quartiles and maximum."""
    by = by or []
    base = rows.groupBy(*by).agg(F.count(column).alias("n"), F.round(F.avg(column), 6).alias("mean"), F.round(F.stddev_samp(column), 6).alias("std"), F.min(column).alias("low"), F.max(column).alias("high"))
    quartiles = quantiles(rows, column, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by).select(*by, *(F.round(q, 6).alias(q) for q in ("q25", "q50", "q75")))
    both = joined(base, quartiles, by, "left") if by else base.join(quartiles, how="left")
    return both.select(*by, "n", "mean", "std", "low", "q25", "q50", "q75", "high")


def spearman(rows: DataFrame, a: str, b: str, by: list[str]) -> DataFrame:
    """Pearson and Spearman correlation per group, null below three rows."""
    ranked = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*by, a, b)
    for c, name in ((a, "_a"), (b, "_b")):
        ranked = average_ranks(ranked, c, by, name)
    enough = F.count("*") >= 3
    return ranked.groupBy(*by).agg(F.count("*").alias("n"), F.when(enough, F.round(F.corr(a, b), 6)).alias("pearson"), F.when(enough, F.round(F.corr("_a", "_b"), 6)).alias("spearman"))


def class_thresholds(rows: DataFrame, classes: list[str], label: str = "label", grid: tuple[float, ...] = (0.3, 0.4, 0.5, 0.6, 0.7)) -> DataFrame:
    """(class, threshold, f1): per class, numbered as in ``classes``, the threshold of its best F1 against the rest, the lowest of equal ones."""
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("class"), F.lit(t).alias("threshold"), (F.col(c) >= t).alias("hit")) for i, c in enumerate(classes) for t in grid)))
    counts = rows.select(label, each.alias("x")).groupBy("x.class", "x.threshold").agg(F.count_if(F.col("x.hit") & (F.col(label) == F.col("x.class"))).alias("tp"), F.count_if(F.col("x.hit")).alias("hits"), F.count_if(F.col(label) == F.col("x.class")).alias("true"))
    scored = counts.withColumn("f1", F.round(_share(2 * F.col("tp"), F.col("hits") + F.col("true")), 6))
    first = F.row_number().over(Window.partitionBy("class").orderBy(F.desc("f1"), F.asc("threshold")))
    return scored.withColumn("_r", first).where("_r = 1").select("class", "threshold", "f1")


def size_band(n: Column) -> Column:
    """How likely a threshold fitted to ``n`` rows is fitted to their noise."""
    return F.when(n < 100, "high").when(n < 500, "medium").otherwise("lower")


def length_stats(rows: DataFrame, length: str, limit: int) -> DataFrame:
    """One row: rows, mean, exact 95th percentile and maximum of a length, and the share of rows beyond ``limit``."""
    base = rows.agg(F.count("*").alias("n_rows"), F.round(F.avg(length), 6).alias("mean"), F.max(length).alias("longest"), F.round(F.avg((F.col(length) > limit).cast("int")), 6).alias("truncation_rate"))
    return base.join(quantiles(rows, length, {"p95": 0.95}).select(F.round("p95", 6).alias("p95")))
