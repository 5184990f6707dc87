"""Blends of out-of-fold scores, ranks, correlations and weights."""

from __future__ import annotations

from functools import reduce
from itertools import combinations, product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .metrics import best_threshold, scores_of_counts, threshold_curve
from .ordering import average_ranks as mean_ranks


def wide_scores(models: dict[str, DataFrame], key: str = "id", proba: str = "proba") -> DataFrame:
    """One column per model, joined on the id; the first model's rows are kept and an absent score is 0."""
    frames = [df.select(key, F.col(proba).alias(name)) for name, df in models.items()]
    return reduce(lambda a, b: a.join(b, key, "left"), frames).na.fill(0.0, list(models))


def weighted(weights: dict[str, float]) -> Column:
    """Sum of weight times score; weights below 0 count as 0 and are scaled to 1, equal ones if all are 0."""
    clipped = {m: max(w, 0.0) for m, w in weights.items()}
    total = sum(clipped.values())
    return reduce(lambda a, b: a + b, (F.col(m) * (w / total if total else 1 / len(clipped)) for m, w in clipped.items()))


def normalized_weight(w: Column, over) -> Column:
    """A row's share of the clipped weights of its window; equal shares where their sum is 0."""
    clipped = F.greatest(w, F.lit(0.0))
    total = F.sum(clipped).over(over)
    return F.when(total > 0, clipped / total).otherwise(1.0 / F.count("*").over(over))


def global_place(rows: DataFrame, score: str, key: str, name: str, buckets: int = 2048) -> DataFrame:
    """Adds the 0-based place of each row by score (0 to 1), ties in the order of the key's md5.

    No task sorts all rows: a row's place is that of its score bucket, plus that
    of its (score, md5 prefix) cell in the bucket, plus its own in the cell.
    Many rows of one score are dealt over 256 cells.
    """
    cell = rows.withColumns({"_m": F.md5(F.col(key).cast("string")), "_b": F.least(F.lit(buckets), F.greatest(F.lit(0), F.floor(F.col(score) * buckets))).cast("int")}).withColumn("_c", F.substring("_m", 1, 2))
    sizes = cell.groupBy("_b", score, "_c").agg(F.count("*").alias("_n"))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = sizes.withColumn("_o", before(Window.partitionBy("_b").orderBy(score, "_c")))
    outer = sizes.groupBy("_b").agg(F.sum("_n").alias("_n")).withColumn("_p", before(Window.orderBy("_b")))  # at most buckets + 1 rows
    offsets = inner.join(outer.select("_b", "_p"), "_b").select("_b", score, "_c", (F.col("_o") + F.col("_p")).alias("_o"))
    own = F.row_number().over(Window.partitionBy("_b", score, "_c").orderBy("_m", key)) - 1
    return cell.withColumn("_r", own).join(offsets, ["_b", score, "_c"]).withColumn(name, F.col("_r") + F.col("_o")).drop("_m", "_b", "_c", "_r", "_o")


def rank_scores(rows: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    """Adds ``<column>_rank``: the 0-based place by score divided by n - 1."""
    n = max(rows.count() - 1, 1)
    for c in columns:
        rows = global_place(rows, c, key, f"{c}_rank").withColumn(f"{c}_rank", F.round(F.col(f"{c}_rank") / n, 6))
    return rows


def average_ranks(rows: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Adds the mean-tie rank divided by the group's size."""
    size = rows.groupBy(*by).agg(F.count("*").alias("_size"))
    ranked = mean_ranks(rows, column, by, "average_rank").join(size, by)
    return ranked.withColumn("average_rank", F.round(F.col("average_rank") / F.col("_size"), 6)).drop("_size")


def weight_search(wide: DataFrame, models: list[str], label: str = "label", steps: int = 4, threshold: float = 0.5) -> DataFrame:
    """(weights, macro_f1) of every blend whose weights are multiples of 1 / ``steps``; the grid is short, and one aggregate scores all."""
    grid = [w for w in product(range(steps + 1), repeat=len(models)) if sum(w) == steps]
    blends = F.array(*(F.struct(F.lit("|".join(map(str, w))).alias("weights"), (F.round(reduce(lambda a, b: a + b, (F.col(m) * (n / steps) for m, n in zip(models, w, strict=True))), 6) >= threshold).alias("hit")) for w in grid))
    true = F.col(label) == 1
    counts = wide.select(label, F.explode(blends).alias("x")).groupBy("x.weights").agg(F.count_if(F.col("x.hit") & true).alias("tp"), F.count_if(F.col("x.hit") & ~true).alias("fp"), F.count_if(~F.col("x.hit") & true).alias("fn"), F.count_if(~F.col("x.hit") & ~true).alias("tn"))
    return counts.select("weights", F.round(scores_of_counts(*map(F.col, ("tp", "fp", "fn", "tn")))["macro_f1"], 6).alias("macro_f1"))


def model_correlations(wide: DataFrame, models: list[str]) -> DataFrame:
    """(a, b, corr) of all pairs of models in one aggregate."""
    pairs = list(combinations(models, 2))
    row = wide.agg(*(F.round(F.corr(a, b), 6).alias(f"{a}|{b}") for a, b in pairs))
    each = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("corr")) for a, b in pairs)))
    return row.select(each.alias("x")).select("x.*")


def disagreements(wide: DataFrame, a: str, b: str, threshold: float = 0.5) -> DataFrame:
    """Rows on which two models decide differently, with the gap."""
    return wide.where((F.col(a) >= threshold) != (F.col(b) >= threshold)).withColumn("gap", F.round(F.abs(F.col(a) - F.col(b)), 6))


def blend_search(wide: DataFrame, models: dict[str, float], label: str = "label", most: int = 3, limit: float = 0.985) -> DataFrame:
    """Best threshold and macro F1 of every combination of up to ``most`` models, weighted by their own F1.

    Combinations with a pair correlated above ``limit`` are left out.  The
    combinations are a short list of the driver; one aggregate scores all.
    """
    high = {(r.a, r.b) for r in model_correlations(wide, list(models)).where(F.col("corr") > limit).collect()} if len(models) > 1 else set()
    combos = [c for n in range(1, most + 1) for c in combinations(models, n) if not any(p in high for p in combinations(c, 2))]
    each = F.explode(F.array(*(F.struct(F.lit("+".join(c)).alias("blend"), F.round(weighted({m: models[m] for m in c}), 6).alias("proba")) for c in combos)))
    long = wide.select(label, each.alias("x")).select(label, "x.*")
    return best_threshold(threshold_curve(long, ["blend"], label=label), ["blend"]).select("blend", "threshold", "macro_f1")


def fused(cross: Column, tabular: Column, share: float = 0.7) -> Column:
    """Class probabilities of two models mixed and scaled to sum to 1."""
    mixed = F.zip_with(cross, tabular, lambda a, b: share * a + (1 - share) * b)
    total = F.aggregate(mixed, F.lit(0.0), lambda s, x: s + x)
    return F.transform(mixed, lambda x: F.coalesce(F.try_divide(x, total), F.lit(0.0)))
