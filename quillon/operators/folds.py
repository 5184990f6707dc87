"""Fold assignment that does not depend on partitioning, and its checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import quantiles


def hash_number(c: Column, seed: str = "0") -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), c.cast("string"))), 1, 8), 16, 10).cast("bigint")


def group_fold(group: Column, k: int, seed: str = "0") -> Column:
    """Rows of one group share a fold; no state and no shuffle is needed."""
    return (hash_number(group, seed) % k).cast("int")


def places(rows: DataFrame, by: str, key: str, seed: str = "0", name: str = "place") -> DataFrame:
    """Adds each row's 0-based place within ``by`` in hash order of its key.

    The place is counted within hash ranges first, so no value's rows meet in
    one task: a range's offset is the sum of the counts before it.
    """
    h = hash_number(F.col(key), seed)
    ranged = rows.withColumns({"_h": h, "_b": F.shiftright(h, 22).cast("int")})
    sizes = ranged.groupBy(by, "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(by, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    place = F.row_number().over(Window.partitionBy(by, "_b").orderBy("_h", key))
    return ranged.withColumn("_p", place).join(offsets, [by, "_b"]).withColumn(name, F.col("_p") - 1 + F.col("_o")).drop("_h", "_b", "_p", "_o")


def stratified_folds(rows: DataFrame, label: str, key: str, k: int, seed: str = "0") -> DataFrame:
    """Folds of equal size per label: places in hash order, dealt in turn."""
    return places(rows, label, key, seed, "_place").withColumn("fold", (F.col("_place") % k).cast("int")).drop("_place")


def _fold_at(k: int) -> Column:
    """The fold of the group at ``_place`` of those of size ``_size`` where the folds hold ``_loads`` before them.

    Dealt one by one into the lightest fold, the places go to the folds in order
    of their loads plus whole sizes: with a load of q sizes and a rest r, a fold
    takes one group at each level from q on, and at a level folds go by their
    rests.  The level of a place follows from how many folds have reached it.
    """
    size, place = F.col("_size"), F.col("_place")
    level_of = lambda load: F.floor(load / size).cast("bigint")
    starts = F.array_sort(F.transform("_loads", level_of))
    level, before = F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
    total = F.lit(0).cast("bigint")
    for active in range(1, k + 1):
        total = total + F.get(starts, F.lit(active - 1))
        at = F.floor((place + total) / active).cast("bigint")
        fits = (at >= F.get(starts, F.lit(active - 1))) & ((at < F.get(starts, F.lit(active))) if active < k else F.lit(True))
        level, before = F.coalesce(level, F.when(fits, at)), F.coalesce(before, F.when(fits, active * at - total))
    folds = F.transform("_loads", lambda load, fold: F.struct((load % size).alias("rest"), fold.alias("fold"), level_of(load).alias("start")))
    reached = F.array_sort(F.filter(folds, lambda f: f["start"] <= level))
    return F.get(reached, (place - before).cast("int"))["fold"].cast("int")


def _loads(sizes: list[tuple[int, int]], k: int) -> list[tuple[int, list[int]]]:
    """(size, loads of the folds before it), from (size, number of groups) by falling size."""
    loads, out = [0] * k, []
    for size, n in sizes:
        out.append((size, list(loads)))
        # all folds are filled up to the highest level that the groups reach, the last few go by rest and number
        starts = sorted(load // size for load in loads)
        active = next(a for a in range(k, 0, -1) if (n - 1 + sum(starts[:a])) // a >= starts[a - 1])
        level = (n - 1 + sum(starts[:active])) // active
        taken = [max(0, level - load // size) for load in loads]
        open_folds = sorted((load % size, f) for f, load in enumerate(loads) if load // size <= level)
        for _, f in open_folds[: n - sum(taken)]:
            taken[f] += 1
        loads = [load + t * size for load, t in zip(loads, taken, strict=True)]
    return out


def balanced_group_folds(rows: DataFrame, group: str, k: int, seed: str = "0") -> DataFrame:
    """Folds that keep groups together and differ by no more rows than the largest group has.

    Groups are dealt from the largest to the smallest, equal ones in hash order,
    each into the fold with the fewest rows, the first of these.  Only how many
    groups there are of each size is looked at in one place: of n rows that is
    less than the square root of 2 n numbers.  All groups of one size are then
    dealt at once.  Rows without a group are one group.
    """
    sizes = rows.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_size"))
    counts = sizes.groupBy("_size").agg(F.count("*").alias("n")).orderBy(F.desc("_size")).collect()
    loads = rows.sparkSession.createDataFrame(_loads([(r["_size"], r.n) for r in counts], k), "_size bigint, _loads array<bigint>")
    placed = places(sizes.withColumn("_key", F.coalesce(F.col("_group").cast("string"), F.lit(""))), "_size", "_key", seed, "_place")
    dealt = placed.join(F.broadcast(loads), "_size").select("_group", _fold_at(k).alias("fold"))
    return rows.join(dealt, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


def tail_groups(rows: DataFrame, group: str, share: float = 0.2) -> DataFrame:
    """Adds ``tail``: whether a row's group is one of the smallest, which hold at most ``share`` of all rows together.

    Groups of one size are in the tail together or not at all.
    """
    sizes = rows.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_size"))
    # a row per distinct size, less than the square root of twice the rows
    held = sizes.groupBy("_size").agg((F.count("*") * F.col("_size")).alias("_rows"))
    upto = held.select("_size", F.sum("_rows").over(Window.orderBy("_size")).alias("_upto"), F.sum("_rows").over(Window.partitionBy()).alias("_all"))
    most = upto.where(F.col("_upto") <= share * F.col("_all")).agg(F.coalesce(F.max("_size"), F.lit(0)).alias("most")).first().most
    marked = sizes.select("_group", (F.col("_size") <= most).alias("tail"))
    return rows.join(marked, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


def tail_folds(rows: DataFrame, group: str, k: int, share: float = 0.2, seed: str = "0") -> DataFrame:
    """Balanced folds by group of the tail's rows and of the others, each dealt for itself, so that every fold has its part of the tail."""
    marked = tail_groups(rows, group, share)
    return balanced_group_folds(marked.where("tail"), group, k, seed).unionByName(balanced_group_folds(marked.where("NOT tail"), group, k, seed))


def grouped_folds(rows: DataFrame, group: str, label: str, key: str, k: int, seed: str = "0") -> DataFrame:
    """Folds that keep groups together; with fewer than ``k`` groups, folds stratified by label instead."""
    if rows.select(group).distinct().limit(k).count() < k:
        return stratified_folds(rows, label, key, k, seed)
    return rows.withColumn("fold", group_fold(F.col(group), k, seed))


def stratified_group_folds(rows: DataFrame, group: str, label: str, k: int, seed: str = "0", bands: int = 10) -> DataFrame:
    """Folds that keep groups together and the share of label 1 alike: groups are dealt in turn within bands of that share."""
    share = rows.groupBy(group).agg(F.floor(F.avg((F.col(label) == 1).cast("int")) * bands).cast("int").alias("_band"))
    dealt = stratified_folds(share, "_band", group, k, seed).select(F.col(group).alias("_group"), "fold")
    return rows.join(dealt, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


def temporal_split(rows: DataFrame, ts: str, share: float = 0.8) -> DataFrame:
    """'train' up to the exact ``share`` quantile of time, 'test' after it."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    found = quantiles(rows.select(micros.alias("t")), "t", {"cut": share}).first()
    return rows.withColumn("part", F.when(micros <= (found.cut if found else 0), "train").otherwise("test"))


def leaking_groups(rows: DataFrame, group: str, fold: str = "fold") -> DataFrame:
    """Groups that occur in more than one fold."""
    return rows.groupBy(group).agg(F.count_distinct(fold).alias("folds"), F.count("*").alias("n")).where("folds > 1")
