"""Star joins with checked keys, quality counts, deduplication and id alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.text import text_or_empty


def repeated_keys(df: DataFrame, keys: list[str], examples: int = 10) -> DataFrame:
    """All keys held by several rows with their counts, the first ``examples`` of them."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").orderBy(*keys).limit(examples)


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The frame itself; raises if a key repeats."""
    found = repeated_keys(df, keys).collect()
    if found:
        raise ValueError(f"{', '.join(keys)} repeats: {[tuple(r)[:-1] for r in found]}")
    return df


def star_join(pairs: DataFrame, terms: DataFrame, items: DataFrame, term_id: str = "term_id", item_id: str = "item_id", check: bool = True) -> DataFrame:
    """Pairs with the columns of their term and item, many to one.

    Spark broadcasts a dimension while it is small and otherwise shuffles, with
    skewed keys split at run time.
    """
    if check:
        require_unique(terms, [term_id])
        require_unique(items, [item_id])
    return pairs.join(terms, term_id, "left").join(items, item_id, "left")


def blank(c: Column) -> Column:
    return F.trim(text_or_empty(c)) == ""


def join_quality(pairs: DataFrame, joined: DataFrame, required: list[str], keys: list[str], id_col: str = "id") -> DataFrame:
    """One row of counters: rows, missing and blank columns, distinct ids and keys, repeated pairs."""
    counts = joined.agg(
        F.count("*").alias("n_rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in required),
        *(F.count_if(blank(F.col(c))).alias(f"blank_{c}") for c in required),
        *(F.count_distinct(k).alias(f"unique_{k}") for k in keys),
    )
    repeats = pairs.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("repeated_pair_rows"))
    ids = pairs.groupBy(id_col).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("repeated_id_rows"))
    return counts.join(repeats).join(ids)


def latest_per_key(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per key, the first by ``order``."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c.cast("string"), F.lit("")) for c in columns))


def id_difference(expected: DataFrame, given: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, with the side's name."""
    missing = expected.select(key).distinct().join(given.select(key), key, "left_anti").withColumn("side", F.lit("missing"))
    extra = given.select(key).distinct().join(expected.select(key), key, "left_anti").withColumn("side", F.lit("extra"))
    return missing.unionByName(extra)


def mode_per_group(rows: DataFrame, group: str, value: str) -> DataFrame:
    """The most frequent value per group with its count and share, the smallest of equal ones."""
    counts = rows.groupBy(group, value).agg(F.count("*").alias("n"))
    total = Window.partitionBy(group)
    first = F.row_number().over(total.orderBy(F.desc("n"), F.asc(value)))
    return counts.withColumns({"total": F.sum("n").over(total), "_r": first}).where("_r = 1").select(group, F.col(value).alias("mode"), "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def hash_sample(rows: DataFrame, key: str, n: int, by: list[str] | None = None, seed: str = "0") -> DataFrame:
    """``n`` rows per group (or in all) drawn by a hash of the key, whatever the partitioning."""
    order = F.md5(F.concat(F.lit(seed + ":"), F.col(key).cast("string")))
    if not by:
        return rows.orderBy(order, key).limit(n)
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(order, key))).where(F.col("_r") <= n).drop("_r")


def first_by_names(rows: DataFrame, names: dict[str, list[str]], then: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in the order that each list of names gives its column, other names last, and then by ``then``."""
    places = [F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col(c)), F.lit(0)), F.lit(len(order) + 1)) for c, order in names.items()]
    return rows.orderBy(*places, *then).limit(n)


def cut(df: DataFrame) -> DataFrame:
    """The frame, computed once and saved below ``spark.checkpoint.dir``, without the plan that made it.

    A session on one machine without that setting takes a folder below /tmp; on
    a cluster executors could not read each other's, so it raises.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = f"/tmp/quillon-{spark.sparkContext.applicationId}"
        spark.sparkContext.setCheckpointDir(base)
    return df.checkpoint()
