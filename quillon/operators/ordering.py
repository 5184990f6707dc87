"""Places, ranks, quantiles and neighbours over whole tables, without all rows or values in one task."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranged(rows: DataFrame, column: str, name: str = "_range") -> DataFrame:
    """Adds the number of the range that ``column``, a number and not null, falls into; ranges follow its order.

    Bounds are approximate quantiles, and constants of the plan: a row's range
    is the same however often it is computed.
    """
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = rows.select(F.col(column).cast("double").alias("_x")).approxQuantile("_x", [i / parts for i in range(1, parts)], 0.25 / parts)
    splits = sorted(set(bounds))
    if not splits:
        return rows.withColumn(name, F.lit(0))
    cut = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol="_x", outputCol=name).transform(rows.withColumn("_x", F.col(column).cast("double")))
    return cut.drop("_x").withColumn(name, F.col(name).cast("int"))


def value_places(rows: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """(by, value, n, first, last): each distinct value of ``column`` with its 0-based places in its group.

    Rows are counted per value first, so a value that many rows share is one
    row; running counts go range by range.  Nulls have no place.
    """
    by = by or []
    counts = ranged(rows.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).alias("value")).agg(F.count("*").alias("n")), "value")
    sizes = counts.groupBy(*by, "_range").agg(F.sum("n").alias("_n"))
    # as many rows as ranges in each group
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    upto = F.sum("n").over(Window.partitionBy(*by, "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("_upto", upto)
    found = joined(placed, offsets, [*by, "_range"]).select(*by, "value", "n", (F.col("_offset") + F.col("_upto") - F.col("n")).alias("first"))
    return found.withColumn("last", F.col("first") + F.col("n") - 1)


def joined(rows: DataFrame, others: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """A join on columns of both sides in which nulls are equal."""
    renamed = others.withColumnsRenamed({c: f"_of_{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return rows.join(renamed, same, how).drop(*(f"_of_{c}" for c in by))


def quantiles(rows: DataFrame, column: str, shares: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """(by, name per share): exact quantiles with linear interpolation; one row per group, none for a group of nulls."""
    by = by or []
    places = value_places(rows, column, by)
    total = places.groupBy(*by).agg(F.sum("n").alias("_total"))
    both = joined(places, total, by) if by else places.join(total)
    at = {name: F.lit(share) * (F.col("_total") - 1) for name, share in shares.items()}
    held = lambda place: F.max(F.when(place.between(F.col("first"), F.col("last")), F.col("value").cast("double")))
    found = both.groupBy(*by).agg(
        *(held(F.floor(p + 1e-9)).alias(f"_low_{n}") for n, p in at.items()), *(held(F.ceil(p - 1e-9)).alias(f"_high_{n}") for n, p in at.items()), *(F.max(p - F.floor(p + 1e-9)).alias(f"_part_{n}") for n, p in at.items())
    )
    return found.select(*by, *((F.col(f"_low_{n}") + F.greatest(F.lit(0.0), F.col(f"_part_{n}")) * (F.col(f"_high_{n}") - F.col(f"_low_{n}"))).alias(n) for n in shares))


def with_previous(rows: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """Adds ``prev_`` columns: the values of the row before, by ``order`` over the whole table; null in the first row.

    ``order`` is a number that each row has once.  Each row looks back within
    its range, and the last row of a range is joined to the first of the next.
    """
    cut = ranged(rows, order)
    own = Window.partitionBy("_range").orderBy(order)
    back = cut.withColumn("_place", F.row_number().over(own)).withColumns({f"prev_{c}": F.lag(c).over(own) for c in columns})
    last = cut.groupBy("_range").agg(F.max_by(F.struct(*columns), order).alias("_last"))
    # one row per range
    before = last.select("_range", F.lag("_last").over(Window.orderBy("_range")).alias("_last"))
    out = back.join(F.broadcast(before), "_range", "left")
    return out.withColumns({f"prev_{c}": F.when(F.col("_place") == 1, F.col(f"_last.{c}")).otherwise(F.col(f"prev_{c}")) for c in columns}).drop("_range", "_place", "_last")


def average_ranks(rows: DataFrame, column: str, by: list[str], name: str) -> DataFrame:
    """Adds the 1-based rank in which equal values of a group share their mean place; null where the value is null."""
    places = value_places(rows, column, by).withColumn(name, (F.col("first") + F.col("last")) / 2 + 1).select(*(F.col(c).alias(f"_by_{c}") for c in by), F.col("value").alias("_value"), name)
    same = F.col(column) == F.col("_value")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return rows.join(places, same, "left").drop("_value", *(f"_by_{c}" for c in by))
