"""Consecutive numbers for the rows of a table, without a sort in one task or a list on the driver."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.sources.work import Work

#: Rows of a partition that monotonically_increasing_id leaves room for.
_PLACE = (1 << 33) - 1


def numbered(rows: DataFrame, by: list[str], work: Work, name: str = "number") -> DataFrame:
    """Adds ``name``: 0, 1, 2 and on in the order of the columns ``by``.

    The rows are ranged over partitions and written with their place in theirs;
    a partition's first number is what the partitions before it hold.  Only the
    sizes of partitions reach the driver.  Rows that are equal in ``by`` lie in
    one partition and get numbers in an unspecified order; without columns all
    rows do.
    """
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by) if by else rows
    placed = work.written(ranged.withColumn("_at", F.monotonically_increasing_id()), f"numbered-{name}")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    firsts = accumulate((r.n for r in sizes), initial=0)
    starts = rows.sparkSession.createDataFrame([(r.part, first) for r, first in zip(sizes, firsts)], "_part bigint, _first bigint")
    joined = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.withColumn(name, F.col("_first") + F.col("_at").bitwiseAND(F.lit(_PLACE))).drop("_at", "_part", "_first")
