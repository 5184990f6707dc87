"""Tables that a computation writes for itself below the shared folder, and versioned folders of stored results."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, what: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    A session on one machine without that setting takes a folder below /tmp; on
    a cluster executors could not read each other's, so it raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"/tmp/quillon-{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}-{what}-{uuid.uuid4().hex}"


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def tasks_apart(spark: SparkSession):
    """Plans that run meanwhile read each part of a union of frames of one partition in a task of its own.

    Since 4.1 Spark takes such frames for equally partitioned and reads all of them in one task, one after another.
    """
    return _set(spark, "spark.sql.unionOutputPartitioning", "false")


def saved(df: DataFrame, path: str, *by: str) -> DataFrame:
    """The frame, written to ``path`` as Parquet, in folders by the columns ``by``, and read back."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Work:
    """Written tables that end with the block; what is returned from it must not read them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[tuple[str, str]] = []

    def __enter__(self) -> Work:
        return self

    def written(self, df: DataFrame, what: str, *by: str) -> DataFrame:
        """The frame, written in folders by the columns ``by`` and read back; the shuffle files of the write go with its end."""
        with _set(self.spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            return saved(df, self.folder(what), *by)

    def folder(self, what: str) -> str:
        """A folder that ends with the block."""
        self.paths.append((what, shared_folder(self.spark, what)))
        return self.paths[-1][1]

    def ended(self, *names: str) -> None:
        """Deletes the tables that were written under these names."""
        for what, path in self.paths:
            if what in names:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.paths = [x for x in self.paths if x[0] not in names]

    def __exit__(self, *_) -> None:
        self.ended(*(what for what, _ in self.paths))
