"""Small helpers that the text operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import count

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task holds as Python words at one time.
GROUP_BYTES = 1 << 20
#: Entries that a worker's memo keeps before it starts afresh.
MEMO_ENTRIES = 150_000

#: Bytes of an Arrow batch where rows are large, so that a worker holds few of them at one time.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Spark's switch for removing a query's shuffle files once it has run.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_serial = count()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; other columns are never read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def scratch_path(spark: SparkSession, what: str) -> str:
    """A fresh folder under the shared folder that ``spark.checkpoint.dir`` names.

    Where the setting is absent, a session on one machine takes a folder below
    /tmp; on a cluster executors could not read each other's, so it raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"/tmp/quillon-{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}-{id(spark)}-{what}-{next(_serial)}-{uuid.uuid4().hex[:12]}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the queries that run meanwhile."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def written(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    The shuffle files of the write are removed when it ends, as nothing reads
    them again; else they would stay until the driver collects its garbage.
    """
    return _saved(df, scratch_path(df.sparkSession, what))


def _saved(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    with setting(spark, CLEANUP, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that a computation writes for itself, and that end with it.

    The result must be written by :func:`written` before the block ends, since
    the tables that it is made of are deleted there.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def written(self, df: DataFrame, what: str) -> DataFrame:
        self.paths.append(scratch_path(self.spark, what))
        return _saved(df, self.paths[-1])

    def __exit__(self, *_) -> None:
        for path in self.paths:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def crc32_of_id(column: str = "doc_id"):
    """crc32 of an id's decimal text; null where the id is null."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def task_number() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def text_groups(batches: Iterable[pa.RecordBatch], limit: int = GROUP_BYTES, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches to at most ``limit`` bytes of text, but one row at least."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, n in enumerate(size.tolist()):
            if held and held + n > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += n
        yield batch.slice(start)
