"""Reading and writing tables and logs through Spark's own readers and writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names under which older files hold a column; the first that is present is taken.
ALIASES = {
    "product_id": ("product_id", "item_id", "id"),
    "search_query": ("search_query", "query", "search_term"),
    "product_name": ("product_name", "title", "name"),
    "brand": ("brand", "marka"),
    "category": ("category", "kategori"),
    "product_color": ("product_color", "color", "renk"),
    "product_material": ("product_material", "material", "materyal"),
    "is_relevant": ("is_relevant", "label", "relevance"),
}


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet, ORC, JSON or CSV by the path's suffix; CSV has a header and, without a schema, string columns."""
    kind = path.rsplit(".", 1)[-1].lower()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if kind in ("parquet", "orc"):
        return reader.format(kind).load(path)
    if kind in ("json", "jsonl"):
        return reader.json(path)
    return reader.csv(path, header=True, multiLine=True, escape='"')


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """The format is that of the path's suffix, as for ``read_table``."""
    kind = path.rsplit(".", 1)[-1].lower()
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if kind in ("parquet", "orc"):
        writer.format(kind).save(path)
    elif kind in ("json", "jsonl"):
        writer.json(path)
    else:
        writer.csv(path, header=True, escape='"')


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table, or no rows of ``schema`` where the path does not exist or holds nothing."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], schema)
        raise


def append_log(rows: DataFrame, path: str, **stamps: str) -> None:
    """Append to a Parquet log with a time stamp and constant columns; nothing is read or rewritten."""
    rows.withColumns({"logged_at": F.current_timestamp(), **{k: F.lit(v) for k, v in stamps.items()}}).write.mode("append").parquet(path)


def canonical(df: DataFrame, aliases: dict[str, tuple[str, ...]] = ALIASES, label: str = "is_relevant") -> DataFrame:
    """Canonical columns from whichever alias is present, null where none is; the label as a whole number, 0 if unreadable."""
    present = {c.lower(): c for c in df.columns}
    chosen = {name: next((present[a] for a in names if a in present), None) for name, names in aliases.items()}
    columns = [(F.col(f"`{c}`") if c else F.lit(None).cast("string")).alias(name) for name, c in chosen.items()]
    out = df.select(*columns)
    return out.withColumn(label, F.coalesce(F.expr(f"try_cast(`{label}` AS int)"), F.lit(0))) if label in aliases else out


def class_label(label: Column, classes: int) -> Column:
    """Two classes: 1 from 1 on; more: clipped to 0 .. classes - 1."""
    return (label >= 1).cast("int") if classes == 2 else F.greatest(F.lit(0), F.least(F.lit(classes - 1), label.cast("int")))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of each file below a path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def sample_products(spark: SparkSession, n: int = 18) -> DataFrame:
    """A small deterministic product table for trials."""
    kinds = F.array(*map(F.lit, ("shoe", "coat", "bag", "shirt", "dress", "boot")))
    colors = F.array(*map(F.lit, ("black", "white", "red", "blue", "green")))
    i = F.col("id")
    kind, color = F.get(kinds, (i % 6).cast("int")), F.get(colors, (i % 5).cast("int"))
    return spark.range(n).select(i.alias("product_id"), F.concat_ws(" ", color, kind).alias("search_query"), F.concat_ws(" ", F.lit("classic"), color, kind).alias("product_name"), F.concat(F.lit("brand"), i % 3).alias("brand"), kind.alias("category"), color.alias("product_color"), F.lit("cotton").alias("product_material"), (i % 3).cast("int").alias("is_relevant"))
