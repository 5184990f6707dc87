"""The streaming extension gives what the batch form gives."""

from pyspark.sql import functions as F

from quillon.sources.tables import append_log, canonical, read_or_empty, read_table, sample_products, write_table
from quillon.streaming.windows import read_stream, score_stream


def test_scored_stream_matches_batch(spark, tmp_path):
    rows = spark.range(40).selectExpr("id", "CAST(id % 10 AS double) / 10 AS x")
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path / "in"), rows.schema, 1)
    query = score_stream(stream, lambda b: b.withColumn("y", F.col("x") * 2), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert query.awaitTermination(60)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 40
    assert out.where("y <> x * 2").count() == 0


def test_tables_round_trip(spark, tmp_path):
    rows = sample_products(spark)
    for kind in ("parquet", "orc", "csv", "json"):
        path = str(tmp_path / f"t.{kind}")
        write_table(rows, path)
        assert read_table(spark, path).count() == 18
    assert read_or_empty(spark, str(tmp_path / "none.parquet"), "a int").count() == 0
    append_log(rows.limit(2), str(tmp_path / "log"), run="a")
    append_log(rows.limit(2), str(tmp_path / "log"), run="b")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4


def test_canonical_columns(spark):
    df = spark.createDataFrame([("1", "q", "2"), ("2", "r", "x")], "item_id string, query string, label string")
    rows = canonical(df).orderBy("product_id").collect()
    assert [(r.product_id, r.search_query, r.brand, r.is_relevant) for r in rows] == [("1", "q", None, 2), ("2", "r", None, 0)]
