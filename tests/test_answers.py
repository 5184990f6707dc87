"""Requests answered from state: replays over micro-batches, with repeats, late requests and a restart."""

import datetime as dt

from quillon.streaming.answers import answered
from quillon.streaming.windows import read_stream

SCHEMA = "request_id bigint, query string, ts timestamp"
START = dt.datetime(2024, 1, 1)


def scorer():
    # made inside a function, so that workers get it by value and need not import the tests
    return lambda texts: texts.str.len().astype("float64")


def replayed(batches, seconds=900):
    """What state answers, batch after batch; a query's requests of one batch in order of their time."""
    known, out = {}, []
    for batch in batches:
        for i, query, at in sorted(batch, key=lambda r: (r[2], r[0])):
            query = query or ""
            held = query in known and at < known[query] + seconds
            if not held:
                known[query] = at
            out.append((i, query, at, float(len(query)), held))
    return sorted(out)


BATCHES = [
    [(1, "shoe", 0), (2, "shoe", 899), (3, "red shoe", 5), (4, None, 7), (5, "shoe", 900)],
    # repeated and late requests: 7 was made before the score that answers it
    [(6, "shoe", 1500), (7, "shoe", 100), (8, "red shoe", 904), (9, "red shoe", 906)],
    [(10, "", 800), (11, "shoe", 1800), (12, "red shoe", 2000), (12, "red shoe", 2000), (13, "new", 50)],
]


def run(spark, folder, batches, name):
    """Streams the batches one by one from the folder; returns all answers so far."""
    # a stream that is to end with its input must not make batches without data, which times to live ask for
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    for n, batch in enumerate(batches):
        rows = [(i, q, START + dt.timedelta(seconds=at)) for i, q, at in batch]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = answered(read_stream(spark, f"{folder}/in", SCHEMA, 1), scorer())
        query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
        assert query.awaitTermination(120), name + str(n)
    rows = spark.read.parquet(f"{folder}/out").collect()
    return sorted((r.request_id, r.query, int((r.ts - START).total_seconds()), r.score, r.cached) for r in rows)


def test_replay_over_restarts_remembers_what_one_run_does(spark, tmp_path):
    assert run(spark, str(tmp_path), BATCHES, "replay") == replayed(BATCHES)


def test_a_table_is_one_batch(spark):
    rows = [(i, q, START + dt.timedelta(seconds=at)) for b in BATCHES for i, q, at in b]
    found = answered(spark.createDataFrame(rows, SCHEMA), scorer()).collect()
    assert sorted((r.request_id, r.query, int((r.ts - START).total_seconds()), r.score, r.cached) for r in found) == replayed([[r for b in BATCHES for r in b]])
    assert answered(spark.createDataFrame([], SCHEMA), scorer()).collect() == []
