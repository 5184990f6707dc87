"""Scored requests with remembered answers: repeats of a query within a time are answered from state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Seconds for which an answer is remembered.
REMEMBERED = 900
#: The state store that keeps values with a time to live.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_SETTING = "spark.sql.streaming.stateStore.providerClass"


class Answers(StatefulProcessor):
    """Per query the last score and the time of the request that it was worked out for.

    A request is answered from state if it was made less than ``seconds`` after
    that request; one that was made before it and comes late is too.  Other
    requests are scored, all that a query's rows of a batch need at once at
    most, and their score is remembered instead.  The store drops a value on its
    own once nobody has renewed it for that long.
    """

    def __init__(self, score: Callable[[pd.Series], pd.Series], seconds: int) -> None:
        self.score, self.seconds = score, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "at bigint, score double", self.seconds * 1000)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["at", "request_id"], kind="stable")
        at, value = self.known.get() if self.known.exists() else (None, None)
        fresh, scores, cached = None, [], []
        for made in batch["at"].tolist():
            held = at is not None and made < at + self.seconds * 1_000_000
            if not held:
                # a query has one score, however often it has to be worked out
                fresh = float(self.score(pd.Series([key[0]])).iloc[0]) if fresh is None else fresh
                at, value = made, fresh
            scores.append(value)
            cached.append(held)
        if not all(cached):
            self.known.update((at, value))
        yield pd.DataFrame({"request_id": batch["request_id"].to_numpy(), "query": [key[0]] * len(batch), "at": batch["at"].to_numpy(), "score": scores, "cached": cached})

    def close(self) -> None:
        pass


def answered(requests: DataFrame, score: Callable[[pd.Series], pd.Series], request_id: str = "request_id", query: str = "query", ts: str = "ts", seconds: int = REMEMBERED) -> DataFrame:
    """(request_id, query, ts, score, cached) of a stream of requests, or of a table of them as one batch.

    ``score`` takes a series of texts and runs in the tasks.  Requests of one
    query are in order of their time within a batch, and batches follow each
    other; so the answers depend on how late requests come, the scores do not.
    Null queries are one query.  State holds one value per query asked within
    the time, in the store that ``PROVIDER`` names; the session keeps that
    setting, as the plan runs later.  A stream that is to end with its input
    needs ``spark.sql.streaming.noDataMicroBatches.enabled`` off, as times to
    live ask for batches without data.
    """
    spark = requests.sparkSession
    spark.conf.set(PROVIDER_SETTING, PROVIDER)
    # a table as one batch needs the coordinator of state stores, which the manager of streams starts
    spark.streams.active  # noqa: B018
    rows = requests.select(F.col(request_id).cast("bigint").alias("request_id"), F.coalesce(F.col(query), F.lit("")).alias("query"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"))
    found = rows.groupBy("query").transformWithStateInPandas(Answers(score, seconds), "request_id bigint, query string, at bigint, score double, cached boolean", "Append", "ProcessingTime")
    return found.select("request_id", "query", F.timestamp_micros("at").alias("ts"), "score", "cached")
