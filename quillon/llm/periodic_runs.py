"""Periodic runs of words: an all-lag scan of word-id arrays.

The words of a group of texts are one array of ids.  For every lag up to a
text's length over the least exponent the array is compared with itself shifted
by the lag; a stretch of equal places that is long enough is a run.  A stretch
of three lags spans four places a quarter of it apart, so each lag is first
compared at those places alone and word by word only where four in a row agree:
no stretch is missed, and all lags of n words take about n log n comparisons.

A text of more than ``long_bytes`` is not scanned by one task: Spark deals its
ranges of lags to tasks and gathers the runs that each of them finds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Bytes of text of which words are held as one array.
GROUP = 1 << 22
#: Bytes of a text from which on its lags are dealt to several tasks.
LONG = 1 << 23
#: Lags of a range of a long text; ranges of small lags, which cost more, hold fewer.
RANGE = 1 << 16

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def true_stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end place of each stretch of ``least`` true places or more."""
    places = np.flatnonzero(equal)
    if len(places) < least:
        return places[:0], places[:0]
    cuts = np.flatnonzero(places[1:] != places[:-1] + 1)
    first, last = places[np.append(0, cuts + 1)], places[np.append(cuts, len(places) - 1)] + 1
    held = last - first >= least
    return first[held], last[held]


class Scan:
    """The runs of one array of word ids.

    ``words`` holds texts one after another, each followed by an id that occurs
    once, so that no stretch reaches over the end of a text.  ``runs`` maps the
    (first, end) of each run found to its smallest period.
    """

    def __init__(self, words: np.ndarray, least_words: int, exponent: int) -> None:
        self.words, self.least_words, self.exponent = words, least_words, exponent
        self.runs: dict[tuple[int, int], int] = {}
        self.first, self.last, self.period = (np.zeros(64, np.int64) for _ in range(3))
        #: Number of a run that covers a place, 0 for none.
        self.cover = np.zeros(len(words) + 1, np.int32)

    def lag(self, lag: int, length: int) -> None:
        """Take the runs of ``lag`` among the first ``length`` words."""
        least = max(self.least_words - lag, (self.exponent - 1) * lag)
        n = length - lag
        if n < least:
            return
        here, there = self.words[:n], self.words[lag:length]
        step = max(1, least // 4)
        first, last = true_stretches(here[::step] == there[::step], least // step)
        if step == 1:
            for a, b in zip(first.tolist(), last.tolist(), strict=True):
                self._add(a, b + lag, lag)
            return
        if not len(first):
            return
        # a run of a smaller period shows up at its multiples again, as the same places
        run = self.cover[first * step]
        begin, end, period = self.first[run], self.last[run], self.period[run]
        known = (run > 0) & (first == -(-begin // step)) & (last - 1 == (end - lag - 1) // step)
        known &= lag % np.maximum(period, 1) == 0
        for a, b in zip(first[~known].tolist(), last[~known].tolist(), strict=True):
            low, high = max(0, (a - 1) * step + 1), min(n, b * step)
            for x, y in zip(*true_stretches(here[low:high] == there[low:high], least), strict=True):
                self._add(low + int(x), low + int(y) + lag, lag)

    def _add(self, first: int, last: int, lag: int) -> None:
        if (first, last) in self.runs:
            return
        # a shorter period of a stretch of two lags divides the lag
        part = self.words[first:last]
        period = next(d for d in _divisors(lag) if np.array_equal(part[d:], part[:-d]))
        self.runs[first, last] = period
        n = len(self.runs)
        if n == len(self.first):
            self.first, self.last, self.period = (np.append(x, np.zeros_like(x)) for x in (self.first, self.last, self.period))
        self.first[n], self.last[n], self.period[n] = first, last, period
        self.cover[first:last] = n


def _divisors(n: int) -> list[int]:
    low = [d for d in range(1, int(n**0.5) + 1) if n % d == 0]
    return low + [n // d for d in reversed(low) if d * d != n]


def runs_of(texts: list[list[bytes]], least_words: int = 6, exponent: int = 4, lags: tuple[int, int] | None = None) -> list[list[tuple[int, int, int]]]:
    """For each text, given as its words, its runs as (start, length, period) in order; of the periods in ``lags`` only, if given."""
    ident = {w: n for n, w in enumerate(set(chain.from_iterable(texts)))}
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) for i in order], np.int64)
    ends = np.cumsum(sizes + 1)
    words = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
    for i, end, size in zip(order, ends.tolist(), sizes.tolist(), strict=True):
        words[end - 1 - size : end - 1] = np.fromiter(map(ident.__getitem__, texts[i]), np.int32, size)
    words[ends - 1] = -1 - np.arange(len(ends))
    scan = Scan(words, least_words, exponent)
    first, last = lags or (1, int(sizes[0]) // exponent if len(sizes) else 0)
    shortest = -sizes
    for lag in range(first, min(last, int(sizes[0]) // exponent if len(sizes) else 0) + 1):
        # the texts that are long enough for the lag come first
        held = int(np.searchsorted(shortest, -max(least_words, exponent * lag), side="right"))
        if not held:
            break
        scan.lag(lag, int(ends[held - 1]))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    starts = ends - 1 - sizes
    for (a, b), period in scan.runs.items():
        at = int(np.searchsorted(ends, a, side="right"))
        found[order[at]].append((a - int(starts[at]), b - a, period))
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, each run left with its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join(compress(words, keep.tolist()))


def _words(text: str | None) -> list[bytes]:
    # splitting bytes cuts at 0x20 and 0x09 to 0x0D, and at nothing else
    return text.encode().split() if text else []


def _batch(ids: pa.Array, texts: list[list[bytes]], runs: list[list[tuple[int, int, int]]], names: list[str]) -> pa.RecordBatch:
    flat = [dict(zip(("start", "length", "period"), r, strict=True)) for one in runs for r in one]
    listed = pa.ListArray.from_arrays(np.append(0, np.cumsum([len(r) for r in runs])).astype(np.int32), pa.array(flat, _RUN))
    texts_out = pa.array([collapsed(w, r).decode() for w, r in zip(texts, runs, strict=True)], pa.string())
    return pa.RecordBatch.from_arrays([ids, pa.array([len(w) for w in texts], pa.int64()), listed, texts_out], names=names)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 6, exponent: int = 4, long_bytes: int = LONG, range_lags: int = RANGE) -> DataFrame:
    """(id, n_words, runs, collapsed): the runs of every row's whole text, and the text with each run cut to its first period.

    A run is a stretch of consecutive words with smallest period q and at least
    max(``least_words``, ``exponent`` * q) words that no neighbouring word
    extends; words are what white space (0x20, 0x09 to 0x0D) parts, compared
    as they stand.  ``runs`` is in order of start, then period; runs may overlap.
    ``collapsed`` has all kept words joined by one space.

    Null and empty texts have no words, no runs and an empty ``collapsed``; an
    empty table gives an empty result.  Repeated rows give a row each; a null
    id stays null.  Other columns are not read.  Texts of any length are
    scanned whole; one beyond ``long_bytes`` by ranges of ``range_lags`` lags in
    several tasks.
    """
    if exponent < 2:
        raise ValueError("the exponent of a run is 2 at least")
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema[id_col].dataType)
    names = [id_col, "n_words", "runs", "collapsed"]
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_words bigint, runs {RUNS}, collapsed string"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in common.text_groups(batches, GROUP):
            texts = [_words(t) for t in group.column("text").to_pylist()]
            yield _batch(group.column("id").cast(kind), texts, runs_of(texts, least_words, exponent), names)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, text, first, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                (runs,) = runs_of([_words(text)], least_words, exponent, (first, last))
                columns = [pa.array([digest] * len(runs), pa.string()), *(pa.array([r[i] for r in runs], pa.int64()) for i in range(3))]
                yield pa.RecordBatch.from_arrays(columns, names=["digest", "start", "length", "period"])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in common.text_groups(batches, GROUP):
            texts = [_words(t) for t in group.column("text").to_pylist()]
            runs = [[(r["start"], r["length"], r["period"]) for r in one or []] for one in group.column("runs").to_pylist()]
            yield _batch(group.column("id").cast(kind), texts, runs, names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    short = rows.where(size <= long_bytes).mapInArrow(whole, schema)

    long = rows.where(size > long_bytes).withColumn("digest", F.sha2("text", 256))
    # a word and the space after it take two bytes at least
    most = ((F.octet_length("text") + 1) / (2 * exponent)).cast("bigint")
    small = [8**i for i in range(8) if 8**i < range_lags]
    starts = F.concat(F.array(*(F.lit(x).cast("bigint") for x in small)), F.when(most >= range_lags, F.sequence(F.lit(range_lags).cast("bigint"), most, F.lit(range_lags).cast("bigint"))).otherwise(F.array().cast("array<bigint>")))
    dealt = long.select("digest", "text").dropDuplicates(["digest"]).select("digest", "text", F.explode(starts).alias("first"))
    ended = dealt.withColumn("last", F.when(F.col("first") < range_lags, F.least(F.col("first") * 8, F.lit(range_lags)) - 1).otherwise(F.col("first") + range_lags - 1))
    found = ended.repartition(F.xxhash64("digest", "first")).select("digest", "text", "first", "last").mapInArrow(ranges, "digest string, start bigint, length bigint, period bigint")
    gathered = found.groupBy("digest").agg(F.collect_set(F.struct("start", "length", "period")).alias("runs"))
    in_order = F.array_sort("runs", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(a["period"] < b["period"], -1).otherwise(F.when(a["period"] > b["period"], 1).otherwise(0)))
    return short.unionByName(long.join(gathered, "digest", "left").select("id", "text", in_order.alias("runs")).mapInArrow(finished, schema))
