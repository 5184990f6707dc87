"""Exact top-k inner products by no-random-access aggregation.

Every component is a sorted list of the candidates.  A query reads all lists in
step, from the top where its own component is positive and from the bottom
where it is negative.  What is read so far bounds each candidate's score: an
unread component can add no more than the list's current value, and no less
than its last one.  Candidates whose upper bound falls below the k-th best lower
bound are dropped as the reading goes on; it stops once few are left, whose
scores are then resolved.  Lists that are read to their ends bound a score by
itself, so reading always decides.

Candidates come in blocks, and the lists are sorted within a block.  The k-th
best score that a query has found in earlier blocks also bounds what a later
block must offer.  Bounds of many queries and candidates are matrix products, as
an unread component's bound is the component clipped at the list's current
value.  Reading of a block pauses first where the block before was decided.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Candidates of a block, and queries that meet a block together.
BLOCK, QUERIES = 4096, 1024
#: Blocks that one task streams past one group of queries.
STREAM = 64
#: Pauses at which bounds are drawn: after each of so many equal parts of a list.
STEPS = 16
#: Queries whose bounds are drawn together, and candidates of a query that are resolved instead of read on.
TOGETHER, OPEN = 256, 256
#: Integers of this size or more, and sums of this size or more, are computed as Python integers.
LARGE, EXACT = 1 << 20, 1 << 53
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def _packed(name: str):
    """Rows (id, x, size, block) sorted by size and block: one row (size, block, ids, vectors) each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def row() -> pa.RecordBatch:
            ids, x = (np.concatenate(v) for v in zip(*held, strict=True))
            # single precision holds these integers exactly
            x = x.astype(np.float32) if np.abs(x).max() <= 1 << 24 else x
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int64()), pa.array([ids.astype(np.int64).tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())], names=["size", name, "ids", "x"])

        for batch in batches:
            size, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("size", name))
            ids, x = batch.column("id").to_numpy(zero_copy_only=False), batch.column("x").flatten().to_numpy(zero_copy_only=False)
            ends = np.append(0, np.cumsum(size))
            first = np.flatnonzero(np.append(True, (size[1:] != size[:-1]) | (block[1:] != block[:-1]))) if len(size) else []
            for a, b in zip(first, [*first[1:], len(size)], strict=True):
                key = int(size[a]), int(block[a])
                if key != now:
                    if held:
                        yield row()
                    now, held = key, []
                held.append((ids[a:b], x[ends[a] : ends[b]]))
        if held:
            yield row()

    return pack


def _unpacked(ids: bytes, x: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(x, np.float32 if len(x) == 4 * size * len(ids) else np.float64).reshape(-1, size)


class Block:
    """Candidates with their sorted lists, ready to be read in step."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.lists = np.sort(self.x, axis=0)
        self.bounds: dict[tuple[int, str], tuple[np.ndarray, np.ndarray]] = {}

    def read(self, step: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """What bounds components after ``step`` parts of each list: upper and lower bounds, for lists read from the top and from the bottom."""
        key = step, np.dtype(kind).char
        if key not in self.bounds:
            n = len(self.ids)
            at = min(n - 1, step * n // STEPS)
            x, lists = self.x.astype(kind), self.lists.astype(kind)
            top, low = lists[n - 1 - at], lists[at]
            upper = np.concatenate([np.maximum(x, top), np.minimum(x, low)], axis=1)
            # an unread component may be as bad as the other end of its list
            lower = np.concatenate([np.where(x >= top, x, lists[0]), np.where(x <= low, x, lists[-1])], axis=1)
            self.bounds = {key: (upper, lower)}
        return self.bounds[key]


class Search:
    """The best ``k`` candidates so far of a group of queries."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int) -> None:
        self.ids, self.q, self.k = ids, q, k
        self.signed = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1)
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
        self.least = np.full(len(ids), -np.inf)
        self.start = 1
        #: Per query the parts of lists read and the candidates resolved, over all blocks.
        self.parts, self.resolved, self.met = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), 0

    def meet(self, block: Block) -> None:
        self.met += len(block.ids)
        largest = max(1.0, float(np.abs(self.q).max())) * max(1.0, float(np.abs(block.x).max())) * self.q.shape[1]
        if largest >= EXACT:
            self._meet_exactly(block)
            return
        kind = np.float32 if largest < 1 << 24 else np.float64
        decided = []
        for a in range(0, len(self.ids), TOGETHER):
            decided.append(self._read(block, np.arange(a, min(len(self.ids), a + TOGETHER)), kind))
        self.start = max(1, min(decided) - 1)

    def _read(self, block: Block, todo: np.ndarray, kind: type) -> int:
        """Read the lists for the queries ``todo``; the step at which most of them were decided."""
        n, signed = len(block.ids), self.signed.astype(kind)
        half = signed.shape[1] // 2
        # heads of the lists bound all that the block has
        heads = signed[todo, :half] @ block.lists[-1].astype(kind) + signed[todo, half:] @ block.lists[0].astype(kind)
        todo = todo[heads >= self.least[todo]]
        begun, median = len(todo), 1
        alive: np.ndarray | None = None
        for step in range(self.start, STEPS + 1):
            if not len(todo):
                break
            upper, lower = block.read(step, kind)
            own = self.ids[todo][:, None] == block.ids[None, :]
            low = signed[todo] @ lower.T
            low[own] = -np.inf
            at_least = np.maximum(self.least[todo], np.partition(low, n - self.k, axis=1)[:, n - self.k] if n > self.k else -np.inf)
            may = (signed[todo] @ upper.T >= at_least[:, None]) & ~own
            alive = may if alive is None else may & alive
            few = alive.sum(axis=1) <= (OPEN if step < STEPS else n)
            for row in np.flatnonzero(few):
                at = np.flatnonzero(alive[row])
                self.parts[todo[row]] += step * n
                self.resolved[todo[row]] += len(at)
                self.keep(todo[row], block.ids[at], block.x[at].astype(kind) @ self.q[todo[row]].astype(kind))
            todo, alive = todo[~few], alive[~few]
            median = step if len(todo) * 2 >= begun else median
        return median

    def _meet_exactly(self, block: Block) -> None:
        """Scores beyond exact floating point, as Python integers."""
        x = np.array([[int(v) for v in row] for row in block.x.tolist()], object)
        for query, q in enumerate(self.q.tolist()):
            score = [min(HIGHEST, max(LOWEST, v)) for v in (x @ np.array([int(v) for v in q], object)).tolist()]
            self.parts[query] += STEPS * len(x)
            self.resolved[query] += len(x)
            self.keep(query, block.ids, np.array(score, np.int64))

    def keep(self, query: int, ids: np.ndarray, score: np.ndarray) -> None:
        other = ids != self.ids[query]
        ids, score = np.append(self.found[query][0], ids[other]), np.append(self.found[query][1], score[other].astype(np.int64))
        best = np.lexsort((ids, ~score))[: self.k]
        self.found[query] = ids[best], score[best]
        if len(best) == self.k:
            self.least[query] = score[best[-1]]


RESULT = "query_id bigint, vec_id bigint, score bigint, parts bigint, resolved bigint, met bigint"


def _searched(k: int):
    """Rows (size, qblock, stream, role, ids, x), sorted: the queries of a group, then its candidate blocks."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def result() -> pa.RecordBatch:
            n = [len(ids) for ids, _ in state.found]
            columns = [np.repeat(state.ids, n), *(np.concatenate([f[i] for f in state.found]) for i in (0, 1)), np.repeat(state.parts, n), np.repeat(state.resolved, n), np.full(sum(n), state.met)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score", "parts", "resolved", "met"])

        for batch in batches:
            for size, qblock, stream, role, ids, x in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if (size, qblock, stream) != now:
                    if state:
                        yield result()
                    now, state = (size, qblock, stream), None
                ids, x = _unpacked(ids, x, size)
                if role == 0:
                    state = Search(ids, x, k)
                elif state:
                    state.meet(Block(ids, x))
        if state:
            yield result()

    return search


def search(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each query and stream of candidate blocks its ``k`` best: query_id, vec_id, score and what reading took.

    ``parts`` / (16 * ``met``) is the share of its lists that the query read,
    ``resolved`` the number of candidates whose scores were resolved, of ``met``.
    """
    spark = vectors.sparkSession
    x = F.transform(F.col(vector_col), lambda v: F.rint(F.floor(F.lit(scale) * v.cast("double")).cast("double")))
    # beyond 2**52 every double is an integer, and floor() would not hold it
    x = F.zip_with(x, F.col(vector_col), lambda a, v: F.when(F.abs(F.lit(scale) * v.cast("double")) < float(1 << 52), a).otherwise(F.lit(scale) * v.cast("double")))
    whole = F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & F.forall(F.col(vector_col), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(F.lit(scale) * v.cast("double")) < float("inf")))
    rows = vectors.where(whole & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), x.alias("x"), F.size(vector_col).alias("size"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = common.written(rows, "vectors")
    # L different lengths take L * L / 2 components at least, so this table is tiny beside the vectors
    shape = common.written(rows.groupBy("size").agg(F.count("*").alias("n"), F.count_if("asks").alias("q")), "vector-lengths")
    counts = shape.select("size", F.ceil(F.col("n") / BLOCK).alias("n_c"), F.greatest(F.lit(1), F.ceil(F.col("q") / QUERIES)).alias("n_q"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    large = F.exists("x", lambda v: F.abs(v) >= LARGE)

    def blocks(df: DataFrame, name: str, n: str) -> DataFrame:
        """Packed blocks; vectors of large integers are blocks of their own, numbered after the others."""
        dealt = df.join(F.broadcast(counts), "size").withColumn(name, F.pmod(F.xxhash64("id", "x"), F.col(n)) + F.when(large, F.col(n)).otherwise(0))
        ordered = dealt.select("size", name, "id", "x").repartition(parts, "size", name).sortWithinPartitions("size", name)
        return common.written(ordered.mapInArrow(_packed(name), f"size int, {name} bigint, ids binary, x binary"), name)

    candidates = blocks(rows.select("id", "x", "size"), "cblock", "n_c")
    queries = blocks(rows.where("asks").select("id", "x", "size").distinct(), "qblock", "n_q")

    # each group of queries meets each stream of blocks in one task
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), (n - 1).cast("bigint"))
    asked = queries.join(F.broadcast(counts), "size").select("size", "qblock", F.explode(upto(F.ceil(2 * F.col("n_c") / STREAM))).alias("stream"), F.lit(0).alias("role"), "ids", "x")
    groups = queries.select("size", "qblock").groupBy("size").agg(F.collect_set("qblock").alias("groups"))
    read = candidates.join(F.broadcast(groups), "size").select("size", F.explode("groups").alias("qblock"), F.floor(F.col("cblock") / STREAM).alias("stream"), F.lit(1).alias("role"), "ids", "x")
    dealt = asked.union(read).repartition(parts, "size", "qblock", "stream").sortWithinPartitions("size", "qblock", "stream", "role")
    return dealt.mapInArrow(_searched(k), RESULT)


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` highest integer inner products of each query: query_id, rank, vec_id, score.

    Components become floor(``scale`` * x).  Queries are the rows where
    ``is_query`` holds; candidates are all rows but those of the query's id.
    Ties go to the smaller id.  A vector that is null, empty or holds a null or
    non-finite component takes no part, nor does a null id; vectors of different
    lengths do not meet.  Rows that repeat an id and vector count once each as
    candidates, and once as a query.  Scores beyond a long's range are given as
    the nearest long, and tie.  Other columns are never read; an empty table
    gives an empty result.
    """
    found = search(vectors, is_query, k, scale, id_col, vector_col)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    kind = vectors.schema[id_col].dataType
    return ranked.select(F.col("query_id").cast(kind).alias("query_id"), "rank", F.col("vec_id").cast(kind).alias("vec_id"), "score")
