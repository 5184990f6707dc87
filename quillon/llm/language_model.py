"""A hashed maximum-entropy language model with a class-factored softmax.

P(word | context) = P(class | context) * P(word | class).  The most frequent
words are classes of their own; every other word belongs to the class of its
ending.  Endings are grouped into classes by the company they keep: the counts
of neighbouring endings over all training texts give each ending a few
coordinates, and endings with like coordinates share a class.  Within a class
the word follows its smoothed count, with one share for all unknown words.  The
class comes from a softmax over hashed features of the context: the word before,
the classes of the two words before, and skip features, the word two before and
the classes three and four before.

All counts are taken over all training texts.  They give the softmax its first
weights; then tasks run stochastic gradient steps on their own texts and their
updates are averaged, weighted by tokens, round after round.  Words and counts
are unlimited; the hash buckets of a feature grow with the square root of the
training tokens, and the tokens of a training task with the buckets, so that the
tables which tasks send stay in a fixed proportion to the input.

Words cross the network as packed arrays: each block of texts sends one row per
range of word hashes, ranges are summed with numpy, and each block gets back one
array of counts in the order of its own words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .words import hashed_words, mix, word_endings

#: Bytes of text whose distinct words share one table row.
BLOCK_BYTES = 4 << 20
#: Bytes of text that are hashed at one time; each takes about 60 bytes of memory meanwhile.
HASH_BYTES = 1 << 19
#: Classes that are one frequent word each, and classes of word endings; kinds of endings, and coordinates of each.
SINGLE, GROUPS, ENDINGS, AXES = 32, 32, 512, 12
CLASSES = SINGLE + GROUPS
#: The features: (kind, places back).
FEATURES = (("word", (1,)), ("class", (1, 2)), ("word", (2,)), ("class", (3, 4)))
#: Buckets per feature at least; tokens of a training task per bucket.
LEAST_BUCKETS, BUCKET_TOKENS = 1024, 1024
#: Distinct (block, word) pairs per task that sums them, and word ranges at least and at most.
RANGE_PAIRS, LEAST_RANGES, MOST_RANGES = 4_000_000, 64, 4096
#: The end of a text, in place of a word's hash; and the class that stands before a text.
END = np.uint64(0x9D5C_F3A1_77E0_0B1D)
#: Additive smoothing of word counts.
SMOOTH = 0.1
#: Weight of the count-based start and its smoothing; rounds of gradient updates, their step size, and the tokens at which a bucket takes half a step.
START, START_SMOOTH, ROUNDS, STEP, HOLD = 0.45, 20.0, 1, 1.0, 40.0
#: Tokens per gradient step and per scored batch.
BATCH = 1 << 12
_SEGMENTS = 64

#: Columns of a block of texts, before its ids.
BLOCK = [*(T.StructField(n, T.LongType()) for n in ("block", "tokens", "learned")), *(T.StructField(n, T.BinaryType()) for n in ("words", "endings", "at", "counts", "learns"))]


def bucket_count(tokens: int) -> int:
    """Hash buckets of a feature: a power of two near a quarter of the square root of the training tokens."""
    return max(LEAST_BUCKETS, 1 << (max(1, int(tokens**0.5 / 4)) - 1).bit_length())


@dataclass(frozen=True)
class Vocabulary:
    """Hashes of the single-word classes by falling count, the class of each ending, and per class its tokens and distinct words in training."""

    single: np.ndarray
    group: np.ndarray
    tokens: np.ndarray
    distinct: np.ndarray

    def classes(self, words: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = (SINGLE + self.group[endings]).astype(np.uint8)
        if len(self.single):
            order = np.argsort(self.single)
            at = np.minimum(np.searchsorted(self.single[order], words), len(order) - 1)
            known = self.single[order][at] == words
            out[known] = order[at[known]]
        return out


def _blocks(id_type: pa.DataType):
    """Texts as rows of distinct word hashes, in order, and token places; the end of each text is its last token."""

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = common.task_number() << 32
        for group in common.text_groups(batches, BLOCK_BYTES):
            words, endings, counts = [], [], []
            for part in common.text_groups([group], HASH_BYTES):
                h, n = hashed_words(part.column("text"))
                e = word_endings(part.column("text"), ENDINGS)
                stop = np.cumsum(n)
                words.append(np.insert(h, stop, END))
                endings.append(np.insert(e, stop, 0))
                counts.append(n + 1)
            flat, n = np.concatenate(words), np.concatenate(counts)
            distinct, first, at = np.unique(flat, return_index=True, return_inverse=True)
            learns = group.column("learns").to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block]),
                    pa.array([len(flat)]),
                    pa.array([int(n[learns].sum())]),
                    *(pa.array([x.tobytes()], pa.binary()) for x in (distinct, np.concatenate(endings)[first].astype(np.uint16), at.astype(np.uint32), n.astype(np.uint32), learns)),
                    pa.array([group.column("id").to_pylist()], pa.list_(id_type)),
                ],
                names=["block", "tokens", "learned", "words", "endings", "at", "counts", "learns", "ids"],
            )
            block += 1

    return tokenised


def _rows(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    """Rows one by one; binary values as views of the batch."""
    for batch in batches:
        held = [batch.column(c) for c in columns]
        for i in range(batch.num_rows):
            yield tuple((v.as_buffer() or b"") if pa.types.is_binary(v.type) else v.as_py() for v in (c[i] for c in held))


def _sliced(words: np.ndarray, ranges: int) -> list[tuple[int, int, int]]:
    """Of sorted word hashes: (range, first, end) of each range that has words."""
    bounds = np.searchsorted(words, np.arange(1, ranges, dtype=np.uint64) * np.uint64((1 << 64) // ranges))
    ends = [0, *bounds.tolist(), len(words)]
    return [(r, ends[r], ends[r + 1]) for r in range(ranges) if ends[r + 1] > ends[r]]


def _sent(ranges: int, salts: int):
    """(range, salt, words, endings, n): the training words of a block with their counts, packed."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, words, endings, at, counts, learns in _rows(batches, ("block", "words", "endings", "at", "counts", "learns")):
            words, endings = np.frombuffer(words, np.uint64), np.frombuffer(endings, np.uint16)
            learned = np.repeat(np.frombuffer(learns, bool), np.frombuffer(counts, np.uint32))
            n = np.bincount(np.frombuffer(at, np.uint32)[learned], minlength=len(words)).astype(np.int64)
            seen = n > 0
            yield _packed(words[seen], endings[seen], n[seen], ranges, salt=int(mix(np.array([block], np.uint64))[0]) % salts)

    return send


def _packed(words: np.ndarray, endings: np.ndarray, n: np.ndarray, ranges: int, salt: int) -> pa.RecordBatch:
    cut = _sliced(words, ranges)
    return pa.RecordBatch.from_arrays(
        [pa.array([r for r, _, _ in cut], pa.int32()), pa.array([salt] * len(cut), pa.int32()), *(pa.array([x[a:b].tobytes() for _, a, b in cut], pa.binary()) for x in (words, endings, n))],
        names=["range", "salt", "words", "endings", "n"],
    )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by range and salt: one row each, with every word once and its counts summed."""
    now: tuple[int, int] | None = None
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def fold() -> None:
        words, endings, n = (np.concatenate(x) for x in zip(*held, strict=True))
        distinct, first, back = np.unique(words, return_index=True, return_inverse=True)
        held[:] = [(distinct, endings[first], np.bincount(back, n, len(distinct)).astype(np.int64))]

    def row() -> pa.RecordBatch:
        fold()
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in held[0])], names=["range", "salt", "words", "endings", "n"])

    for r, salt, words, endings, n in _rows(batches, ("range", "salt", "words", "endings", "n")):
        if (r, salt) != now:
            if held:
                yield row()
            now, held, size = (r, salt), [], 0
        held.append((np.frombuffer(words, np.uint64), np.frombuffer(endings, np.uint16), np.frombuffer(n, np.int64)))
        size += len(held[-1][0])
        if size > 2 * max(RANGE_PAIRS // 4, len(held[0][0])):
            fold()
            size = len(held[0][0])
    if held:
        yield row()


def count_words(blocks: DataFrame, ranges: int, salts: int) -> DataFrame:
    """(range, words, endings, n): all training words of each range of hashes with their counts, packed."""
    fields, parts = "range int, salt int, words binary, endings binary, n binary", int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = blocks.select("block", "words", "endings", "at", "counts", "learns").mapInArrow(_sent(ranges, salts), fields)
    for keys in (["range", "salt"], ["range"]) if salts > 1 else (["range"],):
        sent = sent.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(_merged, fields)
        sent = sent.withColumn("salt", F.lit(0))
    return sent.select("range", "words", "endings", "n")


def _asked(ranges: int, salts: int):
    """(range, salt, role, block, words): the distinct words of a block, packed."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, words in _rows(batches, ("block", "words")):
            words = np.frombuffer(words, np.uint64)
            cut = _sliced(words, ranges)
            salt = int(mix(np.array([block], np.uint64))[0]) % salts
            yield pa.RecordBatch.from_arrays(
                [pa.array([r for r, _, _ in cut], pa.int32()), pa.array([salt] * len(cut), pa.int32()), pa.array([1] * len(cut), pa.int32()), pa.array([block] * len(cut), pa.int64()), pa.array([words[a:b].tobytes() for _, a, b in cut], pa.binary()), pa.array([None] * len(cut), pa.binary())],
                names=["range", "salt", "role", "block", "words", "n"],
            )

    return ask


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by range, salt and role, the range's table first: (block, range, c), counts in the order of the block's words."""
    now, known, n = None, None, None
    for r, salt, role, block, words, counts in _rows(batches, ("range", "salt", "role", "block", "words", "n")):
        words = np.frombuffer(words, np.uint64)
        if (r, salt) != now:
            now, known = (r, salt), None
        if not role:
            known, n = words, np.frombuffer(counts, np.int64)
            continue
        c = np.zeros(len(words), np.int64)
        if known is not None:
            at = np.minimum(np.searchsorted(known, words), len(known) - 1)
            c = np.where(known[at] == words, n[at], 0)
        # counts of small blocks and rare words are short
        wide = c.max() >= 1 << 16
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([r], pa.int32()), pa.array([bool(wide)]), pa.array([c.astype(np.int64 if wide else np.uint16).tobytes()], pa.binary())], names=["block", "range", "wide", "c"])


def block_counts(blocks: DataFrame, tables: DataFrame, ranges: int, salts: int) -> DataFrame:
    """(block, found): the training counts of a block's words, as an array of (range, wide, c) by range."""
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = "range int, salt int, role int, block bigint, words binary, n binary"
    own = blocks.select("block", "words").mapInArrow(_asked(ranges, salts), fields)
    dealt = tables.select("range", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("role"), F.lit(None).cast("bigint").alias("block"), "words", "n")
    both = own.union(dealt).repartition(parts, "range", "salt").sortWithinPartitions("range", "salt", "role")
    answers = both.mapInArrow(_answered, "block bigint, range int, wide boolean, c binary")
    return answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("range", "wide", "c"))).alias("found"))


def contexts(cls: np.ndarray, word: np.ndarray, counts: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Per feature each token's bucket; places before a text have a mark of their own."""
    place = np.arange(len(cls)) - np.repeat(np.cumsum(counts) - counts, counts)
    bucket = (mix(word, 5) % np.uint64(buckets)).astype(np.int32)

    def back(x: np.ndarray, n: int, mark: int) -> np.ndarray:
        out = np.full(len(x), mark, np.int32)
        if n < len(x):
            out[n:] = x[:-n]
        out[place < n] = mark
        return out

    found = []
    for kind, places in FEATURES:
        if kind == "word":
            found.append(back(bucket, places[0], 0))
        else:
            key = np.zeros(len(cls), np.int32)
            for n in places:
                key = key * (CLASSES + 1) + back(cls, n, CLASSES)
            found.append((mix(key.astype(np.uint64), 9) % np.uint64(buckets)).astype(np.int32))
    return found


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each block the words and endings, and the places and text lengths of its training texts."""
    for words, endings, at, counts, learns in _rows(batches, ("words", "endings", "at", "counts", "learns")):
        words, at, counts = np.frombuffer(words, np.uint64), np.frombuffer(at, np.uint32), np.frombuffer(counts, np.uint32).astype(np.int64)
        keep = np.frombuffer(learns, bool)
        if not keep.all():
            at, counts = at[np.repeat(keep, counts)], counts[keep]
        if len(at):
            yield words, np.frombuffer(endings, np.uint16), at, counts


def _training(vocabulary: Vocabulary, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Classes and features of the training tokens of each block."""
    for words, endings, at, counts in _learned(batches):
        cls = vocabulary.classes(words, endings)[at]
        yield cls, contexts(cls, words[at], counts, buckets)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each ending follows each other one within a text."""
    table = np.zeros(ENDINGS * ENDINGS, np.int64)
    for _, endings, at, counts in _learned(batches):
        e = endings[at].astype(np.int64)
        inner = np.ones(len(e), bool)
        inner[np.cumsum(counts) - counts] = False
        inner[np.cumsum(counts) - 1] = False
        table += np.bincount((e[:-1] * ENDINGS + e[1:])[inner[1:]], minlength=len(table))
    yield from _segments(table, 1.0, np.int32)


def grouped_endings(pairs: np.ndarray) -> np.ndarray:
    """A class from 0 to GROUPS - 1 for each ending, from the counts of neighbouring endings.

    Coordinates are the leading eigenvectors of the counts, scaled by frequency;
    centres start far apart and are refined a few times.  Ties go to the lower
    number, so equal counts give equal classes.
    """
    both = pairs + pairs.T
    weight = both.sum(axis=1)
    scale = 1.0 / np.sqrt(np.maximum(weight, 1.0))
    _, vectors = np.linalg.eigh(both * scale[:, None] * scale[None, :])
    x = vectors[:, -1 : -AXES - 1 : -1]
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    centres = [int(weight.argmax())]
    far = np.full(len(x), np.inf)
    while len(centres) < GROUPS:
        far = np.minimum(far, ((x - x[centres[-1]]) ** 2).sum(axis=1))
        centres.append(int((far * np.sqrt(weight)).argmax()))
    middle = x[centres]
    group = np.zeros(len(x), np.int64)
    for _ in range(20):
        group = ((x[:, None, :] - middle[None]) ** 2).sum(axis=2).argmin(axis=1)
        for g in range(GROUPS):
            own = (group == g) & (weight > 0)
            if own.any():
                middle[g] = np.average(x[own], axis=0, weights=weight[own])
    return group.astype(np.uint8)


def _segments(table: np.ndarray, weight: float, kind: type) -> Iterator[pa.RecordBatch]:
    """A task's table as rows (segment, sparse, weight, cells)."""
    width = len(table) // _SEGMENTS
    rows = []
    for s in range(_SEGMENTS):
        part = table[s * width : (s + 1) * width]
        at = np.flatnonzero(part)
        if len(at):
            sparse = len(at) * (4 + np.dtype(kind).itemsize) < width * np.dtype(kind).itemsize
            rows.append((s, sparse, weight, at.astype(np.uint32).tobytes() + part[at].astype(kind).tobytes() if sparse else part.astype(kind).tobytes()))
    if rows:
        s, sparse, w, cells = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(sparse), pa.array(w, pa.float64()), pa.array(cells, pa.binary())], names=["segment", "sparse", "weight", "cells"])


def _added(size: int, kind: type):
    width = size // _SEGMENTS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for s, sparse, weight, cells in _rows(batches, ("segment", "sparse", "weight", "cells")):
            total = sums.setdefault(s, np.zeros(width))
            if sparse:
                n = len(cells) // (4 + np.dtype(kind).itemsize)
                total[np.frombuffer(cells, np.uint32, n)] += weight * np.frombuffer(cells, kind, n, 4 * n).astype(np.float64)
            else:
                total += weight * np.frombuffer(cells, kind).astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["segment", "cells"])

    return add


def _summed(blocks: DataFrame, size: int, kind: type, function) -> np.ndarray:
    """The sum of the tables of all tasks, by segment in Spark; only the fixed-size result reaches the driver."""
    tasks = blocks.mapInArrow(function, "segment int, sparse boolean, weight double, cells binary")
    rows = tasks.repartition(_SEGMENTS, "segment").mapInArrow(_added(size, kind), "segment int, cells binary")
    out, width = np.zeros(size), size // _SEGMENTS
    for row in rows.collect():
        out[row.segment * width : (row.segment + 1) * width] = np.frombuffer(bytes(row.cells))
    return out


def _counted(vocabulary: Vocabulary, buckets: int):
    size = len(FEATURES) * buckets * CLASSES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size, np.int64)
        for cls, features in _training(vocabulary, buckets, batches):
            for f, x in enumerate(features):
                table[f * buckets * CLASSES : (f + 1) * buckets * CLASSES] += np.bincount(x.astype(np.int64) * CLASSES + cls, minlength=buckets * CLASSES)
        yield from _segments(table, 1.0, np.int32)

    return count


def log_probabilities(weights: np.ndarray, bias: np.ndarray, features: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log10 P(class | context) of the classes ``y``."""
    z = weights[0][features[0]] + bias
    for f in range(1, len(features)):
        z += weights[f][features[f]]
    z -= z.max(axis=1, keepdims=True)
    own = z[np.arange(len(y)), y].astype(np.float64)
    return (own - np.log(np.exp(z, out=z).sum(axis=1, dtype=np.float64))) / np.log(10)


def probabilities(weights: np.ndarray, bias: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
    """P(class | context) of a batch: a sparse sum of weight rows, then a softmax."""
    z = weights[0][features[0]] + bias
    for f in range(1, len(features)):
        z += weights[f][features[f]]
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _descended(vocabulary: Vocabulary, weights, bias: np.ndarray):
    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = weights.value
        w, seen = start.copy(), 0
        for cls, features in _training(vocabulary, weights.value.shape[1], batches):
            for a in range(0, len(cls), BATCH):
                x, y = [f[a : a + BATCH] for f in features], cls[a : a + BATCH]
                error = probabilities(w, bias, x)
                error[np.arange(len(y)), y] -= 1.0
                # every batch updates the tables of all features
                for f, own in enumerate(x):
                    order = np.argsort(own.astype(np.uint16) if len(w[f]) <= 1 << 16 else own, kind="stable")
                    bucket = own[order]
                    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                    n = np.diff(np.append(first, len(bucket)))
                    # the mean error of a bucket, held back where it has few tokens
                    w[f][bucket[first]] -= STEP * np.add.reduceat(error[order], first, axis=0) / (n + HOLD)[:, None].astype(np.float32)
                seen += len(y)
        if seen:
            # scaled up for the range of half-precision numbers, and weighted by tokens
            yield from _segments((w - start).ravel() * 64.0, seen / 64.0, np.float16)

    return descend


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    weights: np.ndarray
    bias: np.ndarray
    train_tokens: int
    train_words: int


def _largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most frequent words of each range."""
    for words, endings, n in _rows(batches, ("words", "endings", "n")):
        words, endings, n = np.frombuffer(words, np.uint64), np.frombuffer(endings, np.uint16), np.frombuffer(n, np.int64)
        best = np.lexsort((words, -n))[:SINGLE]
        yield pa.RecordBatch.from_arrays([pa.array(words[best].view(np.int64)), pa.array(endings[best].astype(np.int32)), pa.array(n[best])], names=["word", "ending", "c"])


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens and distinct words of each ending."""
    tokens, distinct = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
    for endings, n in _rows(batches, ("endings", "n")):
        endings = np.frombuffer(endings, np.uint16)
        tokens += np.bincount(endings, np.frombuffer(n, np.int64), ENDINGS).astype(np.int64)
        distinct += np.bincount(endings, minlength=ENDINGS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(ENDINGS, dtype=np.int32)), pa.array(tokens), pa.array(distinct)], names=["ending", "c", "n"])


def _vocabulary(tables: DataFrame, blocks: DataFrame) -> tuple[Vocabulary, int, int]:
    top = tables.mapInArrow(_largest, "word bigint, ending int, c bigint").orderBy(F.desc("c"), "word").limit(SINGLE).collect()
    by_ending = np.zeros((ENDINGS, 2))
    for r in tables.select("endings", "n").mapInArrow(_totals, "ending int, c bigint, n bigint").groupBy("ending").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).collect():
        by_ending[r.ending] = r.c, r.n
    group = grouped_endings(_summed(blocks, ENDINGS * ENDINGS, np.int32, _neighbours).reshape(ENDINGS, ENDINGS))
    tokens, distinct = (np.concatenate([np.zeros(SINGLE), np.bincount(group, x, GROUPS)]) for x in by_ending.T)
    total, words = int(tokens.sum()), int(distinct.sum())
    for k, r in enumerate(top):
        g = SINGLE + group[r.ending]
        tokens[g] -= r.c
        distinct[g] -= 1
        tokens[k], distinct[k] = r.c, 1
    return Vocabulary(np.array([r.word for r in top], np.int64).view(np.uint64), group, tokens, distinct), total, words


def train(blocks: DataFrame, tables: DataFrame, tokens: int) -> Model:
    """Fit the class weights to all ``tokens`` training tokens of ``blocks``."""
    sc = blocks.sparkSession.sparkContext
    buckets = bucket_count(tokens)
    # tasks hold many tokens each, so that their tables are small beside their input
    own = blocks.select("words", "endings", "at", "counts", "learns").coalesce(max(12, tokens // (BUCKET_TOKENS * buckets)))
    vocabulary, total, words = _vocabulary(tables, own)
    prior = (np.maximum(vocabulary.tokens, 0.0) + 1.0) / (vocabulary.tokens.sum() + CLASSES)
    bias = np.log(prior).astype(np.float32)
    shape = len(FEATURES), buckets, CLASSES
    if not total:
        return Model(vocabulary, np.zeros(shape, np.float32), bias, 0, 0)
    seen = _summed(own, int(np.prod(shape)), np.int32, _counted(vocabulary, buckets)).reshape(shape)
    likely = (seen + START_SMOOTH * prior) / (seen.sum(axis=2, keepdims=True) + START_SMOOTH)
    weights = (START * (np.log(likely) - np.log(prior))).astype(np.float32)
    for _ in range(ROUNDS):
        step = _summed(own, weights.size, np.float16, _descended(vocabulary, sc.broadcast(weights), bias))
        weights = weights + (step.reshape(shape) / total).astype(np.float32)
    return Model(vocabulary, weights, bias, total, words)


def _scored(model, id_type: pa.DataType, names: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        v, n, total = m.vocabulary, m.train_words, m.train_tokens
        within = v.tokens + SMOOTH * (v.distinct + 1)
        for words, endings, at, counts, ids, found in _rows(batches, ("words", "endings", "at", "counts", "ids", "found")):
            words, at, counts = np.frombuffer(words, np.uint64), np.frombuffer(at, np.uint32), np.frombuffer(counts, np.uint32).astype(np.int64)
            count = np.concatenate([np.frombuffer(x["c"], np.int64 if x["wide"] else np.uint16) for x in found]).astype(float)
            cls = v.classes(words, np.frombuffer(endings, np.uint16))
            # a single-word class is certain of its word, but for the share of unknown words of other classes
            inner = np.where(cls < SINGLE, 0.0, np.log10((count + SMOOTH) / within[cls]))
            base = np.log10((count + SMOOTH) / (total + SMOOTH * (n + 1)))
            first = np.cumsum(counts) - counts
            tokens = cls[at]
            features = contexts(tokens, words[at], counts, m.weights.shape[1])
            chosen = np.empty(len(at))
            for a in range(0, len(at), BATCH):
                y = tokens[a : a + BATCH]
                chosen[a : a + BATCH] = log_probabilities(m.weights, m.bias, [f[a : a + BATCH] for f in features], y)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, id_type),
                    pa.array(counts),
                    pa.array(np.add.reduceat((count > 0)[at].astype(np.int64), first)),
                    pa.array(np.full(len(ids), total)),
                    pa.array(np.add.reduceat(base[at], first)),
                    pa.array(np.add.reduceat(chosen + inner[at], first)),
                ],
                names=names,
            )

    return score


def score_texts(docs: DataFrame, learn: Callable, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows where ``learn(id column)`` holds and score all rows.

    Returns id, ``n_tokens`` (words and one end), ``n_known`` (tokens whose word
    occurs in training), ``train_tokens``, ``base_score`` (the smoothed unigram
    log10 probability) and ``score`` (the model's).  A null or empty text is its
    end alone.  Repeated rows are scored each; a null id never trains.  Without
    training texts all words are unknown and classes equally likely.  Very long
    texts are blocks of their own.  Other columns are never read, so their names
    cannot clash; an empty table gives an empty result.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    sc = docs.sparkSession.sparkContext
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(learn(F.col(id_col)), F.lit(False)).alias("learns"))
    fields = T.StructType([*BLOCK, T.StructField("ids", T.ArrayType(kind))])
    names = [id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    out = T.StructType([T.StructField(id_col, kind), *(T.StructField(n, T.LongType()) for n in names[1:4]), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    with common.Scratch(docs.sparkSession) as scratch, common.setting(docs.sparkSession, common.BATCH_BYTES, "4m"):
        blocks = scratch.written(rows.mapInArrow(_blocks(to_arrow_type(kind)), fields), "token-blocks")
        size = blocks.agg(F.coalesce(F.sum("learned"), F.lit(0)).alias("learned"), F.coalesce(F.sum(F.octet_length("words") / 8), F.lit(0)).cast("bigint").alias("pairs")).first()
        ranges = min(MOST_RANGES, max(LEAST_RANGES, 1 << (max(1, size.pairs // RANGE_PAIRS) - 1).bit_length()))
        salts = -(-max(1, size.pairs) // (ranges * RANGE_PAIRS))
        tables = scratch.written(count_words(blocks, ranges, salts), "word-counts")
        model = train(blocks, tables, size.learned)
        found = scratch.written(block_counts(blocks, tables, ranges, salts), "block-counts")
        ready = blocks.join(found, "block").select("words", "endings", "at", "counts", "ids", "found")
        return common.written(ready.mapInArrow(_scored(sc.broadcast(model), to_arrow_type(kind), names), out), "scores")
