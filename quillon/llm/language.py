"""Language identification by prediction by partial matching.

For every language a tree of byte contexts, at most ``DEPTH`` bytes deep, holds
how often each byte followed.  A byte is coded in the deepest known context; if
it never followed there, an escape is coded (method C: as likely as the number
of different followers) and the next shorter context is tried, down to a
uniform code over 256 bytes.  The statistics are frozen after training, so the
bits of a text are exact sums.  The text with the fewest bits per language wins.

The coded stream is the text in lower case with one space before each word, the
spaces coded like any byte, and contexts reach back over them.  Only a space and
the three bytes after it can see the word before; the bits of a word's other
bytes are a property of the word, and those of the joint a property of the
``DEPTH`` bytes before it and the three after.  A worker computes both once, and
their sums are the code length of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

DEPTH = 4
#: Texts per language from which the trees are built: a bounded sample, drawn by a hash of the id.
SAMPLE = 400
#: Ids drawn by hash range, as a multiple of the sample, before the sample is cut to size.
SPARE = 2.0
#: Log-odds between languages are divided by this before they become a probability.
TEMPERATURE = 2.0
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


HEAD = DEPTH - 1
#: Longer words are coded anew each time they occur, which bounds the memo.
MEMO_CHARS = 48


def _stream(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each word led by a space, and the length of each text."""
    coded = ["".join([" " + w for w in t]).encode() for t in texts]
    return np.frombuffer(b"".join(coded), np.uint8).astype(np.int64), np.fromiter(map(len, coded), np.int64, len(coded))


def _context(flat: np.ndarray, order: int) -> np.ndarray:
    """The ``order`` bytes before each place as one number; meaningless where fewer bytes come before."""
    key = np.zeros(len(flat), np.int64)
    for back in range(order, 0, -1):
        key[back:] = key[back:] << 8 | flat[: len(flat) - back]
    return key


@dataclass
class Tree:
    """One language: per order the sorted (context, byte) keys with their bits, and contexts with their escape bits."""

    symbols: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    @classmethod
    def of(cls, order: np.ndarray, key: np.ndarray, n: np.ndarray) -> Tree:
        tree = cls([], [], [], [])
        for k in range(DEPTH + 1):
            own = order == k
            at = np.argsort(key[own], kind="stable")
            keys, counts = key[own][at], n[own][at].astype(float)
            context, first, back = np.unique(keys >> 8, return_index=True, return_inverse=True)
            total = np.add.reduceat(counts, first) if len(first) else np.zeros(0)
            kinds = np.diff(np.append(first, len(keys))).astype(float)
            tree.symbols.append(keys)
            tree.bits.append(np.log2((total + kinds)[back] / counts) if len(first) else np.zeros(0))
            tree.contexts.append(context)
            tree.escapes.append(np.log2((total + kinds) / kinds))
        return tree

    def cost(self, context: np.ndarray, byte: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Bits of bytes, each with the ``DEPTH`` bytes before it as one number and how many there are."""
        bits, todo = np.full(len(byte), 0.0), np.arange(len(byte))
        for k in range(DEPTH, -1, -1):
            old = place[todo] >= k
            here, young = todo[old], todo[~old]
            if not len(here) or not len(self.symbols[k]):
                continue
            near = context[here] & ((1 << 8 * k) - 1)
            key = near << 8 | byte[here]
            at = np.searchsorted(self.symbols[k], key)
            at[at == len(self.symbols[k])] = 0
            known = self.symbols[k][at] == key
            bits[here[known]] += self.bits[k][at[known]]
            missed, rest = here[~known], near[~known]
            at = np.searchsorted(self.contexts[k], rest)
            at[at == len(self.contexts[k])] = 0
            seen = self.contexts[k][at] == rest
            bits[missed[seen]] += self.escapes[k][at[seen]]
            todo = np.concatenate([young, missed])
        bits[todo] += 8.0
        return bits


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, order, context and byte, count) of the training texts of a batch."""
    for batch in common.text_groups(batches):
        by: dict[str, list[list[str]]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by.setdefault(lang, []).append(text.lower().split())
        for lang, texts in by.items():
            flat, length = _stream(texts)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
            for k in range(DEPTH + 1):
                here = np.flatnonzero(place >= k)
                if not len(here):
                    continue
                key, n = np.unique(_context(flat, k)[here] << 8 | flat[here], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key)), pa.array(np.full(len(key), k, np.int32)), pa.array(key), pa.array(n.astype(np.int64))], names=["lang", "k", "key", "n"])


def train(docs: DataFrame, learn, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, Tree]:
    """Trees per language from the rows where ``learn`` holds and text and lang are set.

    The sample is drawn over ids alone: the rows per language give a share of
    the hash range that holds somewhat more than ``sample`` ids, and of these the
    lowest hashes are taken, so a language of any size reaches its task as a few
    hundred ids.  Counts are summed in Spark, and only the bounded trees reach
    the driver.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    ids = rows.select("id", "lang", F.xxhash64(F.col("id").cast("string")).alias("h"))
    share = {r.lang: min(1.0, SPARE * sample / r.n) for r in ids.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not share:
        return {}
    limit = F.create_map(*(F.lit(v) for item in share.items() for v in item))[F.col("lang")]
    pick = Window.partitionBy("lang").orderBy("h", "id")
    chosen = ids.where(F.col("h") / F.lit(float(1 << 64)) + 0.5 < limit).withColumn("r", F.row_number().over(pick)).where(F.col("r") <= sample).select("id", "lang").distinct()
    # at most ``sample`` ids per language
    texts = rows.join(F.broadcast(chosen), ["id", "lang"], "left_semi").select("text", "lang")
    sums = texts.mapInArrow(counted, "lang string, k int, key bigint, n bigint").groupBy("lang", "k", "key").agg(F.sum("n").alias("n"))
    found = sums.toArrow()
    langs = np.asarray(found.column("lang").to_pylist(), object)
    k, key, n = (found.column(c).to_numpy() for c in ("k", "key", "n"))
    return {lang: Tree.of(k[own], key[own], n[own]) for lang in sorted(set(langs.tolist())) for own in [langs == lang]}


class Scorer:
    """Bits per language of whole texts, through memos of distinct words and joints."""

    def __init__(self, trees: dict[str, Tree]) -> None:
        self.langs, self.trees = list(trees), list(trees.values())
        self.memo: dict[str, int] = {}
        self.table = np.zeros((1 << 12, len(self.trees)))
        self.joints, self.joint_bits = np.zeros(0, np.uint64), np.zeros((0, len(self.trees)))

    def _words(self, words: list[str]) -> np.ndarray:
        """Bits of what follows the first bytes of each word, at its index in the memo."""
        memo = self.memo
        new = sorted(set(words).difference(memo), key=len)
        if new:
            base = len(memo)
            if base + len(new) > len(self.table):
                self.table = np.resize(self.table, (2 * (base + len(new)), len(self.trees)))
            flat, length = _stream([[w] for w in new])
            first = np.cumsum(length) - length
            place = np.arange(len(flat)) - np.repeat(first, length)
            at = np.flatnonzero(place > HEAD)
            owner, asked = np.repeat(np.arange(len(new)), length)[at], (_context(flat, DEPTH)[at], flat[at], place[at])
            for column, tree in enumerate(self.trees):
                self.table[base : base + len(new), column] = np.bincount(owner, tree.cost(*asked), len(new))
            memo.update(zip(new, range(base, base + len(new)), strict=True))
        found = self.table[np.fromiter(map(memo.__getitem__, words), np.int64, len(words))]
        # long words are the last rows, and are forgotten
        while new and len(new[-1]) > MEMO_CHARS:
            del memo[new.pop()]
        return found

    def _joints(self, flat: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Bits of each space and the bytes of its word that can see beyond it."""
        spaces = np.flatnonzero(flat == 32)
        before = spaces - np.repeat(np.cumsum(length) - length, length)[spaces]
        # the bytes before the space, 0 where the text has none, and those after it, 0 where the word has none
        padded = np.concatenate([np.zeros(DEPTH, np.uint64), flat.astype(np.uint64), np.full(HEAD + 1, 32, np.uint64)])
        key = np.zeros(len(spaces), np.uint64)
        for back in range(DEPTH, 0, -1):
            key = key << np.uint64(8) | np.where(before >= back, padded[spaces + (DEPTH - back)], np.uint64(0))
        inside = np.ones(len(spaces), bool)
        for after in range(1, HEAD + 1):
            byte = padded[spaces + (DEPTH + after)]
            inside &= byte != 32
            key = key << np.uint64(8) | np.where(inside, byte, np.uint64(0))
        distinct, back = np.unique(key, return_inverse=True)
        at = np.searchsorted(self.joints, distinct)
        known = (self.joints[np.minimum(at, len(self.joints) - 1)] == distinct) if len(self.joints) else np.zeros(len(distinct), bool)
        bits = np.zeros((len(distinct), len(self.trees)))
        bits[known] = self.joint_bits[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            asked, owner = _coded_joints(distinct[new])
            for column, tree in enumerate(self.trees):
                bits[new, column] = np.bincount(owner, tree.cost(*asked), len(new))
            if len(self.joints) > common.MEMO_ENTRIES:
                self.joints, self.joint_bits = self.joints[:0], self.joint_bits[:0]
            order = np.argsort(np.concatenate([self.joints, distinct[new]]), kind="stable")
            self.joints = np.concatenate([self.joints, distinct[new]])[order]
            self.joint_bits = np.concatenate([self.joint_bits, bits[new]])[order]
        return bits[back]

    def bits(self, texts: list[str]) -> np.ndarray:
        """Code length of each text under each language."""
        if len(self.memo) > common.MEMO_ENTRIES:
            self.memo.clear()
        # a zero byte stands for none in a joint, so it is coded as another control character
        parts = [t.lower().replace("\0", "\1").split() for t in texts]
        out = np.zeros((len(texts), len(self.trees)))
        count = np.fromiter(map(len, parts), np.int64, len(parts))
        if not count.sum():
            return out
        flat, length = _stream(parts)
        total = self._joints(flat, length) + self._words([w for p in parts for w in p])
        filled = np.flatnonzero(count)
        out[filled] = np.add.reduceat(total, (np.cumsum(count) - count)[filled], axis=0)
        return out


def _coded_joints(keys: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """Of joints: the context, byte and place of each space and of the bytes after it, and the joint that each belongs to."""
    width = DEPTH + HEAD
    part = [(keys >> np.uint64(8 * (width - 1 - i)) & np.uint64(255)).astype(np.int64) for i in range(width)]
    stream = [*part[:DEPTH], np.full(len(keys), 32, np.int64), *part[DEPTH:]]
    held = sum((p != 0).astype(np.int64) for p in part[:DEPTH])
    context, byte, place, owner = [], [], [], []
    for i in range(DEPTH, width + 1):
        near = np.zeros(len(keys), np.int64)
        for j in range(i - DEPTH, i):
            near = near << 8 | stream[j]
        at = np.flatnonzero(stream[i] != 0)
        context.append(near[at])
        byte.append(stream[i][at])
        place.append((held + (i - DEPTH))[at])
        owner.append(at)
    return (np.concatenate(context), np.concatenate(byte), np.concatenate(place)), np.concatenate(owner)


def identify(docs: DataFrame, trees: dict[str, Tree], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``lang_pred`` and ``score`` (0 to 1) of each whole text, in one narrow pass.

    A null text, one without letters, or an empty model gives ``und`` and 0.
    Ties go to the language first in alphabetical order.  Repeated rows score
    alike, texts of any length are coded whole, other columns are never read, and
    an empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for group in common.text_groups(batches):
            texts = [t or "" for t in group.column("text").to_pylist()]
            known = np.array([bool(scorer.trees) and _LETTER.search(t) is not None for t in texts])
            if scorer.trees:
                bits = scorer.bits(texts)
                best = bits.argmin(axis=1)
                odds = (bits - bits.min(axis=1, keepdims=True)) * (np.log(2) / TEMPERATURE)
                score = np.where(known, 1 / np.exp(-odds).sum(axis=1), 0.0)
            else:
                best, score = np.zeros(len(texts), int), np.zeros(len(texts))
            pred = [scorer.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays([group.column("id"), pa.array(pred, pa.string()), pa.array(score)], names=[id_col, "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scored, T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
