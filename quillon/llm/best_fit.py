"""Packing of whole documents into sequences by the sum of squares.

A document goes where the sum, over all residual gaps, of the squared number of
open bins of that gap becomes smallest, so that bins of every gap stay at hand
and later documents find their fit.  Documents of a group come longest first,
and as many bins are open at the start as their tokens fill; another opens only
where no open bin holds a document.

Texts are tokenised where they lie.  Only their lengths are dealt, in equal
shares, to tasks that pack a bounded number of pieces each.
"""

from __future__ import annotations

import os
import re
import string
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Pieces that one task packs together.
GROUP_PIECES = 16_384
#: Chunks of text whose ids a worker keeps before it starts afresh.
MEMO_CHUNKS = 400_000

_PUNCTUATION = string.punctuation.encode()


def _ends_a_token(stem: bytes) -> bool:
    """Whether ASCII punctuation after ``stem`` starts a token of its own: after a letter or a number."""
    last = stem[-1]
    if last < 128:
        return chr(last).isalnum()
    return unicodedata.category(stem.decode()[-1])[0] in "LN"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints, the next letters after U+00FF for the rest."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in prints)
    return {b: chr(b) for b in prints} | {b: chr(256 + n) for n, b in enumerate(rest)}


_LETTERS = _byte_letters()
#: Latin letters that are one code point in every normal form and in lower case.
_LATIN = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]+")


class WordEncoder:
    """Ids of whole texts under a word-end vocabulary, from the library's ids of their distinct parts.

    The vocabulary's tokens never reach over white space, letters are taken in
    lower case, and a run of ASCII punctuation after a letter or number is a
    token's start.  So a text is cut at white space, each chunk into its stem
    and the punctuation after it, and the library is asked for new ones alone:
    its merging model for words of Latin letters, which need no normalising, and
    all of it for other parts.  Texts that may hold a special token are given to
    the library whole.

    A worker keeps about ``memo`` chunks.  Beyond that the ones used once go.
    """

    def __init__(self, name: str, memo: int = MEMO_CHUNKS) -> None:
        import public_tokenizers

        # a task has one core; the library would start a thread for each of the machine's
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.model = self.tokenizer.model
        self.memo = memo
        #: Number of each chunk, and of each part; part 0 is empty.
        self.chunks: dict[bytes, int] = {}
        self.parts: dict[bytes, int] = {b"": 0}
        self.of_chunk, self.uses = np.zeros((1024, 2), np.int32), np.zeros(1024, np.int64)
        self.ids, self.start = np.zeros(4096, np.uint32), np.zeros(1024, np.int64)
        self.size, self.used = np.zeros(1024, np.int64), 0

    def _forget(self) -> None:
        """Keep the chunks that were used again, half as many as the memo may hold at most, and their parts."""
        n = len(self.chunks)
        uses = self.uses[:n]
        kept = np.flatnonzero(uses > 1)
        if len(kept) > self.memo // 2:
            kept = np.sort(np.argsort(-uses, kind="stable")[: self.memo // 2])
        names = list(self.chunks)
        self.chunks = {names[i]: place for place, i in enumerate(kept.tolist())}
        parts, at = np.unique(np.append(self.of_chunk[kept].ravel(), 0), return_inverse=True)
        names = list(self.parts)
        self.parts = {names[i]: place for place, i in enumerate(parts.tolist())}
        self.of_chunk = at[:-1].reshape(-1, 2).astype(np.int32)
        self.uses = np.zeros(len(kept), np.int64)
        size, start = self.size[parts], self.start[parts]
        ends = np.cumsum(size)
        self.used = int(ends[-1])
        self.ids = self.ids[np.arange(self.used) + np.repeat(start - ends + size, size)]
        self.size, self.start = size, ends - size

    def _library(self, parts: list[bytes]) -> list[list[int]]:
        found: list[list[int] | None] = []
        rest: list[str] = []
        for part in parts:
            word = part.decode()
            if part.isalpha():
                found.append([t.id for t in self.model.tokenize(word)])
            elif _LATIN.fullmatch(word):
                found.append([t.id for t in self.model.tokenize(word.lower().encode().decode("latin-1").translate(_LETTERS))])
            else:
                found.append(None)
                rest.append(word)
        others = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else ())
        return [next(others).ids if f is None else f for f in found]

    def _learn(self, new: list[bytes]) -> None:
        if not new:
            return
        pairs = []
        for chunk in new:
            stem = chunk.rstrip(_PUNCTUATION)
            pairs.append((stem, chunk[len(stem) :]) if stem and len(stem) < len(chunk) and b"<|" not in chunk and _ends_a_token(stem) else (chunk, b""))
        known = self.parts
        unknown = [p for p in dict.fromkeys(chain.from_iterable(pairs)) if p not in known]
        found = self._library(unknown)
        first, n = len(known), len(known) + len(unknown)
        self.start, self.size = (_grown(x, n) for x in (self.start, self.size))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        total = int(sizes.sum())
        self.size[first:n] = sizes
        self.start[first:n] = self.used + np.cumsum(sizes) - sizes
        self.ids = _grown(self.ids, self.used + total)
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        self.used += total
        known.update(zip(unknown, range(first, n), strict=True))
        first, n = len(self.chunks), len(self.chunks) + len(new)
        self.of_chunk, self.uses = _grown(self.of_chunk, n), _grown(self.uses, n)
        self.of_chunk[first:n] = np.fromiter(map(known.__getitem__, chain.from_iterable(pairs)), np.int32, 2 * len(new)).reshape(-1, 2)
        self.chunks.update(zip(new, range(first, n), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [[t.encode()] if "<|" in t else t.encode().lower().split() for t in texts]
        if len(self.chunks) > self.memo:
            self._forget()
        known = self.chunks
        self._learn(list(set(chain.from_iterable(split)).difference(known)))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        codes = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        self.uses[: len(known)] += np.bincount(codes, minlength=len(known))
        parts = self.of_chunk[codes].ravel()
        sizes = self.size[parts]
        ends = np.cumsum(sizes)
        places = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.start[parts] - ends + sizes, sizes)
        flat = self.ids[places]
        cuts = np.append(0, ends)[2 * np.append(0, np.cumsum(counts))]
        return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _grown(array: np.ndarray, n: int) -> np.ndarray:
    if n <= len(array):
        return array
    more = np.zeros((max(n, 2 * len(array)), *array.shape[1:]), array.dtype)
    more[: len(array)] = array
    return more


_encoders: dict[str, WordEncoder] = {}


def encoder(name: str) -> WordEncoder:
    if name not in _encoders:
        _encoders[name] = WordEncoder(name)
    return _encoders[name]


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size, none of which exceeds ``capacity``.

    Sizes are placed from the largest to the smallest, equal ones in order.
    From the gap g a size s leads to the gap g - s: the squares change by twice
    the difference of the two gaps' counts and 2, or, where the bin becomes
    full, by 1 less than twice the count of g.  Of equal changes the tightest
    fit wins.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    counts = np.zeros(capacity + 1, np.int64)
    opened = -(-int(sizes.sum()) // capacity) if len(sizes) else 0
    counts[capacity] = opened
    open_bins: dict[int, list[int]] = {capacity: list(range(opened - 1, -1, -1))}
    never = np.int64(1) << 40
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        from_gap = counts[size:]
        change = 2 * (counts[: capacity + 1 - size] - from_gap) + 2
        change[0] = 1 - 2 * from_gap[0]
        change[from_gap == 0] = never
        left = int(change.argmin())
        if change[left] == never:
            number, left = opened, capacity - size
            opened += 1
        else:
            number = open_bins[left + size].pop()
            counts[left + size] -= 1
        bins[i], offsets[i] = number, capacity - size - left
        if left:
            counts[left] += 1
            open_bins.setdefault(left, []).append(number)
    return bins, offsets


def pack_best_fit(
    docs: DataFrame,
    vocabulary: str = "word_bpe_49k.json",
    end: int = 1,
    capacity: int = 4096,
    group_pieces: int = GROUP_PIECES,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset[, ids]): every row's whole text in sequences of ``capacity`` tokens.

    A document is its ids and then ``end``.  One longer than ``capacity`` is cut
    into pieces of it, the last of which may be shorter; no other is cut.
    ``start`` counts the document's ids before the piece, ``offset`` those of the
    sequence before it.  ``ids`` are the piece's ids, on request.  Sequence ids
    are unique, not consecutive.

    A null or empty text is its end alone; an empty table gives an empty result.
    Repeated rows are packed each for itself, texts of equal length in an
    unspecified order; a null id stays null.  Other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    key_type = docs.schema[id_col].dataType
    kind, key = to_arrow_type(key_type), f"`{id_col}` {key_type.simpleString()}"
    tail = ", ids array<int>" if with_ids else ""
    piece_names = [id_col, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for group in common.text_groups(batches):
            rows: list[tuple] = []
            for ident, ids in zip(group.column("id").to_pylist(), enc.encode([t or "" for t in group.column("text").to_pylist()]), strict=True):
                whole = np.append(ids, np.uint32(end)).astype("<u4")
                for n, start in enumerate(range(0, len(whole), capacity)):
                    part = whole[start : start + capacity]
                    rows.append((ident, n, start, len(part), zlib.crc32(part.tobytes()), part))
            columns = [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.int64()) for i in (2, 3, 4))]
            if with_ids:
                columns.append(pa.array([r[5].astype(np.int32) for r in rows], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=piece_names)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        bins, offsets = sum_of_squares(rows.column("length").to_numpy(), capacity)
        rows = rows.append_column("sequence_id", pa.array(bins + (common.task_number() << 40)))
        yield from rows.append_column("offset", pa.array(offsets)).to_batches()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cut = rows.mapInArrow(pieces, f"{key}, piece int, start bigint, length bigint, ids_crc32 bigint{tail}")
    # rows of one id may be many, so they are dealt in turn and not by a key
    dealt = cut.repartition(max(1, -(-docs.count() // group_pieces)))
    found = dealt.mapInArrow(packed, f"{key}, piece int, start bigint, length bigint, ids_crc32 bigint{tail}, sequence_id bigint, offset bigint")
    return found.select(id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))
