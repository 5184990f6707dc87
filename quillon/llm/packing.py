"""Vector bin packing of token sequences by a dot-product heuristic.

A bin has three limits: tokens, segments and loss-bearing tokens.  Of the items
that fit, the one whose demand has the largest dot product with what is left of
the bin goes in, so that an item is drawn to the dimension in which the bin is
emptiest.  Where nothing fits whole and cutting is allowed, an item is cut.
Every partition packs its own rows from a window of waiting items, so nothing
is shuffled and the padding lost at a partition's end is bounded by one bin.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

class RankEncoder:
    """Ids of whole texts under the byte-level vocabulary file at ``path``.

    ``tiktoken`` reads the same vocabulary as ranks and gives the ids that
    ``tokenizers`` gives for the JSON file (the tests compare the two) at about
    a quarter of its CPU time.  As there, the end marker's string inside a text
    is the marker's id.
    """

    def __init__(self, path: str, special: dict[str, int]) -> None:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoding.encode_to_numpy(t, allowed_special="all") for t in texts]


#: For each tokenizer file its ranks and special tokens.
RANKS = {"byte_bpe_50k.json": ("byte_bpe_50k.tiktoken", {"<|endoftext|>": 50256})}

_encoders: dict[str, RankEncoder] = {}


def encoder(name: str) -> RankEncoder:
    if name not in _encoders:
        import public_tokenizers

        ranks, special = RANKS[name]
        _encoders[name] = RankEncoder(public_tokenizers.path(ranks), special)
    return _encoders[name]


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold: tokens, pieces, and tokens that bear loss."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


@dataclass
class Item:
    """The unplaced rest of an example; ``bears`` is the running count of loss-bearing tokens."""

    key: object
    ids: np.ndarray
    bears: np.ndarray | None = None
    at: int = 0

    @property
    def size(self) -> int:
        return len(self.ids) - self.at

    def loss(self, length: int) -> int:
        if self.bears is None:
            return length
        return int(self.bears[self.at + length] - self.bears[self.at])

    def fitting(self, tokens: int, loss: int) -> int:
        """The longest piece from here within both limits."""
        length = min(tokens, self.size)
        if self.bears is not None:
            length = min(length, int(np.searchsorted(self.bears, self.bears[self.at] + loss, side="right")) - 1 - self.at)
        else:
            length = min(length, loss)
        return length


@dataclass
class Packer:
    """Packs a stream of items; ``placed`` yields (item key, start, piece ids, loss, sequence, offset, document length)."""

    limits: Limits
    cut: bool = True
    window: int = 256
    first_sequence: int = 0
    waiting: list[Item] = field(default_factory=list)
    sequence: int = 0

    def _demands(self) -> np.ndarray:
        return np.array([(x.size, 1, x.loss(x.size)) for x in self.waiting], np.float64).reshape(-1, 3)

    def add(self, item: Item) -> Iterator[tuple]:
        if not item.size:
            return
        cap = self.limits
        while self.cut and item.size >= cap.tokens and (n := item.fitting(cap.tokens, cap.loss)) > 0:
            yield from self._close([(item, item.at, n)])
            item.at += n
        if not item.size:
            return
        if not self.cut and (item.size > cap.tokens or item.loss(item.size) > cap.loss):
            raise ValueError(f"example {item.key!r} does not fit a sequence and may not be cut")
        self.waiting.append(item)
        if len(self.waiting) >= self.window:
            yield from self._fill(len(self.waiting) // 2)

    def finish(self) -> Iterator[tuple]:
        yield from self._fill(0)

    def _fill(self, leave: int) -> Iterator[tuple]:
        """Fill bins until at most ``leave`` items wait."""
        cap = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], np.float64)
        demand, free = self._demands(), np.ones(len(self.waiting), bool)
        size, loss = demand[:, 0].copy(), demand[:, 2].copy()
        while np.count_nonzero(free) > leave:
            rest, held = cap.copy(), []
            while rest[1] >= 1 and rest[0] > 0:
                fits = np.flatnonzero(free & (size <= rest[0]) & (loss <= rest[2]))
                if len(fits):
                    gain = demand[fits] @ (rest / cap / cap)
                    n = int(fits[gain.argmax()])
                    x = self.waiting[n]
                    held.append((x, x.at, x.size))
                    rest -= demand[n]
                    free[n] = False
                    continue
                if not self.cut or not free.any():
                    break
                n = int(np.where(free, size, -1).argmax())
                x = self.waiting[n]
                length = x.fitting(int(rest[0]), int(rest[2]))
                if length <= 0:
                    break
                held.append((x, x.at, length))
                rest -= (length, 1, x.loss(length))
                x.at += length
                demand[n] = x.size, 1, x.loss(x.size)
                size[n], loss[n] = demand[n, 0], demand[n, 2]
            yield from self._close(held)
        self.waiting = [x for x, f in zip(self.waiting, free, strict=True) if f]

    def _close(self, held: list[tuple[Item, int, int]]) -> Iterator[tuple]:
        """Emit a bin; one that is not full is laid out as sequences of powers of two, which need no padding."""
        total = sum(n for _, _, n in held)
        room = 1 << (total.bit_length() - 1) if self.cut and total < self.limits.tokens else self.limits.tokens
        offset, left = 0, total
        for item, start, length in held:
            while length:
                n = min(length, room - offset)
                loss = n if item.bears is None else int(item.bears[start + n] - item.bears[start])
                yield item.key, start, item.ids[start : start + n], loss, self.first_sequence + self.sequence, offset, len(item.ids)
                start, length, offset, left = start + n, length - n, offset + n, left - n
                if offset == room and left:
                    self.sequence += 1
                    offset, room = 0, 1 << (left.bit_length() - 1)
        self.sequence += 1


def pack_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end: int = 1, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack whole texts, every token bearing loss, into sequences within ``limits``.

    Rows: one per piece, with ``start`` and ``length`` in its document,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and
    ``loss_tokens``.  A null or empty text is its end token alone.  Repeated
    rows are packed each for itself.  Sequence ids are unique across partitions.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer = encoder(vocabulary), Packer(limits, first_sequence=common.task_number() << 40)
        for group in common.text_groups(batches):
            rows: list[tuple] = []
            texts = [t or "" for t in group.column("text").to_pylist()]
            for key, ids in zip(group.column("id").to_pylist(), enc.encode(texts), strict=True):
                rows.extend(packer.add(Item(key, np.append(ids, np.uint32(end)).astype("<u4"))))
            yield from _rows(rows, kind, names)
        yield from _rows(list(packer.finish()), kind, names)

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = docs.schema[id_col].dataType
    kind = to_arrow_type(key_type)
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return rows.mapInArrow(packed, ", ".join([f"`{id_col}` {key_type.simpleString()}", *(f"{n} bigint" for n in names[1:])]))


def _rows(rows: list[tuple], kind: pa.DataType, names: list[str]) -> Iterator[pa.RecordBatch]:
    if not rows:
        return
    columns = [
        pa.array([r[0] for r in rows], kind),
        [r[1] for r in rows],
        [len(r[2]) for r in rows],
        [zlib.crc32(r[2].tobytes()) for r in rows],
        [r[6] for r in rows],
        [r[4] for r in rows],
        [r[5] for r in rows],
        [r[3] for r in rows],
    ]
    yield pa.RecordBatch.from_arrays([columns[0], *(pa.array(c, pa.int64()) for c in columns[1:])], names=names)


def pack_examples(examples: DataFrame, limits: Limits, vocabulary: str = "byte_bpe_50k.json", end: int = 1) -> DataFrame:
    """Pack instruction examples whole, without cutting.

    ``examples`` has ``example_id`` and ``turns``, an array of (text, loss)
    structs in order; the tokens of a turn with ``loss`` bear loss.  An example
    beyond ``limits`` raises, since cutting it would part a question from its
    answer; filter or split such examples first.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer = encoder(vocabulary), Packer(limits, cut=False, first_sequence=common.task_number() << 40)
        for batch in batches:
            rows: list[tuple] = []
            for key, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                turns = [t for t in turns or [] if t]
                parts = enc.encode([t["text"] or "" for t in turns])
                ids = np.concatenate([*parts, np.array([end], np.uint32)]).astype("<u4")
                bears = np.concatenate([[0], *[np.full(len(p), bool(t["loss"])) for p, t in zip(parts, turns, strict=True)], [True]])
                rows.extend(packer.add(Item(key, ids, np.cumsum(bears))))
            yield from _rows(rows, kind, names)
        yield from _rows(list(packer.finish()), kind, names)

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = examples.schema["example_id"].dataType
    kind = to_arrow_type(key_type)
    names = ["example_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
    return examples.select("example_id", "turns").mapInArrow(packed, ", ".join([f"example_id {key_type.simpleString()}", *(f"{n} bigint" for n in names[1:])]))
