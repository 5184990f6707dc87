"""Token counts by rank-synchronous merging of ragged numpy arrays.

A piece model (byte-fallback BPE) merges, again and again, the adjacent pair
whose joined piece ranks best.  No piece holds a non-space before a space mark,
so a text falls apart into chunks that merge independently.  The distinct new
chunks of a group of texts are held as one flat symbol array with sequence
starts; every round finds each sequence's lowest rank and applies that pair in
all sequences at once.  What survives is counted and kept in a memo per worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import common

#: U+2581, which stands for a space inside pieces.
MARK = "▁"
NO_RANK = np.int32(2**31 - 1)
_SPACED = re.compile(" +[^ ]*")


class PieceMerger:
    """Counts pieces of distinct chunks under the piece model at ``path``."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                pieces[model.id_to_piece(i)] = (-model.get_score(i), i)
        order = sorted(pieces, key=pieces.get)
        # pieces of one score share a rank, so that only the place decides between them
        ranks, rank, last = {}, -1, None
        for piece in order:
            if pieces[piece][0] != last:
                rank, last = rank + 1, pieces[piece][0]
            ranks[piece] = rank
        ident = {piece: n for n, piece in enumerate(order)}
        keys, results = [], []
        for piece in order:
            for cut in range(1, len(piece)):
                left, right = ident.get(piece[:cut]), ident.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    results.append(ident[piece])
        keys, results = np.array(keys, np.int64), np.array(results, np.int32)
        at = np.argsort(keys)
        self.keys, self.results = keys[at], results[at]
        self.rank = np.array([ranks[p] for p in order], np.int32)
        # a piece is safe if joining it on always ranks worse than making it
        worst = np.full(len(order), NO_RANK, np.int32)
        joined = self.rank[self.results]
        np.minimum.at(worst, self.keys >> 32, joined)
        np.minimum.at(worst, self.keys & 0xFFFFFFFF, joined)
        self.safe = worst > self.rank
        self.symbol = np.full(0x110000, -1, np.int32)
        for piece, n in ident.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = n
        self.splits_at_marks = not any(MARK in piece.lstrip(MARK) for piece in order)
        self.memo: dict[str, int] = {}

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; NO_RANK where no piece joins it."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        found = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        result = np.where(found, self.results[at], -1)
        return np.where(found, self.rank[result], NO_RANK), result

    def count(self, chunks: list[str]) -> np.ndarray:
        """Pieces of every chunk, a character outside the vocabulary being its UTF-8 bytes."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)
        owner = np.repeat(np.arange(len(chunks)), sizes)
        symbol = self.symbol[points]
        width = np.where(symbol >= 0, 1, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))
        total = np.bincount(owner, width, len(chunks)).astype(np.int64)
        if len(symbol) < 2:
            return total
        seq = owner
        rank, result = self.ranked(symbol[:-1], symbol[1:])
        rank[seq[:-1] != seq[1:]] = NO_RANK
        rank, result = np.append(rank, NO_RANK), np.append(result, -1)
        while len(symbol):
            first = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            lowest = np.minimum.reduceat(rank, first)
            alive = lowest < NO_RANK
            if not alive.any():
                break
            length = np.diff(np.append(first, len(symbol)))
            if not alive.all():  # finished sequences leave the arrays
                keep = np.repeat(alive, length)
                symbol, seq, rank, result = symbol[keep], seq[keep], rank[keep], result[keep]
                lowest, length = lowest[alive], length[alive]
                first = np.cumsum(length) - length
            hit = np.flatnonzero(rank == np.repeat(lowest, length))
            sequence = seq[hit]
            start = np.append(True, (hit[1:] != hit[:-1] + 1) | (sequence[1:] != sequence[:-1]))
            run = np.flatnonzero(start)
            within = np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))
            leftmost = np.append(True, sequence[1:] != sequence[:-1])
            same = result[hit] == np.repeat(result[hit[leftmost]], np.diff(np.append(np.flatnonzero(leftmost), len(hit))))
            hit = hit[leftmost | (self.safe[result[hit]] & (within % 2 == 0) & same)]
            np.subtract.at(total, seq[hit], 1)
            symbol[hit] = result[hit]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            rank[hit], result[hit] = rank[hit + 1], -1
            moved = np.cumsum(keep) - 1
            at = moved[hit]
            symbol, seq, rank, result = symbol[keep], seq[keep], rank[keep], result[keep]
            touched = np.zeros(len(symbol), bool)
            touched[at] = True
            touched[at[at > 0] - 1] = True
            touched[-1] = False
            changed = np.flatnonzero(touched)
            new_rank, new_result = self.ranked(symbol[changed], symbol[changed + 1])
            new_rank[seq[changed] != seq[changed + 1]] = NO_RANK
            rank[changed], result[changed] = new_rank, new_result
            rank[-1] = NO_RANK
        return total

    def chunks(self, text: str) -> list[str]:
        """The text as chunks; the space before each is left out where it is single."""
        if MARK in text:
            text = text.replace(MARK, " ")
        if not self.splits_at_marks:
            return [" " + text] if text else []
        if "  " in text or text[:1] == " " or text[-1:] == " ":
            return [x[1:] for x in _SPACED.findall(" " + text)]
        return text.split(" ") if text else []

    def totals(self, texts: list[str]) -> list[int]:
        memo, parts = self.memo, [self.chunks(t) for t in texts]
        if len(memo) > common.MEMO_ENTRIES:
            memo.clear()
        new = list(set().union(*parts).difference(memo)) if parts else []
        if new:
            memo.update(zip(new, self.count([(MARK + x).replace(" ", MARK) for x in new]).tolist(), strict=True))
        return [sum(map(memo.__getitem__, p)) for p in parts]


_merger: dict[str, PieceMerger] = {}


def merger(name: str) -> PieceMerger:
    """The worker's merger for a vocabulary file; every executor has its own copy of the files."""
    if name not in _merger:
        import public_tokenizers

        _merger[name] = PieceMerger(name if "/" in name else public_tokenizers.path(name))
    return _merger[name]


def count_tokens(docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of each text: id, n_bytes, n_tokens, over_limit.

    One narrow pass without a shuffle.  A null or empty text has 0 bytes and 0
    tokens; null ids and repeated rows are kept as they are.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(model)
        for group in common.text_groups(batches):
            column = group.column("text")
            tokens = m.totals([t or "" for t in column.to_pylist()])
            size = pc.cast(pc.fill_null(pc.binary_length(column), 0), pa.int64())
            n = pa.array(tokens, pa.int64())
            yield pa.RecordBatch.from_arrays([group.column("id"), size, n, pc.greater(n, limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return rows.mapInArrow(counted, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
