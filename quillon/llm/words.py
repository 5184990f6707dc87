"""Words of whole Arrow text columns as 64-bit hashes, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_POINT = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: A random 64-bit value per byte.
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x + _U((seed * 2 + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, _U(base))
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def _word_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all rows, the first byte and the end of each word, and each row's word count."""
    rows = len(column)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + rows + 1]
    begin, end = (int(offsets[0]), int(offsets[-1])) if rows else (0, 0)
    if begin == end:
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(rows, np.int64)
    data = _FOLD[np.frombuffer(column.buffers()[2], np.uint8)[begin:end]]
    bounds = offsets - begin
    word = ~_SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    first = bounds[:-1][bounds[:-1] < len(data)]
    start[first] = word[first]
    stop = word.copy()
    stop[:-1] &= ~word[1:]
    last = bounds[1:][bounds[1:] > 0] - 1
    stop[last] = word[last]
    begins, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return data, begins, ends, np.diff(np.searchsorted(begins, bounds))


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, of all rows, and each row's word count.

    Null rows have no words.  Equal words have equal hashes; different words
    differ but for a chance of about 2**-64 a pair.
    """
    data, begins, ends, counts = _word_bytes(column)
    if not len(begins):
        return np.zeros(0, np.uint64), counts
    power, inverse = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[begins]) * inverse[begins] + (ends - begins).astype(np.uint64)), counts


def word_endings(column: pa.Array, kinds: int) -> np.ndarray:
    """A hash below ``kinds``, a power of two, of the last letters of each word, punctuation after them left out."""
    data, begins, ends, _ = _word_bytes(column)
    last = ends.copy()
    for _ in range(3):
        at = last - 1
        last = np.where((at > begins) & _POINT[data[at]], at, last) if len(at) else last
    key = np.zeros(len(begins), np.uint64)
    for back in range(1, 4):
        at = last - back
        key = key << _U(8) | np.where(at >= begins, data[np.maximum(at, 0)], 0).astype(np.uint64)
    return (mix(key, 3) >> _U(65 - kinds.bit_length())).astype(np.uint16)


def shingles(column: pa.Array, size: int = 5) -> tuple[list[np.ndarray], np.ndarray]:
    """Per row the sorted distinct hashes of its runs of ``size`` words (of all its words, if fewer), and its word count."""
    words, counts = hashed_words(column)
    at = np.append(0, np.cumsum(counts))
    whole = np.zeros(max(0, len(words) - size + 1), np.uint64)
    scrambled = [mix(words, k + 1) for k in range(size)]
    for k in range(size):
        whole += scrambled[k][k : k + len(whole)]
    whole = mix(whole)
    out = []
    for i, n in enumerate(counts.tolist()):
        a = int(at[i])
        if n >= size:
            row = np.sort(whole[a : a + n - size + 1])
            out.append(row[np.append(True, row[1:] != row[:-1])])
        elif n:
            few = np.zeros(1, np.uint64)
            for k in range(n):
                few += scrambled[k][a + k]
            out.append(mix(few, 100 + n))
        else:
            out.append(np.zeros(0, np.uint64))
    return out, counts
