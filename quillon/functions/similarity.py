"""String similarities that need a matching loop: vectorised UDFs over distinct pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from .text import ascii_fold, normalize_text, tokens


def _ratio(a: str, b: str) -> float:
    if not a and not b:
        return 1.0
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


@F.pandas_udf(DoubleType())
def _ratios(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([_ratio(x, y) for x, y in zip(a, b, strict=True)])


#: Characters of the shorter text up to which its places are bits of one machine word.
WORD_BITS = 64


def _matches(short: str, long: str) -> np.ndarray:
    """For each character of the longer text the places in the shorter one that hold it, as bits; no bits on the places before and after."""
    a, b = (np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in (short, long))
    bits = (b[:, None] == a[None, :]) @ (np.uint64(1) << np.arange(len(a), dtype=np.uint64))
    return np.pad(bits.astype(np.uint64), len(a) - 1)


def _common_lengths(matches: np.ndarray, size: int) -> np.ndarray:
    """Longest common subsequence of a text of ``size`` places with every window of as many characters, bit-parallel in all windows at once."""
    lanes = max(0, len(matches) - size + 1)
    state = np.full(lanes, ~np.uint64(0))
    for step in range(size):
        met = state & matches[step : step + lanes]
        state = (state + met) | (state - met)
    return np.bitwise_count(~state & np.uint64((1 << size) - 1))


def _common_length(short: str, window: str) -> int:
    """The same for one window and a text of any length, with whole numbers as bits."""
    held: dict[str, int] = {}
    for place, c in enumerate(short):
        held[c] = held.get(c, 0) | 1 << place
    full = (1 << len(short)) - 1
    state = full
    for c in window:
        met = state & held.get(c, 0)
        state = ((state + met) | (state - met)) & full
    return len(short) - state.bit_count()


def _best_window(lengths: np.ndarray, size: int, n: int) -> float:
    """The best ratio of windows that begin ``size`` - 1 places before the longer text and move on to its end, cut at both ends."""
    starts = np.arange(len(lengths)) - (size - 1)
    windows = np.minimum(starts + size, n) - np.maximum(starts, 0)
    return 200.0 * float((lengths / (size + windows)).max())


def best_partial_ratios(pairs: list[tuple[str, str]]) -> list[float]:
    """0 to 100 per pair: 200 * (common subsequence) / (both lengths), of the shorter text and its best window in the longer one.

    Windows have the shorter text's length, or less at both ends.  Of two texts
    of one length each is tried as the window.  Two empty texts have 100, one
    has 0.
    """
    out = [100.0 if not (a or b) else 0.0 for a, b in pairs]
    by_size: dict[int, list[tuple[int, str, str]]] = {}
    for i, (a, b) in enumerate(pairs):
        short, long = (a, b) if len(a) <= len(b) else (b, a)
        if short:
            by_size.setdefault(len(short), []).append((i, short, long))
            if len(short) == len(long):
                by_size[len(short)].append((i, long, short))
    for size, jobs in by_size.items():
        if size > WORD_BITS:
            for i, short, long in jobs:
                windows = (long[max(0, at) : at + size] for at in range(1 - size, len(long)))
                out[i] = max(out[i], max(200.0 * _common_length(short, w) / (size + len(w)) for w in windows))
            continue
        parts = [_matches(short, long) for _, short, long in jobs]
        lengths = _common_lengths(np.concatenate(parts), size)
        at = 0
        for (i, _, long), part in zip(jobs, parts, strict=True):
            out[i] = max(out[i], _best_window(lengths[at : at + len(long) + size - 1], size, len(long)))
            at += len(part)
    return out


@F.pandas_udf(DoubleType())
def _partial(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        # bounded groups, as each holds a number per character of its longer texts
        rows = list(zip(a, b, strict=True))
        yield pd.Series([r for i in range(0, len(rows), 500) for r in best_partial_ratios(rows[i : i + 500])], dtype="float64")


@F.pandas_udf(IntegerType())
def _substring(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([SequenceMatcher(None, x, y, autojunk=False).find_longest_match().size for x, y in zip(a, b, strict=True)])


def seq_ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp ratio of the folded texts."""
    return _ratios(ascii_fold(a), ascii_fold(b))


def token_sort_ratio(a: Column, b: Column) -> Column:
    return _ratios(F.array_join(F.array_sort(tokens(a)), " "), F.array_join(F.array_sort(tokens(b)), " "))


def partial_ratio(a: Column, b: Column) -> Column:
    """0 to 100: the ratio of the shorter text to its best window in the longer one, see ``best_partial_ratios``."""
    return _partial(normalize_text(a), normalize_text(b))


def longest_common_substring(a: Column, b: Column) -> Column:
    return _substring(normalize_text(a), normalize_text(b))


def on_distinct_pairs(df: DataFrame, left: str, right: str, **features: Callable[[Column, Column], Column]) -> DataFrame:
    """Add features of (left, right) computed once per distinct pair of texts and joined back."""
    pairs = df.select(left, right).distinct().withColumns({name: f(F.col(left), F.col(right)) for name, f in features.items()})
    same = F.col(f"l.{left}").eqNullSafe(F.col(f"r.{left}")) & F.col(f"l.{right}").eqNullSafe(F.col(f"r.{right}"))
    return df.alias("l").join(pairs.alias("r"), same, "left").select("l.*", *(f"r.{n}" for n in features))
