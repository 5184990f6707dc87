"""Benchmark decontamination with an Aho-Corasick automaton.

Benchmark items become windows of ten consecutive normalised words.  All
windows form one automaton; a normalised text runs through it once, and every
occurrence maps back to word numbers and to offsets in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: A word is a run of ASCII letters and digits and of anything beyond ASCII.
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_LOWER = {upper: upper + 32 for upper in range(65, 91)}
#: Bytes of benchmark text in one automaton, which every worker holds in about 400 times the memory; more text makes more automata, one after the other.
AUTOMATON_BYTES = 1 << 20

SPAN = T.StructType([T.StructField(n, T.LongType()) for n in ("first", "last", "start", "end")])


def normalised(text: str) -> str:
    """Lower-case words with one space around each: ``' a b c '``; a single space if there is no word."""
    words = text.encode().translate(_FOLD).split()
    return f" {b' '.join(words).decode()} " if words else " "


def windows_of(text: str, size: int) -> list[str]:
    words = normalised(text).split(" ")[1:-1]
    if len(words) <= size:
        return [f" {' '.join(words)} "] if words else []
    return [f" {' '.join(words[i : i + size])} " for i in range(len(words) - size + 1)]


def automaton(items: list[tuple[str, str]], size: int):
    """Windows of all items; each ends in (length in words, ids of the items that have it)."""
    import ahocorasick

    holders: dict[str, dict[str, None]] = {}
    for key, text in items:
        for window in windows_of(text, size):
            holders.setdefault(window, {})[key] = None
    found = ahocorasick.Automaton()
    for window, keys in holders.items():
        found.add_word(window, (len(window), window.count(" ") - 1, tuple(keys)))
    if holders:
        found.make_automaton()
    return found if holders else None


def occurrences(found, text: str) -> tuple[list[tuple[int, int]], list[str]]:
    """Merged spans of word numbers (first and last, from 0) and the items seen, for one normalised text."""
    spans: list[tuple[int, int]] = []
    items: set[str] = set()
    word = at = 0
    if found is None:
        return [], []
    for end, (length, words, keys) in found.iter(text):
        # the space that ends the window follows as many words as there are spaces before it
        word += text.count(" ", at, end)
        at = end
        first, last = word - words, word - 1
        items.update(keys)
        while spans and first <= spans[-1][1] + 1:
            before = spans.pop()
            first, last = min(first, before[0]), max(last, before[1])
        spans.append((first, last))
    return spans, sorted(items)


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Words of ``docs`` inside any occurrence of a benchmark window.

    Returns id, ``n_words``, ``hits`` (array of first and last word and of
    ``start`` and ``end``, code points of the original text) and ``items``
    (sorted ids as strings).  Null and empty texts have no words; an item
    without words has no window; null item ids are taken as the text 'null'.
    Repeated documents are each judged alone.  No shuffle: the benchmark is cut
    into automata of at most ``AUTOMATON_BYTES`` of text, applied in turn.
    """
    spark = docs.sparkSession
    step = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(SPAN)), T.StructField("items", T.ArrayType(T.StringType()))])
    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text", "CAST(NULL AS bigint) AS n_words", "CAST(array() AS array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>) AS hits", "CAST(array() AS array<string>) AS items")
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("k"), F.coalesce(F.col(item_text_col), F.lit("")).alias("t"))
    shards: list[list[tuple[str, str]]] = [[]]
    held = 0
    for k, t in items.toLocalIterator():
        if held and held + len(t) > AUTOMATON_BYTES:
            shards.append([])
            held = 0
        shards[-1].append((k, t))
        held += len(t)
    for shard in shards:
        rows = rows.mapInArrow(_scan(spark.sparkContext.broadcast(shard), size), step)
    return rows.withColumnRenamed("id", id_col).drop("text")


def _scan(shard, size: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(shard.value, size)
        for group in common.text_groups(batches):
            n_words, all_hits, all_items = [], [], []
            for text, hits, items in zip(group.column("text").to_pylist(), group.column("hits").to_pylist(), group.column("items").to_pylist(), strict=True):
                folded = normalised(text or "")
                spans, seen = occurrences(found, folded)
                if hits:
                    spans = merged([*spans, *((h["first"], h["last"]) for h in hits)])
                n_words.append(folded.count(" ") - 1)
                all_hits.append(located(text, spans) if spans else [])
                all_items.append(sorted({*items, *seen}))
            yield pa.RecordBatch.from_arrays([group.column("id"), group.column("text"), pa.array(n_words, pa.int64()), pa.array(all_hits, group.schema.field("hits").type), pa.array(all_items, group.schema.field("items").type)], names=group.schema.names)

    return scan


def located(text: str, spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Spans of word numbers with their code points in the original text."""
    words = [m.span() for m in WORD.finditer(text.translate(_LOWER))]
    return [{"first": a, "last": b, "start": words[a][0], "end": words[b][1]} for a, b in spans]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out
