"""Ranked lexical search: document-at-a-time merging of compressed postings, shard by shard.

``build_index`` writes the documents as shards of a bounded size: per term the
numbers of its documents in order of their ids, as differences, and the counts
of the term, both in bytes of seven bits; and per shard the ids and lengths.
``search`` joins the terms that are asked for with their postings, and one task
per shard and block of items merges each item's lists with a heap over their
next documents.  A result heap of bounded size, keyed by score and then id,
gives a bound that lists of small weight cannot reach alone; these are then
looked up for the documents of the other lists only.  The best of all shards
are ranked together.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Bytes of text of a shard.
SHARD = 1 << 24
#: Items that meet a shard's postings in one task.
ITEM_BLOCK = 1024
#: Terms of items, repeats counted, up to which they are broadcast.
BROADCAST_TERMS = 300_000

#: A term is a maximal match of this; only A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BREAKS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode().translate(_BREAKS).split() if text else []


def packed(values: np.ndarray) -> bytes:
    """Non-negative integers in bytes of seven bits, the last byte of each without the high bit."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        size += values >= np.uint64(1) << np.uint64(bits)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for place in range(int(size.max()) if len(size) else 0):
        held = size > place
        more = (size[held] > place + 1).astype(np.uint8) << 7
        out[(ends - size)[held] + place] = (values[held] >> np.uint64(7 * place) & np.uint64(127)).astype(np.uint8) | more
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """The integers that ``packed`` wrote."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    last = raw < 128
    start = np.append(0, np.flatnonzero(last)[:-1] + 1)
    place = np.arange(len(raw)) - np.repeat(start, np.diff(np.append(start, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), start)


INDEX = "shard bigint, term string, df bigint, docs binary, counts binary, n_terms bigint, ids array<bigint>, lengths binary"


def _shard_rows(shard: int, ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
    """A shard's postings, one row per term in order, and first a row without a term that has its documents."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    texts = [texts[i] for i in order]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    names = sorted(set(chain.from_iterable(texts)))
    number = {w: n for n, w in enumerate(names)}
    codes = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, int(lengths.sum()))
    pairs = codes * len(texts) + np.repeat(np.arange(len(texts)), lengths)
    pairs, counts = np.unique(pairs, return_counts=True)
    term, doc = np.divmod(pairs, max(len(texts), 1))
    first = np.searchsorted(term, np.arange(len(names) + 1))
    gaps = np.diff(doc, prepend=0)
    starts = first[:-1]
    gaps[starts] = doc[starts]

    def cut(values: np.ndarray) -> list[bytes]:
        # all lists are written at once and parted where a list's last value ends
        data = packed(values)
        ends = np.append(0, np.flatnonzero(np.frombuffer(data, np.uint8) < 128) + 1)[first]
        return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    columns = [
        pa.array([shard] * (len(names) + 1), pa.int64()),
        pa.array([None, *(w.decode() for w in names)], pa.string()),
        pa.array([int(np.count_nonzero(lengths)), *np.diff(first).tolist()], pa.int64()),
        pa.array([None, *cut(gaps)], pa.binary()),
        pa.array([None, *cut(counts)], pa.binary()),
        pa.array([int(lengths.sum()), *[None] * len(names)], pa.int64()),
        pa.array([[ids[i] for i in order], *[None] * len(names)], pa.list_(pa.int64())),
        pa.array([packed(lengths), *[None] * len(names)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "term", "df", "docs", "counts", "n_terms", "ids", "lengths"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD) -> DataFrame:
    """Postings of all terms of every row's whole text, in shards of about ``shard_bytes`` of text.

    Rows with a term are its postings in a shard, as far as ``search`` reads
    them; a row without one lists the shard's document ids in order with their
    lengths in terms, and its ``df`` counts those that have any.  Shards are
    numbered by task, so write the result before it is searched.

    A null or empty text has no terms.  Repeated rows are documents of their
    own; a null id comes after all others.  A text longer than a shard makes a
    shard of its own.  An empty table gives an empty index.  Ids must be
    integers.  Other columns are not read.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, held = common.task_number() << 40, [], [], 0
        for group in common.text_groups(batches):
            ids += group.column("id").to_pylist()
            some = group.column("text").to_pylist()
            texts += [terms_of(t) for t in some]
            held += sum(len(t) for t in some if t)
            if held >= shard_bytes:
                yield _shard_rows(number, ids, texts)
                number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield _shard_rows(number, ids, texts)

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(shards, INDEX)


class Postings:
    """One term's documents of a shard, in order, and what each adds to a score."""

    def __init__(self, docs: np.ndarray, adds: np.ndarray) -> None:
        self.most = int(adds.max())
        self.adds_in_order = np.sort(adds)[::-1]
        self.docs, self.adds = docs.tolist(), adds.tolist()


def best_documents(lists: list[Postings], k: int) -> list[tuple[int, int]]:
    """(score, document) of the ``k`` best documents with a score above 0, the smaller document of equal scores first.

    Documents come in rising order, so a later one of an equal score is never
    better.  Lists whose largest sums cannot exceed the k-th score are looked
    up, and the rest are merged by a heap of their next documents.
    """
    lists = sorted((x for x in lists if x.most > 0), key=lambda x: x.most)
    reach = np.cumsum([x.most for x in lists]).tolist()
    # k documents of one list score as much as its k-th largest part at least
    bound = max((int(x.adds_in_order[k - 1]) for x in lists if len(x.docs) >= k), default=0)
    bound = max(bound - 1, 0)
    best: list[tuple[int, int]] = []

    def looked_up() -> int:
        return next((n for n, r in enumerate(reach) if r > bound), len(lists))

    first = looked_up()
    places = [0] * len(lists)
    heap = [(x.docs[0], n) for n, x in enumerate(lists) if n >= first]
    heapq.heapify(heap)
    while heap:
        doc, score = heap[0][0], 0
        while heap and heap[0][0] == doc:
            n = heap[0][1]
            if n < first:
                heapq.heappop(heap)
                continue
            one, at = lists[n], places[n]
            score += one.adds[at]
            at += 1
            places[n] = at
            if at < len(one.docs):
                heapq.heapreplace(heap, (one.docs[at], n))
            else:
                heapq.heappop(heap)
        for n in range(first - 1, -1, -1):
            if score + reach[n] <= bound:
                break
            one = lists[n]
            at = places[n]
            if at < len(one.docs) and one.docs[at] < doc:
                at = places[n] = bisect_left(one.docs, doc, at + 1)
            if at < len(one.docs) and one.docs[at] == doc:
                score += one.adds[at]
        if score <= bound:
            continue
        if len(best) < k:
            heapq.heappush(best, (score, -doc))
        else:
            heapq.heapreplace(best, (score, -doc))
        if len(best) == k and best[0][0] > bound:
            bound = best[0][0]
            first = looked_up()
    return sorted(((s, -d) for s, d in best), key=lambda x: (-x[0], x[1]))


def _items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, terms): the distinct terms of each distinct pair of id and text."""
    # a lower-case copy in which A to Z alone are changed; other letters keep their case
    folded = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    named = items.select(F.col(item_id).alias("item"), F.array_distinct(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))).alias("terms")).where(F.size("terms") > 0)
    return named.distinct()


def search(index: DataFrame, items: DataFrame, k: int = 10, item_id: str = "item_id", text: str = "text", block: int = ITEM_BLOCK) -> DataFrame:
    """(item, rank, doc_id, score): each item's ``k`` best documents of an index that ``build_index`` made and that was written.

    With N documents that have terms, L terms in all of them, and for a term df
    documents, a document of n terms that holds it tf times gets
    w * ((1000000000 * tf) div (1000 * tf + 8 * m)) for it, where
    w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))) and
    m = 10 + (90 * n * N) div L.  A score sums these over the item's distinct
    terms, in 64-bit integers.  Documents of score 0 are left out, equal scores
    go by ascending id.

    Items with a null or empty text, or without a known term, give no rows, and
    so does an empty index.  Repeated items give their rows once; items of one id
    and different texts are ranked each for itself.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    asked = _items(items, item_id, text)
    key_type = asked.schema["item"].dataType
    kind = to_arrow_type(key_type)
    shards = index.where("term IS NULL").select("shard", "df", "n_terms", "ids", "lengths")
    totals = shards.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("docs"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = totals.docs, totals.terms
    size = asked.agg(F.count("*").alias("items"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
    blocks = max(1, -(-size.items // block))
    near = F.broadcast if size.terms <= BROADCAST_TERMS else lambda df: df

    # one row per block of items and term, with the items of the block that ask for it
    asker = F.struct("item", F.xxhash64("terms").alias("text"))
    placed = asked.select(F.pmod(F.xxhash64("item", "terms"), F.lit(blocks)).alias("block"), asker.alias("asker"), F.explode("terms").alias("term"))
    wanted = placed.groupBy("block", "term").agg(F.collect_list("asker").alias("askers"))
    known = index.where("term IS NOT NULL")
    held = known.select("term", "df").join(near(placed.select("term").distinct()), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = wanted.join(held, "term").select("term", "block", "askers", weight.alias("weight"))
    met = known.select("shard", "term", "docs", "counts").join(near(weighted), "term")
    # every block meets the documents of every shard, as its items are asked of all of them
    every = shards.select("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"), "ids", "lengths")
    both = met.unionByName(every, allowMissingColumns=True)
    names = ["item", "text", "doc_id", "score"]

    def merged(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        ids = next(r["ids"] for r in rows if r["term"] is None)
        n = unpacked(next(r["lengths"] for r in rows if r["term"] is None))
        norm = 8 * (10 + 90 * n * n_docs // max(n_terms, 1))
        of_item: dict[tuple, list[Postings]] = {}
        for r in rows:
            if r["term"] is None:
                continue
            docs, tf = np.cumsum(unpacked(r["docs"])), unpacked(r["counts"])
            one = Postings(docs, r["weight"] * (1_000_000_000 * tf // (1000 * tf + norm[docs])))
            for a in r["askers"]:
                of_item.setdefault((a["item"], a["text"]), []).append(one)
        found = [(item, text, ids[doc], score) for (item, text), lists in of_item.items() for score, doc in best_documents(lists, k)]
        columns = [pa.array([f[0] for f in found], kind), *(pa.array([f[i] for f in found], pa.int64()) for i in (1, 2, 3))]
        return pa.Table.from_arrays(columns, names=names)

    hits = both.groupBy("shard", "block").applyInArrow(merged, f"item {key_type.simpleString()}, text bigint, doc_id bigint, score bigint")
    in_order = Window.partitionBy("item", "text").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", shard_bytes: int = SHARD, block: int = ITEM_BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the index of ``docs``, written for this search alone, searched for ``items``; see both functions."""
    with common.Scratch(docs.sparkSession) as scratch:
        index = scratch.written(build_index(docs, id_col, text_col, shard_bytes), "postings")
        found = common.written(search(index, items, k, item_id, item_text, block), "ranked")
    return found.withColumnRenamed("item", item_id)
