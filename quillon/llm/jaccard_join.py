"""Exact n-gram Jaccard join by blocked sparse products.

The document by n-gram incidence is cut into blocks of columns.  A document
enters only the columns of its prefix, its rarest n-grams up to the number that
a linked partner must share one of; a counting sketch of fixed size ranks
n-grams from rare to common, so common passages stay out of the prefixes.  The
product within a block gives lists of documents that share a column, with the
place of the column in each document's order.  In the first column that two
documents share, what either has left after its place bounds their overlap, so
a pair whose places leave too little is discarded there, however many columns
it shares further on.

Each list first yields a star around its smallest id.  Pairs whose bit maps and
sizes prove too small an overlap are discarded.  Overlaps of each document with
the smallest of its stars' ids, summed over blocks of columns until what is left
cannot reach the bound, link most of a group of copies; its other stars count
only where they lie in another component by then.  A list that is not yet one
component has its members of different components compared in the same way:
discarded by place, bit map and size, else summed.  Copies are thus linked
without emitting the pairs of a group, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components, resalted, salted
from .words import mix, shingles

#: log2 of the cells of the counting sketch: 4 MB as ranks, whatever the input.
SKETCH_BITS = 22
_SEGMENTS = 256
#: Prefix entries that a block of columns holds on average.
BLOCK_ENTRIES = 60_000
#: Members of a list's smaller components that are compared with the whole list in one round.
LEADERS = 4096
#: Members of a list that one task compares with the list's leaders.
LIST_MEMBERS = 8192
#: Blocks of columns over which a pair's overlap is summed.
SUM_BLOCKS = 16
#: Bits of a document's short map, and of its whole map at most.
MAP_BITS, MOST_BITS = 1024, 1 << 22
#: Partners of one document that a task verifies.
PARTNERS = 512
FLUSH = 1 << 21
#: Ids that are broadcast at most (8 MB) to pick their rows out of a table; more of them are joined by a shuffle.
BROADCAST_IDS = 1 << 20


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts of n-gram cells, by segment, as sparse pairs or as an array, whichever is shorter."""
    cells = np.zeros(1 << SKETCH_BITS, np.int32)
    seen = False
    for group in common.text_groups(batches):
        sets, _ = shingles(group.column("text"))
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        if len(flat):
            seen = True
            cell, n = np.unique((flat >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), return_counts=True)
            cells[cell] += n.astype(np.int32)
    if not seen:
        return
    width = len(cells) // _SEGMENTS
    segments, blobs, sparse = [], [], []
    for s in range(_SEGMENTS):
        part = cells[s * width : (s + 1) * width]
        at = np.flatnonzero(part)
        if not len(at):
            continue
        segments.append(s)
        sparse.append(len(at) * 8 < width * 4)
        blobs.append(np.concatenate([at.astype(np.int32), part[at]]).tobytes() if sparse[-1] else part.tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(segments, pa.int32()), pa.array(sparse), pa.array(blobs, pa.binary())], names=["segment", "sparse", "cells"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = (1 << SKETCH_BITS) // _SEGMENTS
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, sparse, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            total = sums.setdefault(s, np.zeros(width, np.int64))
            x = np.frombuffer(blob, np.int32)
            if sparse:
                total[x[: len(x) // 2]] += x[len(x) // 2 :]
            else:
                total += x
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["segment", "cells"])


def rank_cells(rows: DataFrame) -> tuple[np.ndarray, int]:
    """A rank per sketch cell, 0 for all but markedly common ones, and the number of (document, n-gram) entries."""
    counted = rows.mapInArrow(_counts, "segment int, sparse boolean, cells binary").repartition(32, "segment").mapInArrow(_summed, "segment int, cells binary")
    cells = np.zeros(1 << SKETCH_BITS, np.int64)
    width = len(cells) // _SEGMENTS
    for row in counted.collect():
        cells[row.segment * width : (row.segment + 1) * width] = np.frombuffer(bytes(row.cells), np.int64)
    total = int(cells.sum())
    usual = 2 * (total / len(cells) + 32)
    return np.ceil(np.log2(np.maximum(cells / usual, 1.0))).astype(np.uint8), total


def _signature(ngrams: np.ndarray) -> tuple[int, int]:
    return int(mix(ngrams, 1).sum(dtype=np.uint64).astype(np.int64)), int(mix(ngrams, 2).sum(dtype=np.uint64).astype(np.int64))


def signatures(rows: DataFrame) -> DataFrame:
    """(id, n, s1, s2): the size of each row's n-gram set and a 128-bit hash of it."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in common.text_groups(batches):
            sets, _ = shingles(group.column("text"))
            s = [_signature(x) for x in sets]
            yield pa.RecordBatch.from_arrays([group.column("id"), pa.array([len(x) for x in sets], pa.int64()), pa.array([x[0] for x in s], pa.int64()), pa.array([x[1] for x in s], pa.int64())], names=["id", "n", "s1", "s2"])

    return rows.mapInArrow(signed, "id bigint, n bigint, s1 bigint, s2 bigint")


def _prefixes(ranks, percent: int, blocks: int):
    def prefixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, copies = ranks.value, set()
        held: list[tuple[np.ndarray, int, int]] = []
        size = 0
        for group in common.text_groups(batches):
            sets, _ = shingles(group.column("text"))
            for key, x in zip(group.column("id").to_pylist(), sets, strict=True):
                n = len(x)
                if not n or key is None or (s := _signature(x)) in copies:
                    continue
                copies.add(s)
                r = rank[x >> np.uint64(64 - SKETCH_BITS)]
                prefix = x if not r.any() else x[np.argsort(r, kind="stable")]
                prefix = prefix[: n - (percent * n + 99) // 100 + 1]
                held.append((prefix, key, n))
                size += len(prefix)
            if size >= FLUSH:
                yield _block_rows(held, blocks)
                held, size = [], 0
        if held:
            yield _block_rows(held, blocks)

    return prefixed


def _block_rows(held: list[tuple[np.ndarray, int, int]], blocks: int) -> pa.RecordBatch:
    columns = mix(np.concatenate([p for p, _, _ in held]), 7)
    lengths = [len(p) for p, _, _ in held]
    ids = np.repeat(np.array([k for _, k, _ in held], np.int64), lengths)
    n = np.repeat(np.array([n for _, _, n in held], np.int32), lengths)
    place = np.concatenate([np.arange(k, dtype=np.int32) for k in lengths])
    block = (columns % np.uint64(blocks)).astype(np.int32)
    order = np.argsort(block, kind="stable")
    block, ids, n, place = block[order], ids[order], n[order], place[order]
    short = (columns[order] >> np.uint64(32)).astype(np.uint32)
    first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    ends = np.append(first[1:], len(block))
    cut = [(a, b) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(block[first]), *(pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()) for x in (short, ids, n, place))],
        names=["block", "grams", "ids", "sizes", "places"],
    )


def needed(size, percent: int):
    """The least overlap that links two sets of ``size`` n-grams together."""
    return -(-percent * size // (100 + percent))


def _products(percent: int):
    """Of each block: star pairs (a, b) and the members (list, a, place) of lists of three or more."""

    def product(grams: np.ndarray, ids: np.ndarray, n: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((place, n, ids, grams))
        grams, ids, n, place = grams[order], ids[order], n[order], place[order]
        keep = np.append(True, (grams[1:] != grams[:-1]) | (ids[1:] != ids[:-1]) | (n[1:] != n[:-1]))
        grams, ids, n, place = grams[keep], ids[keep], n[keep], place[keep]
        first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
        length = np.diff(np.append(first, len(grams)))
        many = np.repeat(length > 1, length)
        ids, n, place, length = ids[many], n[many].astype(np.int64), place[many].astype(np.int64), length[length > 1]
        if not len(ids):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4, names=["list", "a", "b", "place"])
        first = np.cumsum(length) - length
        leader, size, left = np.repeat(ids[first], length), np.repeat(n[first], length), np.repeat(n[first] - place[first], length)
        ok = (leader != ids) & (np.minimum(left, n - place) >= needed(n + size, percent))
        pairs = np.unique(np.stack([leader[ok], ids[ok]], axis=1), axis=0)
        # lists with the same members are one list, each member at its least place
        members = np.add.reduceat(mix(ids.astype(np.uint64), 11), first) ^ length.astype(np.uint64)
        larger = np.repeat(length > 2, length)
        lists, ids, place = np.repeat(members.astype(np.int64), length)[larger], ids[larger], place[larger]
        order = np.lexsort((place, ids, lists))
        lists, ids, place = lists[order], ids[order], place[order]
        least = np.append(True, (lists[1:] != lists[:-1]) | (ids[1:] != ids[:-1]))[: len(lists)]
        lists, ids, place = lists[least], ids[least], place[least]
        a = np.concatenate([pairs[:, 0], ids])
        star = np.arange(len(a)) < len(pairs)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.zeros(len(pairs), np.int64), lists]), mask=star),
                pa.array(a),
                pa.array(np.concatenate([pairs[:, 1], np.zeros(len(lists), np.int64)]), mask=~star),
                pa.array(np.concatenate([np.zeros(len(pairs), np.int64), place]), mask=star),
            ],
            names=["list", "a", "b", "place"],
        )

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for block, grams, *rest in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if block != now:
                    if held:
                        yield product(*map(np.concatenate, zip(*held, strict=True)))
                    now, held = block, []
                held.append((np.frombuffer(grams, np.uint32), *(np.frombuffer(x, t) for x, t in zip(rest, (np.int64, np.int32, np.int32), strict=True))))
        if held:
            yield product(*map(np.concatenate, zip(*held, strict=True)))

    return products


def parities(ngrams: np.ndarray) -> np.ndarray:
    """A map of twice as many bits as n-grams or more: whether an even or odd number of n-grams falls on each bit."""
    bits = max(MAP_BITS, min(MOST_BITS, 1 << (2 * len(ngrams)).bit_length()))
    at = (ngrams & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).view(np.uint64)


def _mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to (id, text) the set size and the parity map of the set."""
    for group in common.text_groups(batches):
        sets, _ = shingles(group.column("text"))
        whole = [parities(x) for x in sets]
        maps = [np.bitwise_xor.reduce(m.reshape(-1, MAP_BITS // 64)).tobytes() for m in whole]
        yield pa.RecordBatch.from_arrays(
            [group.column("id"), group.column("text"), pa.array([len(x) for x in sets], pa.int64()), pa.array(maps, pa.binary()), pa.array([m.tobytes() for m in whole], pa.binary())],
            names=["id", "text", "n", "bits", "map"],
        )


def _pruned(percent: int):
    """Of pairs with sizes and whole maps: those whose overlap may be large enough."""

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n_a, n_b, map_a, map_b in zip(*(batch.column(c) for c in ("n_a", "n_b", "map_a", "map_b")), strict=True):
                x, y = (np.frombuffer(m.as_buffer(), np.uint64) for m in (map_a, map_b))
                short = min(len(x), len(y))
                # a longer map folds to a shorter one, as both hold parities
                apart = int(np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, short)) ^ np.bitwise_xor.reduce(y.reshape(-1, short))).sum())
                size = n_a.as_py() + n_b.as_py()
                shared = (size - apart) // 2
                keep.append(100 * shared >= percent * (size - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], names=["a", "b"])

    return prune


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets overlap enough: counts summed over blocks of columns, ended where the rest cannot decide."""
    least = needed(len(x) + len(y), percent)
    if not len(x) or not len(y) or min(len(x), len(y)) < least:
        return False
    if len(x) > len(y):
        x, y = y, x
    cut = np.linspace(0, len(x), min(SUM_BLOCKS, len(x)) + 1).astype(np.int64)
    at = np.append(np.searchsorted(y, x[cut[:-1]]), len(y))
    at[0] = 0
    shared = 0
    for i in range(len(cut) - 1):
        if shared + min(len(x) - int(cut[i]), len(y) - int(at[i])) < least:
            return False
        few, many = x[cut[i] : cut[i + 1]], y[at[i] : at[i + 1]]
        if len(many):
            place = np.searchsorted(many, few)
            place[place == len(many)] = 0
            shared += int(np.count_nonzero(many[place] == few))
        if shared >= least:
            return True
    return False


def _verified(percent: int):
    """Of rows (a, salt, role, id, text) sorted by a, salt and role: the pairs whose overlap links them."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, leaders = None, []
        for group in common.text_groups(batches):
            sets, _ = shingles(group.column("text"))
            a, b = [], []
            for key, salt, role, other, x in zip(*(group.column(c).to_pylist() for c in ("a", "salt", "role", "id")), sets, strict=True):
                if (key, salt) != now:
                    now, leaders = (key, salt), []
                if not role:
                    leaders.append(x)
                    continue
                if any(linked(x, y, percent) for y in leaders):
                    a.append(key)
                    b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return verify


def _having(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is among the distinct ``ids``, without moving the rows while the ids are few."""
    ids = common.written(ids, "ids")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, "id", "left_semi")


def links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets overlap enough.

    The text of ``a`` meets its partners in tasks of at most about ``PARTNERS``
    of them each, so a document with very many partners is dealt out.
    """
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("tasks"))
    dealt = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("tasks")).alias("salt"))
    wanted = dealt.select(F.col("b").alias("id"), "a", "salt", F.lit(1).alias("role")).union(dealt.select(F.col("a").alias("id"), "a", "salt", F.lit(0).alias("role")).distinct())
    own = _having(texts.select("id", "text"), pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    rows = wanted.join(own, "id").select("a", "salt", "role", "id", "text")
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", "role").mapInArrow(_verified(percent), "a bigint, b bigint").distinct()


def _split(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Members of the lists that are not one component yet.

    Beside each member: its component, the one that has most members in the
    list, how many lie outside that, and how many tasks the list is dealt to.
    """
    marked = members.join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    held = marked.groupBy("list", "component").agg(F.count("*").alias("m")).groupBy("list")
    sizes = held.agg(F.sum("m").alias("all"), F.max("m").alias("most"), F.max_by("component", F.struct("m", "component")).alias("main")).where("most < all")
    sizes = sizes.select("list", "main", (F.col("all") - F.col("most")).alias("outside"), F.ceil(F.col("all") / LIST_MEMBERS).alias("tasks"))
    return salted(marked, "id").join(resalted(sizes), ["list", "part"]).drop("part")


def _dealt(split: DataFrame, leaders: int) -> DataFrame:
    """The members of each list in tasks of about ``LIST_MEMBERS``, and with each of them the list's leaders.

    Leaders are the members outside the list's main component, where they are
    more than ``leaders`` about as many drawn by hash.
    """
    columns = ["component", "id", "n", "place", "bits"]
    member = split.select("list", F.pmod(F.xxhash64("id"), F.col("tasks")).alias("salt"), F.lit(1).alias("role"), *columns)
    drawn = split.where("component <> main").where(F.pmod(F.xxhash64("id", "list"), F.col("outside")) < leaders)
    return drawn.select("list", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tasks") - 1)).alias("salt"), F.lit(0).alias("role"), *columns).union(member)


def _crossed(percent: int):
    """Of dealt list members, leaders first: pairs of a leader and a member of different components that may link."""

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lead = None, []
        for batch in batches:
            lists, salts, roles = (batch.column(c).to_numpy() for c in ("list", "salt", "role"))
            start = np.flatnonzero(np.append(True, (lists[1:] != lists[:-1]) | (salts[1:] != salts[:-1]) | (roles[1:] != roles[:-1])))
            for i, j in zip(start.tolist(), [*start[1:].tolist(), len(lists)], strict=True):
                ids, comp, n, place = (batch.column(c).to_numpy()[i:j] for c in ("id", "component", "n", "place"))
                bits = np.frombuffer(b"".join(batch.column("bits").slice(i, j - i).to_pylist()), np.uint64).reshape(j - i, -1)
                part = (ids, comp, n, n - place, bits)
                if (lists[i], salts[i]) != now:
                    now, lead = (lists[i], salts[i]), []
                if not roles[i]:
                    lead.append(part)
                    continue
                for k in range(0, j - i, 512):
                    x = [v[k : k + 512] for v in part]
                    for whole in lead:
                        for g in range(0, len(whole[0]), 512):
                            y = [v[g : g + 512] for v in whole]
                            size = x[2][:, None] + y[2][None, :]
                            least = needed(size, percent)
                            # what either has left at the shared column, and the sizes within it, bound the overlap
                            ok = (x[1][:, None] != y[1][None, :]) & (np.minimum(x[3][:, None], y[3][None, :]) >= least)
                            r, c = np.nonzero(ok)
                            if not len(r):
                                continue
                            apart = np.bitwise_count(x[4][r] ^ y[4][c]).sum(axis=1, dtype=np.int64)
                            may = (size[r, c] - apart) // 2 >= least[r, c]
                            p, q = x[0][r[may]], y[0][c[may]]
                            if len(p):
                                found = np.unique(np.stack([np.minimum(p, q), np.maximum(p, q)], axis=1), axis=0)
                                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return cross


def join_components(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, ``n_shingles`` and ``component_id``, the least id reachable by links.

    Two texts link when 100 * intersection >= ``percent`` * union of their sets
    of five-word shingles.  A text without words has no link and is its own
    component.  Rows of one id count as one document with the links of each;
    a null id keeps a null component.  An empty table gives an empty result,
    other columns are not read, long texts count whole.  Ids are integers.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    ranks, total = rank_cells(rows)
    signed = common.written(signatures(rows), "signatures")
    copies = ["s1", "s2", "n"]
    alike = signed.where("n > 0 AND id IS NOT NULL").groupBy(*copies).agg(F.min("id").alias("rep"), F.count("*").alias("rows"))
    first = common.written(alike.where("rows > 1").drop("rows"), "copies")

    blocks = max(64, total * (100 - percent) // 100 // BLOCK_ENTRIES)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    prefixed = rows.mapInArrow(_prefixes(spark.sparkContext.broadcast(ranks), percent, blocks), "block int, grams binary, ids binary, sizes binary, places binary")
    found = common.written(prefixed.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(_products(percent), "list bigint, a bigint, b bigint, place bigint"), "products")

    # every id but the first of an exact copy stands for that first one; an id of several texts stands for itself and is linked to theirs
    own = salted(signed.where("n > 0 AND id IS NOT NULL"), "id").join(resalted(first), [*copies, "part"], "left").select("id", F.coalesce("rep", "id").alias("rep"))
    own = own.groupBy("id").agg(F.collect_set("rep").alias("reps"))
    own = common.written(own.where((F.size("reps") > 1) | (F.col("reps")[0] != F.col("id"))), "known")
    rep = own.where(F.size("reps") == 1).select("id", F.col("reps")[0].alias("rep"))
    several = own.where(F.size("reps") > 1).select(F.col("id").alias("a"), F.explode("reps").alias("b")).where("a <> b")
    known = lambda df, c: df.join(rep.select(F.col("id").alias(c), "rep"), c, "left").withColumn(c, F.coalesce("rep", c)).drop("rep")
    pairs = known(known(found.where("list IS NULL").select("a", "b").distinct(), "a"), "b").where("a <> b")
    pairs = common.written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    members = common.written(known(found.where("list IS NOT NULL").select("list", F.col("a").alias("id"), "place"), "id").groupBy("list", "id").agg(F.min("place").alias("place")), "lists")

    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(members.select("id")).distinct()
    texts = common.written(_having(rows, wanted).mapInArrow(_mapped, "id bigint, text string, n bigint, bits binary, map binary"), "texts")
    maps = texts.groupBy("id").agg(F.first("n").alias("n"), F.first("map").alias("map"), F.count("*").alias("rows"))

    def likely(df: DataFrame) -> DataFrame:
        """The pairs that maps and sizes leave; an id with several texts is never discarded."""
        side = lambda x: maps.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("map").alias(f"map_{x}"), F.col("rows").alias(f"rows_{x}"))
        both = df.join(side("a"), "a").join(side("b"), "b")
        alone = both.where("rows_a = 1 AND rows_b = 1").select("a", "b", "n_a", "n_b", "map_a", "map_b").mapInArrow(_pruned(percent), "a bigint, b bigint")
        return common.written(alone.union(both.where("rows_a > 1 OR rows_b > 1").select("a", "b")), "likely-pairs")

    pairs = likely(pairs)
    nearest = common.written(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "nearest-pairs")
    edges = common.written(links(nearest, texts, percent).union(several), "links")

    leaders, tested = LEADERS, nearest
    waiting: DataFrame | None = pairs.join(nearest, ["a", "b"], "left_anti")
    comp = common.written(components(edges), "components")
    while True:
        split = common.written(_split(members, comp).join(texts.select("id", "n", "bits"), "id"), "split-lists")
        dealt = _dealt(split, leaders).repartition(parts, "list", "salt").sortWithinPartitions("list", "salt", "role")
        crossed = dealt.mapInArrow(_crossed(percent), "a bigint, b bigint")
        if waiting is not None:
            # stars that the nearest ones have not brought into one component
            of = lambda x: comp.select(F.col("id").alias(x), F.col("component").alias(f"of_{x}"))
            apart = waiting.join(of("a"), "a", "left").join(of("b"), "b", "left").where("coalesce(of_a, a) <> coalesce(of_b, b)")
            crossed, waiting = crossed.union(apart.select("a", "b")), None
        more = common.written(crossed.distinct().join(tested, ["a", "b"], "left_anti"), "crossed")
        more = likely(more)
        if not more.isEmpty():
            edges = edges.union(common.written(links(more, texts, percent), "links"))
            tested = tested.union(more)
            comp = common.written(components(edges), "components")
        # where all members outside the main component were leaders, all pairs across components are tested
        if split.where(F.col("outside") > leaders).isEmpty():
            break
        leaders *= 16
    # a group of copies has the component of its first id; its rows are dealt to several tasks
    group = alike.join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    group = group.where("rows > 1 OR component <> rep").select(*copies, "component")
    out = salted(signed, "id").join(resalted(group), [*copies, "part"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
