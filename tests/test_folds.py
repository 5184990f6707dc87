"""Balanced folds by group against dealing one group after the other."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillon.operators import folds as G


def one_by_one(groups, k, seed="0"):
    """{group: fold} of groups given as {group: size}."""
    number = lambda g: int(hashlib.md5(f"{seed}:{'' if g is None else g}".encode()).hexdigest()[:8], 16)
    loads, fold = [0] * k, {}
    for g in sorted(groups, key=lambda g: (-groups[g], number(g), "" if g is None else str(g))):
        fold[g] = loads.index(min(loads))
        loads[fold[g]] += groups[g]
    return fold


@pytest.mark.parametrize(("seed", "k"), [(1, 2), (2, 3), (3, 5), (4, 7), (5, 5)])
def test_groups_go_where_dealing_one_by_one_puts_them(spark, seed, k):
    draw = random.Random(seed)
    groups = {g: draw.choice([1, 1, 1, 2, 3, 5, 8, draw.randint(1, 60)]) for g in range(draw.choice([1, 4, 60, 200]))}
    if seed == 5:
        groups = {None: 400, **groups}
    rows = spark.createDataFrame([(g, i) for g, n in groups.items() for i in range(n)], "g bigint, i int")
    dealt = G.balanced_group_folds(rows, "g", k).groupBy("g", "fold").agg(F.count("*").alias("n")).collect()
    assert {r.g: r.n for r in dealt} == groups and len(dealt) == len(groups)
    assert {r.g: r.fold for r in dealt} == one_by_one(groups, k)
    held = Counter()
    for r in dealt:
        held[r.fold] += r.n
    assert max(held.values()) - min(held[f] for f in range(k)) <= max(groups.values())


def test_loads_before_each_size_are_those_of_dealing_one_by_one():
    draw = random.Random(9)
    for _ in range(300):
        k = draw.randint(1, 6)
        sizes = sorted(draw.sample(range(1, 40), draw.randint(1, 12)), reverse=True)
        counts = [(s, draw.randint(1, 9)) for s in sizes]
        loads, expected = [0] * k, []
        for size, n in counts:
            expected.append((size, list(loads)))
            for _ in range(n):
                loads[loads.index(min(loads))] += size
        assert G._loads(counts, k) == expected


def test_the_tail_holds_its_share_and_is_in_every_fold(spark):
    groups = {g: 1 + g // 10 for g in range(100)}
    rows = spark.createDataFrame([(g, i) for g, n in groups.items() for i in range(n)], "g bigint, i int")
    made = G.tail_folds(rows, "g", 4, share=0.3)
    tail = {r.g for r in made.where("tail").select("g").distinct().collect()}
    sizes = sorted(groups.values())
    total = sum(sizes)
    most = max((s for s in set(sizes) if sum(x for x in sizes if x <= s) <= 0.3 * total), default=0)
    assert tail == {g for g, n in groups.items() if n <= most}
    per = {(r.fold, r.tail): r.n for r in made.groupBy("fold", "tail").agg(F.count("*").alias("n")).collect()}
    assert len(per) == 8 and G.leaking_groups(made, "g").count() == 0
    parts = [per[f, True] for f in range(4)]
    assert max(parts) - min(parts) <= most
    assert G.balanced_group_folds(rows.limit(0), "g", 3).count() == 0
