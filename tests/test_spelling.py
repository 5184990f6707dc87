"""Spelling by deletions, partial ratios over all windows and text variants, each against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from quillon.functions.similarity import best_partial_ratios, partial_ratio
from quillon.operators import forensics


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize(("distance", "prefix"), [(1, 4), (2, 4), (2, 10)])
def test_spelling_finds_what_a_comparison_with_all_words_finds(spark, distance, prefix):
    draw = random.Random(prefix)
    word = lambda: "".join(draw.choice("abcdé") for _ in range(draw.randint(0, 9)))
    dictionary = {word(): draw.randint(1, 4) for _ in range(120)} | {"abcdabcdabcdabcd": 2, "abcdabcdabcdabdc": 2}
    asked = [word() for _ in range(150)] + ["abcdabcdabcdabc", "zzzzzz", None, "", "abc", "abc"]
    table = spark.createDataFrame([*dictionary.items(), (None, 9)], "word string, n int")
    found = forensics.nearest_spelling(spark.createDataFrame([(w,) for w in asked], "word string"), "word", table, distance, prefix).collect()
    assert len(found) == len(set(asked))
    for r in found:
        near = sorted((edits(r.word, w), -n, w) for w, n in dictionary.items() if edits(r.word, w) <= distance) if r.word is not None else []
        assert (r.corrected, r.edits) == ((near[0][2], near[0][0]) if near else (r.word, -1))


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for j, y in enumerate(b, 1):
            row.append(before[j - 1] + 1 if x == y else max(before[j], row[-1]))
    return row[-1]


def all_windows(a, b):
    if not a or not b:
        return 100.0 if a == b else 0.0
    best = 0.0
    for short, long in ([(a, b)] if len(a) < len(b) else [(b, a)] if len(b) < len(a) else [(a, b), (b, a)]):
        for start in range(1 - len(short), len(long)):
            w = long[max(0, start) : start + len(short)]
            best = max(best, 200.0 * common(short, w) / (len(short) + len(w)))
    return best


def test_partial_ratio_is_the_best_of_all_windows(spark):
    draw = random.Random(4)
    text = lambda n: "".join(draw.choice("abcü 𝒳") for _ in range(n))
    pairs = [(text(draw.randint(0, 12)), text(draw.randint(0, 30))) for _ in range(400)]
    pairs += [(text(n), text(m)) for n, m in ((63, 90), (64, 70), (65, 80), (70, 70), (1, 1), (5, 300))]
    expected = [all_windows(a, b) for a, b in pairs]
    assert best_partial_ratios(pairs) == pytest.approx(expected)
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate([("nike", "beyaz nike ayakkabı"), ("nikee", "nike"), (None, "x"), ("", None)])], "i int, a string, b string")
    got = {r.i: r.p for r in rows.select("i", partial_ratio(F.col("a"), F.col("b")).alias("p")).collect()}
    assert got == {0: 100.0, 1: 100.0, 2: 0.0, 3: 100.0}


def test_variants_are_the_same_under_any_partitioning(spark):
    rows = [(i, f"red shoe number {i} fits well", i) for i in range(40)] + [(90, "one", 0), (91, None, 0), (92, "", 0), (None, "red shoe here", 0), (3, "red shoe number 3 fits well", 7)]
    table = spark.createDataFrame(rows, "id bigint, text string, copy_of int")
    synonyms = spark.createDataFrame([("red", "crimson"), ("red", "scarlet"), ("shoe", "boot"), ("absent", "x")], "word string, synonym string")
    kept = None
    for parts in (1, 7):
        out = sorted((tuple(r) for r in forensics.augmented_texts(table.repartition(parts), "id", "text", synonyms, copies=3, dropout=0.3, seed="s").collect()), key=str)
        assert kept in (None, out)
        kept = out
    known = {"red": ["crimson", "scarlet"], "shoe": ["boot"]}
    expected = [(i, t, c, n, v) for i, t, c in rows for n, v in forensics._Variants().eval(None if i is None else str(i), t, known, 3, 0.3, "s")]
    assert kept == sorted(expected, key=str)
    held = {r[0] for r in kept}
    assert len(held) > 30 and not {91, 92} & held
    for _, text, _, n, variant in kept:
        assert 1 <= n <= 3 and variant != text
        at = iter(text.split())
        assert all(any(w == x or w in known.get(x, []) for x in at) for w in variant.split())
