"""Periodic runs against a direct search, and against SQL on the smallest tables."""

import os
import random
import zlib

import pytest
from pyspark.sql import types as T

from quillon.llm import periodic_runs, queries
from quillon.llm.periodic_runs import find_runs, runs_of


def direct(words, least=6, exponent=4):
    """Every stretch of every period, kept where no smaller period fits it."""
    n, found = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                part = words[i : j + q]
                if min(d for d in range(1, q + 1) if part[d:] == part[:-d]) == q:
                    found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def texts(seed, n):
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        words = [str(draw.randrange(draw.choice([1, 2, 3, 40]))) for _ in range(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 3)):
            period = draw.randint(1, 9)
            cycle = [str(draw.randrange(5)) for _ in range(period)]
            at = draw.randint(0, len(words))
            words[at:at] = (cycle * draw.randint(3, 9))[: -draw.randint(1, period)]
        out.append(words)
    return out


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (1, 2), (5, 3), (20, 2)])
def test_runs_are_those_of_a_direct_search(least, exponent):
    drawn = texts(least, 400)
    groups = [drawn[i : i + 7] for i in range(0, len(drawn), 7)]
    for group in groups:
        assert runs_of([[w.encode() for w in t] for t in group], least, exponent) == [direct(t, least, exponent) for t in group]


def test_ranges_of_lags_find_what_one_scan_finds():
    words = [w.encode() for w in ("a b c " * 30 + "d " * 40 + "x y " * 25 + "a b c " * 4).split()]
    whole = set(runs_of([words])[0])
    parts = [set(runs_of([words], lags=(a, b))[0]) for a, b in ((1, 1), (2, 4), (5, 9), (10, 60))]
    assert set().union(*parts) == whole
    # a multiple of a period names the run by its smallest period
    assert (0, 90, 3) in parts[2]


def test_find_runs_gives_spans_and_the_text_without_repeats(spark):
    rows = [(1, "so so so so so so far", "x"), (2, None, "x"), (3, "", "x"), (4, "a\tb a b\na b a b  end", "x"), (1, "so so so so so so far", "x"), (None, "no run", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string")
    got = sorted(find_runs(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    found = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got]
    so = (1, 7, [(0, 6, 1)], "so far")
    assert found == [so, so, (2, 0, [], ""), (3, 0, [], ""), (4, 9, [(0, 8, 2)], "a b end"), (None, 2, [], "no run")]


def test_long_texts_are_dealt_by_lags_with_the_same_result(spark):
    drawn = [" ".join(t) for t in texts(9, 40)] + ["w " * 3000 + "z", " ".join(map(str, range(150))) + " " + "p q r " * 90]
    docs = spark.createDataFrame([*enumerate(drawn), (0, drawn[0]), (None, drawn[-1]), (77, None)], "doc_id bigint, text string")
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    whole = sorted(find_runs(docs).collect(), key=key)
    for range_lags in (4, 64, periodic_runs.RANGE):
        assert sorted(find_runs(docs, long_bytes=20, range_lags=range_lags).collect(), key=key) == whole


def test_empty_table_and_other_keys(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert find_runs(empty).collect() == []
    named = spark.createDataFrame([("k", "a " * 9)], "name string, body string")
    got = find_runs(named, "name", "body").collect()
    assert [(r.name, r.n_words, r.collapsed) for r in got] == [("k", 9, "a")]
    with pytest.raises(ValueError):
        find_runs(named, "name", "body", exponent=1)


def planted(doc_id, text):
    words = (text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_planted_runs_repeat_a_stretch_in_a_tenth_of_the_texts(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 50))) for i in range(200)] + [(9, None), (None, "some words stay")]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    got = queries.planted_runs(spark.createDataFrame(rows, schema)).collect()
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(200)) > 5
    for r, (doc_id, text) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text is None)), sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None)), strict=True):
        assert (r.text or "").split() == (planted(doc_id, text) if doc_id is not None else text.split())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables are absent")
def test_query_agrees_with_a_direct_search(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    texts_of = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    for r in queries.op11_periodic_runs(spark, sf).collect():
        words = planted(r.doc_id, texts_of[r.doc_id])
        if len(words) > 1500:
            continue
        runs = direct(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r.start, r.length, r.period) == best
        assert r.n_runs == len(runs)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        gone = {i for a, b, c in runs for i in range(a + c, a + b)}
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()
