"""Vector lengths by buckets of terms, and searches whose queries and documents meet in blocks, against plain Python."""

import math
import random
import re
from collections import Counter

import pytest

from quillon.operators import retrieval, term_columns


def grams(text):
    t = re.findall(r"\w\w+", (text or "").lower())
    return Counter([*t, *(f"{a} {b}" for a, b in zip(t, t[1:]))])


def corpus(n=150, seed=3):
    draw = random.Random(seed)
    words = [f"wörd{i}" for i in range(60)]
    return [*((i, " ".join(draw.choices(words, [1 / (j + 1) for j in range(60)], k=draw.choice([3, 20, 90])))) for i in range(n)), (n, None), (n + 1, "a"), (n + 2, "lone text")]


@pytest.mark.parametrize("words", [100, 400_000])
def test_lengths_of_vectors(spark, monkeypatch, words):
    monkeypatch.setattr(term_columns, "BLOCK_WORDS", words)
    monkeypatch.setattr(term_columns, "BUCKET_LETTERS", 5_000)
    rows = corpus()
    tf = {i: grams(t) for i, t in rows}
    df = Counter(g for c in tf.values() for g in c)
    expected = {i: math.sqrt(sum((n * (math.log((1 + len(rows)) / (1 + df[g])) + 1)) ** 2 for g, n in c.items())) for i, c in tf.items()}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert term_columns.buckets_for(docs, "text")[1] > 1
    assert {r.doc_id: r.norm for r in term_columns.norms(docs, "doc_id", "text").collect()} == pytest.approx(expected)


def test_rows_of_one_key_share_a_length(spark):
    docs = spark.createDataFrame([(1, "red shoe"), (1, "blue coat"), (2, "green hat")], "doc_id bigint, text string")
    found = term_columns.norms(docs, "doc_id", "text").collect()
    assert {r.doc_id: r.norm for r in found} == pytest.approx({1: math.sqrt(6) * (math.log(2) + 1), 2: math.sqrt(3) * (math.log(2) + 1)})
    assert len(found) == 2


@pytest.mark.parametrize("k", [1, 4, 500])
def test_queries_and_documents_meet_in_blocks(spark, monkeypatch, k):
    monkeypatch.setattr(retrieval, "TERM_DOCS", 20)
    monkeypatch.setattr(retrieval, "TERM_QUERIES", 2)
    rows = corpus()
    rows += [(i + 1000, t) for i, t in rows[:40]]  # equal scores, of which the smaller id comes first
    asked = [(f"q{i}", " ".join(t.split()[:4])) for i, t in rows[:7] if t] + [("none", "nothing known"), ("null", None)]
    tf = {i: Counter(re.findall("[a-zA-ZçğıöşüÇĞİÖŞÜ0-9]+", (t or "").lower())) for i, t in rows}
    df, mean = Counter(g for c in tf.values() for g in c), sum(sum(c.values()) for c in tf.values()) / len(rows)
    idf = {g: math.log(1 + (len(rows) - n + 0.5) / (n + 0.5)) for g, n in df.items()}
    expected = {}
    for q, text in asked:
        found = [(-round(sum(idf[g] * c[g] * 2.5 / (c[g] + 1.5 * (0.25 + 0.75 * sum(c.values()) / mean)) for g in (text or "").split() if c[g]), 6), i) for i, c in tf.items()]
        expected |= {(q, i, r + 1): pytest.approx(-s, abs=2e-6) for r, (s, i) in enumerate(sorted(x for x in found if x[0] < 0)[:k])}
    docs, questions = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(asked, "q string, question string")
    out = retrieval.bm25_search(docs, questions, "doc_id", "text", "q", "question", k)
    assert {(r.q, r.doc_id, r["rank"]): r.bm25 for r in out.collect()} == expected
    known = out.where("rank = 1").select("q", "doc_id")
    assert retrieval.bm25_search(docs, questions, "doc_id", "text", "q", "question", k, known).join(known, ["q", "doc_id"]).count() == 0
    scored = retrieval.bm25_scores(docs, questions, "doc_id", "text", "q", "question", pairs=known).collect()
    assert {(r.q, r.doc_id, 1): r.bm25 for r in scored} == {x: s for x, s in expected.items() if x[2] == 1}
