"""Dense search by parts of a block, counts per distinct text, one row per drawn item, and a stored search that broadcasts no blocks."""

import hashlib
import random

import numpy as np

from quillon.operators import negatives, retrieval
from quillon.operators.index_store import build_lexical
from quillon.plans import relational


def test_blocks_are_scored_in_parts(spark, monkeypatch):
    for name, value in (("QUERY_BLOCK", 7), ("ITEM_BLOCK", 13), ("SCORED_QUERIES", 3)):
        monkeypatch.setattr(retrieval, name, value)
    vectors = np.random.default_rng(1).integers(-3, 4, (60, 5)).astype(float)
    rows = spark.createDataFrame([*((i, v.tolist()) for i, v in enumerate(vectors)), (99, None)], "id bigint, v array<double>")
    for skip in (False, True):
        got = retrieval.dense_search(rows, rows.where("id % 3 = 0"), 6, "id", "id", "v", skip_same_id=skip).collect()
        expected = {(q, r + 1): i for q in range(0, 60, 3) for r, (_, i) in enumerate(sorted((-float(vectors[q] @ vectors[i]), i) for i in range(60) if not (skip and i == q))[:6])}
        assert {(r["query"], r["rank"]): r["item"] for r in got} == expected


def test_texts_are_parsed_once(spark, tmp_path):
    part = [(i, "t", "x", "Brand#1", i % 3, 1.0) for i in range(3000)]
    spark.createDataFrame(part, "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    found = relational.attribute_value_counts(spark, str(tmp_path))
    assert sum(r.n for r in found.where("key = 'size'").collect()) == 3000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # the count of texts lies below the parser
    assert plan.count("count(1)") == 1 and "sum(n" in plan


def test_a_draw_meets_one_item(spark):
    draw = random.Random(2)
    items = spark.createDataFrame([(i,) for i in range(400)], "item bigint")
    positives = spark.createDataFrame([(draw.randrange(20), draw.randrange(400)) for _ in range(150)], "term bigint, item bigint")
    found = negatives.uniform_negatives(positives, items, "term", "item", 2)
    known = {(r.term, r.item) for r in positives.collect()}
    rows = found.collect()
    assert rows and not known & {(r.term, r.item) for r in rows} and max(r.place for r in rows) == 2
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1


def test_stored_search_broadcasts_no_blocks(spark, tmp_path):
    draw = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(f"w{draw.randrange(30)}" for _ in range(8))) for i in range(300)], "doc_id bigint, text string")
    asked = spark.createDataFrame([(q, f"w{q} w{q + 1} w7") for q in range(20)], "q bigint, question string")
    index = build_lexical(docs, "doc_id", "text", str(tmp_path / "index"), block_docs=16)
    _, scores = index.reading(asked, "q", "question", 5)
    assert "strategy=broadcast" not in scores._jdf.queryExecution().optimizedPlan().toString()
    hits = lambda df: {(r.q, r["rank"]): (r.doc_id, round(r.bm25, 5)) for r in df.collect()}
    assert hits(index.search(asked, "q", "question", 5)) == hits(retrieval.bm25_search(docs, asked, "doc_id", "text", "q", "question", 5))


def test_only_a_short_pair_draws_again(spark):
    """Draws by their rule, one at a time; pairs that the first draws serve are read from a table."""
    draw = random.Random(5)
    pairs = {(t, i) for t in range(6) for i in draw.sample(range(48), draw.choice([2, 20, 44]))}
    number = lambda *k: int(hashlib.md5(":".join(map(str, k)).encode()).hexdigest()[:8], 16)
    held = {}
    for i in range(48):
        held.setdefault(number(i) % 6, []).append(i)
    expected = set()
    for t, i in pairs:
        drawn = (held.get(number("0bucket", t, i, d) % 6) for d in range(8))
        found = dict.fromkeys(b[number("0slot", t, i, d) % len(b)] for d, b in enumerate(drawn) if b)
        expected |= {(t, i, x, n + 1) for n, x in enumerate([x for x in found if (t, x) not in pairs][:2])}
    made = negatives.uniform_negatives(spark.createDataFrame(sorted(pairs), "term int, item int"), spark.createDataFrame([(i,) for i in range(48)], "item int"), "term", "item", 2)
    assert {(r.term, r.positive, r.item, r.place) for r in made.collect()} == expected
    assert made.inputFiles()
