"""Stored indexes: the hits of a search of the texts, after a reload too, and blocks that are left unread."""

import random

import pytest

from quillon.operators.index_store import HybridIndex, LexicalIndex, build_hybrid, build_lexical, versioned
from quillon.operators.retrieval import bm25_search

ITEMS = [(1, "erkek deri ceket siyah"), (2, "kadın elbise kırmızı"), (3, "bebek zıbın pamuk")]


def corpus(n=600, seed=3):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(draw.choices(words, weights, k=draw.choice([5, 20, 200])))) for i in range(n)]
    return [*docs, (n, None), (n + 1, ""), (n + 2, docs[0][1]), (n + 3, docs[0][1])]


def hits(df, places=5):
    return sorted((r.q, r.doc_id, round(r.bm25, places), r["rank"]) for r in df.collect())


@pytest.mark.parametrize("k", [1, 10, 700])
def test_stored_search_equals_a_search_of_the_texts(spark, tmp_path, k):
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string")
    asked = spark.createDataFrame([(1, "w0 w250 w299"), (2, "w3 w3 w7"), (3, "w40"), (4, None), (5, "none of these"), (6, "w199 w120 w0 w1")], "q bigint, question string")
    build_lexical(docs, "doc_id", "text", str(tmp_path / "index"), block_docs=16)
    index = LexicalIndex(spark, str(tmp_path / "index"))
    args = docs, asked, "doc_id", "text", "q", "question", k
    assert hits(index.search(asked, "q", "question", k)) == hits(bm25_search(*args).select("q", "doc_id", "bm25", "rank"))
    known = spark.createDataFrame([(1, r.doc_id) for r in bm25_search(*args).where("q = 1 AND rank <= 3").collect()], "q bigint, doc_id bigint")
    assert hits(index.search(asked, "q", "question", k, excluded=known)) == hits(bm25_search(*args, known).select("q", "doc_id", "bm25", "rank"))


def test_blocks_that_cannot_reach_the_last_hit_are_not_read(spark, tmp_path):
    docs = spark.createDataFrame(corpus(2000), "doc_id bigint, text string")
    asked = spark.createDataFrame([(i, f"w{i} w{i + 200}") for i in range(5)], "q bigint, question string")
    blocks, _ = build_lexical(docs, "doc_id", "text", str(tmp_path / "index"), block_docs=16).reading(asked, "q", "question", 5)
    rows = blocks.collect()
    assert len(rows) > 300 and sum(r.read for r in rows) < len(rows) * 0.6


def test_hybrid_index_is_stable_after_a_reload(spark, tmp_path):
    docs = spark.createDataFrame(ITEMS, "item_id bigint, title string")
    index = build_hybrid(docs, "item_id", "title", str(tmp_path), dims=2)
    asked = spark.createDataFrame([(1, "erkek deri ceket")], "q bigint, question string")
    found = [r.asDict() for r in index.search(asked, "q", "question", 2).collect()]
    again = HybridIndex(spark, index.folder)
    assert [r.asDict() for r in again.search(asked, "q", "question", 2).collect()] == found
    assert found[0]["item_id"] == 1 and found[0]["bm25_rank"] == found[0]["dense_rank"] == 1
    assert again.dense(asked, "q", "question", 3).where("rank = 1").first().item_id == 1


def test_folders_carry_the_configuration():
    a, b = versioned("/x/", "My Model/v1", {"k": 1, "b": 2}), versioned("/x", "My Model/v1", {"b": 2, "k": 1})
    assert a == b and a.startswith("/x/my_model_v1/") and len(a.rsplit("/", 1)[1]) == 12
    assert a != versioned("/x", "My Model/v1", {"k": 2, "b": 2})


def test_empty_tables(spark, tmp_path):
    none = build_lexical(spark.createDataFrame([], "doc_id bigint, text string"), "doc_id", "text", str(tmp_path / "none"))
    asked = spark.createDataFrame([(1, "w0")], "q bigint, question string")
    assert none.search(asked, "q", "question", 3).collect() == []
    blank = build_lexical(spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string"), "doc_id", "text", str(tmp_path / "blank"))
    assert blank.n == 2 and blank.search(asked, "q", "question", 3).collect() == []


def test_a_block_of_documents_gives_its_lists_without_a_row_per_token():
    import pyarrow as pa

    from quillon.operators.index_store import _lists

    texts = [["b", "a", "b"], [], ["a"], ["a", "c"]]
    group = pa.table({"block": pa.array([5] * 4), "number": pa.array([12, 10, 11, 13]), "docs": pa.array([7, 8, 7, 9]), "dl": pa.array([3, 0, 1, 2], pa.int32()), "t": pa.array(texts, pa.list_(pa.string()))})
    weight = lambda tf, dl: tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / 1.5))
    got = {r["term"]: r for r in _lists(1.5, 1.5, 0.75)(group).to_pylist()}
    assert {t: (r["block"], r["docs"], r["tf"], r["dl"]) for t, r in got.items()} == {"a": (5, [7, 7, 9], [1, 1, 1], [1, 3, 2]), "b": (5, [7], [2], [3]), "c": (5, [9], [1], [2])}
    assert [got[t]["most"] for t in "abc"] == pytest.approx([weight(1, 1), weight(2, 3), weight(1, 2)])
    assert _lists(1.5, 1.5, 0.75)(group.slice(1, 1)).num_rows == 0
