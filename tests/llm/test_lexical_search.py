"""Ranked lexical search against plain Python: lists, shards, blocks of items, ties and odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quillon.llm import lexical_search
from quillon.llm.lexical_search import Postings, best_documents, build_index, packed, search, terms_of, top_documents, unpacked


def test_packed_integers_come_back():
    draw = np.random.default_rng(1)
    for top in (1, 127, 128, 129, 1 << 14, 1 << 40, 1 << 62):
        values = np.append(draw.integers(0, top, 300), [0, top - 1, top])
        assert unpacked(packed(values)).tolist() == values.tolist()
    assert unpacked(packed(np.zeros(0, np.int64))).tolist() == []
    assert len(packed(np.arange(128))) == 128


def test_terms_are_the_patterns_matches():
    text = "Ab1-cÉ\x00İx_y z\n9.5 ~é~ \x7f中A"
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    assert [t.decode() for t in terms_of(text)] == re.findall(lexical_search.TERM, fold)
    assert terms_of(None) == terms_of("") == terms_of(" .\n") == []


@pytest.mark.parametrize("k", [1, 3, 10])
def test_merging_by_document_gives_the_best_of_all_sums(k):
    draw = random.Random(k)
    for _ in range(400):
        lists, total = [], Counter()
        for _ in range(draw.randint(0, 6)):
            docs = sorted(draw.sample(range(60), draw.randint(1, 60)))
            adds = [draw.randint(0, draw.choice([1, 3, 50])) for _ in docs]
            lists.append(Postings(np.array(docs), np.array(adds)))
            total.update(dict(zip(docs, adds, strict=True)))
        expected = sorted(((s, d) for d, s in total.items() if s > 0), key=lambda x: (-x[0], x[1]))[:k]
        assert best_documents(lists, k) == expected


def ranked(docs, items, k):
    """Scores of all documents for all items, as the docstring of ``search`` has them."""
    bags = [(i, Counter(t.decode() for t in terms_of(text))) for i, text in docs]
    full = [b for _, b in bags if b]
    n_docs, n_terms = len(full), sum(sum(b.values()) for b in full)
    df = Counter(t for b in full for t in b)
    out = []
    for item, text in {(i, frozenset(t.decode() for t in terms_of(text))) for i, text in items}:
        scored = []
        for doc, bag in bags:
            score = 0
            for t in text:
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 10 + 90 * sum(bag.values()) * n_docs // n_terms
                    score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def table():
    draw = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "x1", "the"]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(0, 40)) + ["the"] * draw.randint(0, 3))) for i in range(150)]
    docs += [(500, docs[3][1]), (501, docs[3][1]), (3, docs[3][1]), (None, "w1 w2 w3"), (600, None), (601, ""), (602, "..."), (603, "w5 " * 4000)]
    draw.shuffle(docs)
    items = [(i, " ".join(draw.choices(words, k=draw.randint(1, 12)))) for i in range(30)]
    items += [(30, None), (31, ""), (32, "unknown words"), (33, "W5, w5! w6"), (0, items[0][1]), (1, "w9 other text"), (None, "w7 w8")]
    return docs, items


def test_search_agrees_with_plain_python_for_any_shards_and_blocks(spark):
    docs, items = table()
    expected = ranked(docs, items, 4)
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id bigint, text string, shard int, term string").repartition(3)
    q = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id bigint, text string, rank int")
    for shard_bytes, block in ((1, 1024), (500, 5), (1 << 24, 1)):
        got = [tuple(r) for r in top_documents(d, q, k=4, shard_bytes=shard_bytes, block=block).collect()]
        assert sorted(got, key=str) == expected


def test_terms_that_are_too_many_to_broadcast_are_joined(spark, monkeypatch, tmp_path):
    docs, items = table()
    monkeypatch.setattr(lexical_search, "BROADCAST_TERMS", 0)
    d, q = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    build_index(d, shard_bytes=2000).write.parquet(str(tmp_path / "index"))
    assert sorted((tuple(r) for r in search(spark.read.parquet(str(tmp_path / "index")), q, 4).collect()), key=str) == ranked(docs, items, 4)


def test_a_written_index_is_searched_again(spark, tmp_path):
    docs, items = table()
    build_index(spark.createDataFrame(docs, "doc_id bigint, text string"), shard_bytes=700).write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    for some in (items[:5], items[5:9]):
        q = spark.createDataFrame([(f"q{i}", t) for i, t in some], "name string, body string")
        got = search(index, q, 2, "name", "body").collect()
        assert sorted((tuple(r) for r in got), key=str) == ranked(docs, [(f"q{i}", t) for i, t in some], 2)


def test_empty_tables_give_no_rows(spark):
    docs, items = table()
    d, q = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert top_documents(d.limit(0), q).collect() == []
    assert top_documents(d, q.limit(0)).collect() == []
    assert top_documents(d.where("doc_id = 600"), q).collect() == []
