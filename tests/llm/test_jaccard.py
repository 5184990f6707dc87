"""The join on odd ids, on lists dealt to many tasks, and on long texts just below the bound."""

import numpy as np

from quillon.llm import jaccard_join
from quillon.llm.jaccard_join import join_components, linked

SCHEMA = "doc_id bigint, text string, list string, place string"


def sets_of(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute_force(rows):
    """Component per id, where rows of one id are one document."""
    parent = {i: i for i, *_ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = [(i, sets_of(t)) for i, t, *_ in rows]
    for i, x in held:
        for j, y in held:
            if j < i and x and y and 100 * len(x & y) >= 80 * len(x | y):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in parent}


def test_counts_summed_over_blocks_decide_like_whole_counts():
    rng = np.random.default_rng(1)
    for _ in range(2000):
        n = int(rng.integers(1, 200))
        x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < rng.uniform(0.7, 1)], rng.integers(0, 1 << 62, int(rng.integers(0, 30))).astype(np.uint64)]))
        shared = len(np.intersect1d(x, y))
        assert linked(x, y, 80) == bool(shared and 100 * shared >= 80 * (len(x) + len(y) - shared))


def test_lists_dealt_to_tasks_and_ids_of_several_texts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEADERS", 2)
    monkeypatch.setattr(jaccard_join, "LIST_MEMBERS", 4)
    rng = np.random.default_rng(2)
    shared = [f"s{i}" for i in range(30)]
    rows = []
    for i in range(40):  # families that share a passage, some long enough to link, each with copies and near copies
        words = [f"f{i // 4}x{k}" for k in range(int(rng.integers(5, 140)))] if i % 4 == 0 else words
        changed = list(words)
        for _ in range(i % 3):
            changed[int(rng.integers(0, len(changed)))] = f"c{rng.integers(0, 9)}"
        rows.append((i, " ".join(changed + shared), "x", "y"))
    rows += [(4, rows[20][1], "x", "y"), (9, "an entirely different text of its own", "x", "y"), (50, "an entirely different text of its own", "x", "y"), (7, None, "x", "y")]
    out = join_components(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = brute_force(rows)
    assert len(out) == len(rows)
    # a text without words has no link, but its id has the links of its other rows only there
    assert all(r.component_id == expected[r.doc_id] for r in out if r.n_shingles)
    assert sorted((r.doc_id, r.n_shingles) for r in out) == sorted((i, len(sets_of(t))) for i, t, *_ in rows)


def test_long_texts_below_the_bound_give_no_candidates(spark, monkeypatch):
    tried = []

    def counted(pairs, texts, percent):
        tried.append(pairs.count())
        return links(pairs, texts, percent)

    links = jaccard_join.links
    monkeypatch.setattr(jaccard_join, "links", counted)
    shared = [f"s{i}" for i in range(1650)]
    rows = [(i, " ".join([f"d{i}x{k}" for k in range(350)] + shared), "", "") for i in range(200)]  # similarity 0.70
    out = join_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.component_id == r.doc_id for r in out)
    assert sum(tried) <= len(rows)
