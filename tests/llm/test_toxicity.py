"""Features of single texts, and trained models."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import toxicity
from quillon.llm.toxicity import FEATURES, Lexicon


def row(text, weights=None):
    return dict(zip(FEATURES, Lexicon(weights or {}).features([text])[0], strict=True))


def test_capitals_count_alike_in_long_texts():
    short = "ПРИВЕТ мир ŁÓDŹ İstanbul " * 10
    assert row(short)["capital_rate"] == row(short * 20)["capital_rate"] > 0.3


def test_features_of_a_text():
    x = row("You are an IDIOT! Nice i-d.i0t, really. " + "word " * 20 + "scum")
    assert x["insult_count"] == pytest.approx(np.log1p(2))
    assert x["near_second_person"] * np.expm1(x["log_words"]) == pytest.approx(1)
    assert x["disguised_insults"] == pytest.approx(np.log1p(1))
    assert row("") == row("...") == dict.fromkeys(FEATURES, 0.0)


def test_long_unbroken_texts_take_linear_time():
    began = time.perf_counter()
    for text in ("a" * 300_000, "1" * 300_000, "a1" * 150_000, "a." * 150_000, "@a" * 150_000):
        row(text)
    assert time.perf_counter() - began < 10


def test_memo_does_not_change_features():
    texts = [f"word{i} you fool{'!' * (i % 3)} {'x' * (i % 70)}" for i in range(500)]
    one = Lexicon({"word7": 3.0})
    together = one.features(texts)
    assert np.array_equal(together, one.features(texts))
    assert np.allclose(together, [Lexicon({"word7": 3.0}).features([t])[0] for t in texts])


@pytest.fixture(scope="module")
def trained(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(600):
        text = list(rng.choice(words, rng.integers(5, 60)))
        if i % 4 == 0:
            for _ in range(2):
                text.insert(int(rng.integers(0, len(text))), str(rng.choice(["blorgh", "idiot", "zwick"])))
        rows.append((i, " ".join(text), i % 4 == 0))
    docs = spark.createDataFrame([(i, t, "x", 1.0, 0) for i, t, _ in rows], "doc_id bigint, text string, id string, score double, predicted int")
    labels = spark.createDataFrame([(i, int(y), None) for i, _, y in rows] + [(5, None, 1), (None, 1, 0)], "doc_id bigint, toxic int, quality int")
    return docs, toxicity.train(docs, labels, F.col("doc_id") % 5 != 0)


def test_trained_model_finds_held_out_texts(trained):
    docs, model = trained
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in out if i % 5 == 0]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())
    assert np.mean([out[i].predicted for i in held if i % 4 == 0]) >= 0.9
    assert np.mean([out[i].predicted for i in held if i % 4]) <= 0.02


def test_trained_model_scores_odd_texts(spark, trained):
    _, model = trained
    odd = [(1, None), (2, ""), (3, " \n"), (4, "idiot"), (4, "idiot"), (None, "w1 w2"), (6, "idiot " * 100_000), (7, "a" * 200_000)]
    out = toxicity.score(spark.createDataFrame([(i, t, 0.5) for i, t in odd], "doc_id bigint, text string, score double"), model).collect()
    assert len(out) == len(odd) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (1, 2, 3)}) == 1
    assert len({r.score for r in out if r.doc_id == 4}) == 1
    assert toxicity.score(spark.createDataFrame([], "doc_id bigint, text string"), model).count() == 0
