"""Fitted term weights: no cut vocabulary, reload, statistics of the training folds alone, and a model as good as a dense one."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quillon.operators.features import out_of_fold_semantic, semantic_features
from quillon.operators.term_weights import TermWeights, TermWeightsModel, pair_text_pipeline

ROWS = [
    (0, "red shoe", "red leather shoe for women", "shoe", 1, 0), (1, "red shoe", "blue cotton shirt", "shirt", 0, 1), (2, "blue shirt", "blue cotton shirt", "shirt", 1, 0), (3, "blue shirt", "green wool coat", "coat", 0, 1),
    (4, "wool coat", "green wool coat", "coat", 1, 0), (5, "wool coat", "red leather shoe for women", "shoe", 0, 1), (6, "only here", "only here too", "other", 1, 1), (7, None, "", None, 0, 0), (8, "red shoe", "red leather shoe for women", "shoe", 1, 1),
]


@pytest.fixture
def pairs(spark):
    made = spark.createDataFrame(ROWS, "id int, query string, title string, category string, label int, fold int")
    return made.withColumns({c: F.lit("") for c in ("brand", "gender", "age_group", "attributes", "normalized_attribute_text")})


def grams(text):
    t = re.findall(r"\w\w+", (text or "").lower())
    return Counter([*t, *(f"{a} {b}" for a, b in zip(t, t[1:]))])


def statistics(texts):
    df = Counter(g for t in texts for g in grams(t))
    return {g: math.log((1 + len(texts)) / (1 + n)) + 1 for g, n in df.items()}


def unit(text, idf):
    w = {g: n * idf[g] for g, n in grams(text).items() if g in idf}
    norm = math.sqrt(sum(x * x for x in w.values()))
    return {g: x / norm for g, x in w.items()}


def cosine(a, b, idf):
    x, y = unit(a, idf), unit(b, idf)
    return sum(v * y.get(g, 0.0) for g, v in x.items())


def test_every_term_has_its_own_number_and_a_reload_gives_equal_vectors(spark, pairs, tmp_path):
    model = TermWeights(["query", "title"]).fit(pairs)
    idf = statistics([r[i] for r in ROWS for i in (1, 2)])
    table = {r.term: r for r in model.table.collect()}
    assert set(table) == set(idf) and sorted(r.id for r in table.values()) == list(range(len(idf)))
    assert {t: r.idf for t, r in table.items()} == pytest.approx(idf)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = TermWeightsModel.load(str(tmp_path / "model"))
    vectors = []
    for m in (model, again):
        rows = m.transform(pairs).select("id", vector_to_array("query_weights").alias("q"), vector_to_array("title_weights").alias("t")).collect()
        vectors.append({r.id: (r.q, r.t) for r in rows})
    assert vectors[0] == vectors[1] and len(vectors[0]) == len(ROWS)
    for r in ROWS:
        expected = np.zeros(len(idf))
        for g, w in unit(r[2], idf).items():
            expected[table[g].id] = w
        assert vectors[0][r[0]][1] == pytest.approx(expected.tolist())


def test_semantic_features_are_cosines_by_the_statistics_given(spark, pairs):
    got = {r.id: r for r in semantic_features(pairs, "id").collect()}
    idf = statistics([r[i] for r in ROWS for i in (1, 2)])
    for r in ROWS:
        assert got[r[0]].sem_query_title_cosine == pytest.approx(cosine(r[1], r[2], idf))


def test_out_of_fold_features_use_no_text_of_their_fold(spark, pairs):
    got = {r.id: r for r in out_of_fold_semantic(pairs, "id").collect()}
    assert len(got) == len(ROWS)
    for r in ROWS:
        rest = [x for x in ROWS if x[5] != r[5]]
        assert got[r[0]].sem_query_title_cosine == pytest.approx(cosine(r[1], r[2], statistics([x[i] for x in rest for i in (1, 2)])))
        assert got[r[0]].sem_query_category_cosine == pytest.approx(cosine(r[1], r[3], statistics([x[i] for x in rest for i in (1, 3)])))
    assert got[6].sem_query_title_cosine == 0


def test_loss_equals_that_of_a_dense_model(spark, pairs, tmp_path):
    rows = pairs.select("id", "label", "query", F.col("title").alias("item"), F.concat_ws(" [SEP] ", "query", "title").alias("pair"))
    fitted = pair_text_pipeline().fit(rows)
    texts = [(r[1] or "", r[2], " [SEP] ".join(x for x in (r[1], r[2]) if x is not None)) for r in ROWS]
    fields = [statistics([t[i] for t in texts]) for i in range(3)]
    x = np.array([[unit(t[i], idf).get(g, 0.0) for i, idf in enumerate(fields) for g in sorted(idf)] for t in texts])
    y = np.array([r[4] for r in ROWS])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))

    def loss(w):
        margin = np.where(y == 1, 1, -1) * (x @ w[1:] + w[0])
        return 4.0 * float(weight @ np.logaddexp(0, -margin)) + 0.5 * float(w[1:] @ w[1:])

    w = np.zeros(x.shape[1] + 1)
    full = np.hstack([np.ones((len(x), 1)), x])
    for _ in range(60):
        p = 1 / (1 + np.exp(-full @ w))
        gradient = 4.0 * full.T @ (weight * (p - y)) + np.append(0, w[1:])
        hessian = 4.0 * (full * (weight * p * (1 - p))[:, None]).T @ full + np.diag(np.append(0, np.ones(len(w) - 1)))
        w -= np.linalg.solve(hessian, gradient)
    last = fitted.stages[-1]
    mine = np.append(last.intercept, last.coefficients.toArray())
    assert len(mine) == len(w) and loss(mine) == pytest.approx(loss(w), rel=1e-5)
    expected = 1 / (1 + np.exp(-full @ w))
    fitted.save(str(tmp_path / "pipeline"))
    for model in (fitted, PipelineModel.load(str(tmp_path / "pipeline"))):
        proba = {r.id: r.p for r in model.transform(rows).select("id", vector_to_array("probability")[1].alias("p")).collect()}
        assert [proba[r[0]] for r in ROWS] == pytest.approx(expected.tolist(), abs=2e-3)


def test_an_empty_fit_knows_no_terms(spark, pairs):
    model = TermWeights(["query"]).fit(pairs.limit(0))
    assert model.size == 0 and model.transform(pairs).where(F.size(vector_to_array("query_weights")) == 1).count() == len(ROWS)


def test_blocks_and_parts_of_a_fit_give_the_same_model_and_leave_terms_in_a_table(spark, pairs, monkeypatch):
    from quillon.operators import text_logistic

    rows = pairs.select("id", "label", "query", F.col("title").alias("item"), F.concat_ws(" [SEP] ", "query", "title").alias("pair"))
    monkeypatch.setattr(text_logistic, "BLOCK_ROWS", 4)
    monkeypatch.setattr(text_logistic, "PART_BUCKETS", 1)
    monkeypatch.setattr(text_logistic, "buckets_for", lambda texts, text: (texts.count(), 2))
    last = pair_text_pipeline().fit(rows).stages[-1]
    texts = [(r[1] or "", r[2], " [SEP] ".join(x for x in (r[1], r[2]) if x is not None)) for r in ROWS]
    fields = [statistics([t[i] for t in texts]) for i in range(3)]
    found = {(r.of, r.term): r.coefficient for r in last.table.collect()}
    assert set(found) == {(i, g) for i, idf in enumerate(fields) for g in idf}
    margins = [last.intercept + sum(w * found[i, g] for i, idf in enumerate(fields) for g, w in unit(t[i], idf).items()) for t in texts]
    proba = {r.id: r.p for r in last.transform(rows).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    assert [proba[r[0]] for r in ROWS] == pytest.approx([1 / (1 + math.exp(-m)) for m in margins])
    # at the least loss a coefficient is what the rows leave of it
    ones = sum(r[4] for r in ROWS)
    rest = [4.0 * len(ROWS) / (2 * (ones if r[4] else len(ROWS) - ones)) * (r[4] - proba[r[0]]) for r in ROWS]
    assert sum(rest) == pytest.approx(0, abs=2e-3)
    for (i, g), c in found.items():
        assert c == pytest.approx(sum(x * unit(t[i], fields[i]).get(g, 0.0) for x, t in zip(rest, texts)), abs=2e-3)


def test_every_part_of_a_step_has_a_task(spark, pairs, monkeypatch):
    """Spark 4.1 reads a union of frames of one partition in one task, so a step was the work of one core."""
    from quillon.operators import text_logistic

    rows = pairs.select("label", "query", F.col("title").alias("item"), F.concat_ws(" [SEP] ", "query", "title").alias("pair"))
    monkeypatch.setattr(text_logistic, "PART_BUCKETS", 1)
    monkeypatch.setattr(text_logistic, "buckets_for", lambda texts, text: (texts.count(), 2))
    spark.sparkContext.setJobGroup("logistic", "two steps")
    text_logistic.TextLogistic(["query", "item", "pair"], maxIter=2).fit(rows)
    status = spark.sparkContext.statusTracker()
    stages = [status.getStageInfo(i) for j in status.getJobIdsForGroup("logistic") for i in status.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # lengths, three steps and the coefficients
    assert sum(s is not None and s.numTasks == s.numCompletedTasks == 6 for s in stages) >= 5
