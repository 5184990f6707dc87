"""Retrieval features over whole tables."""

import os

import pytest
from pyspark.sql import functions as F

from quillon.operators.features import pair_features
from quillon.plans import relational

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are absent")


def test_retrieval_features_are_not_constant(spark):
    pairs = relational._retrieved_pairs(spark, DATA).persist()
    wide = pair_features(pairs, groups=("retrieval",))
    varied = wide.agg(*(F.count_distinct(c).alias(c) for c in wide.columns if c != "id")).first().asDict()
    for name in ("bm25_score", "dense_score", "bm25_rank", "dense_rank", "dense_bm25_rank_gap", "in_bm25_topk_flag", "in_dense_topk_flag", "same_category_pool_flag", "lexical_dense_gap"):
        assert varied[f"retrieval_{name}"] > 1, name
    assert pairs.where("bm25_rank > 100 OR dense_rank > 100").count() == 0
