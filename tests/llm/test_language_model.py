"""Training steps of the language model."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from quillon.llm import language_model as L


def test_every_batch_updates_the_tables_of_all_features():
    rng = np.random.default_rng(1)
    words, at = np.sort(rng.integers(1, 1 << 60, 40).astype(np.uint64)), rng.integers(0, 40, 3000).astype(np.uint32)
    block = pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (words, rng.integers(0, 200, 40).astype(np.uint16), at, np.array([3000], np.uint32), np.array([True]))], names=["words", "endings", "at", "counts", "learns"])
    vocabulary = L.Vocabulary(words[:5], np.arange(L.ENDINGS, dtype=np.uint8) % L.GROUPS, np.ones(L.CLASSES), np.ones(L.CLASSES))
    weights = np.zeros((len(L.FEATURES), L.LEAST_BUCKETS, L.CLASSES), np.float32)
    out = list(L._descended(vocabulary, SimpleNamespace(value=weights), np.zeros(L.CLASSES, np.float32))(iter([block])))
    per_table = L._SEGMENTS // len(L.FEATURES)
    assert {s // per_table for b in out for s in b.column("segment").to_pylist()} == set(range(len(L.FEATURES)))
