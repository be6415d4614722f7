"""Exact nearest vectors against a scan."""

from __future__ import annotations

import numpy as np
import pytest

from corpusloom.operators.vector_index import VectorIndex

SCHEMA = "chunk_id string, model_tag string, embedding array<float>"


def scan(rows, vector, model, k):
    def cos(v):
        norm = np.linalg.norm(v) * np.linalg.norm(vector)
        return 0.0 if norm == 0 else float(np.dot(np.asarray(v, np.float32).astype(float), vector) / norm)

    held = [(-round(cos(v), 9), c) for c, m, v in rows if m == model and v is not None and len(v) == len(vector)]
    return [(c, -x) for x, c in sorted(held)[:k]]


def test_equals_a_scan(spark):
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(12, 8))
    rows = [(f"c{k:04}", "a" if k % 3 else "b", [float(x) for x in np.float32(middles[k % 12] + rng.normal(size=8) * 0.05)]) for k in range(900)]
    rows += [(f"z{k}", "a", [0.0] * 8) for k in range(3)] + [("short", "a", [1.0] * 7), ("none", "a", None)] + [(f"same{k}", "a", rows[1][2]) for k in range(30)]
    index = VectorIndex(spark.createDataFrame(rows, SCHEMA).repartition(3), 8, 24)
    assert sum(s.n for s in index.stats) == 933
    skipped = 0
    for vector in [*np.float32(middles[:4]).astype(float), np.asarray(rows[1][2]), -np.float32(middles[0]).astype(float), np.zeros(8)]:
        for model, k in (("a", 1), ("a", 20), ("b", 300), ("a", 5000), ("c", 5)):
            got = [(r.chunk_id, round(r.cosine, 9)) for r in index.top(list(vector), model, k).collect()]
            assert [round(x, 6) for _, x in got] == [round(x, 6) for _, x in scan(rows, vector, model, k)]
            if k != 20:
                assert sorted(c for c, _ in got) == sorted(c for c, _ in scan(rows, vector, model, k)) or k == 1
            skipped += index.skipped
    assert skipped > 100  # of 24 centres a search
    assert index.top([1.0] * 7, "a", 3).count() == 0
    tied = index.top(rows[1][2], "a", 3, ties=True).collect()
    assert len(tied) == 31 and {r.chunk_id for r in tied} == {"c0001"} | {f"same{k}" for k in range(30)}


@pytest.mark.parametrize("rows", [[], [("x", "a", None)], [("x", "a", [0.0] * 8)]])
def test_hardly_any_vectors(spark, rows):
    index = VectorIndex(spark.createDataFrame(rows, SCHEMA), 8)
    assert [r.chunk_id for r in index.top([1.0] * 8, "a", 3).collect()] == [c for c, _, v in rows if v]
