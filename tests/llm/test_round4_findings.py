"""Findings of round 4 on training-data operators, each with a test that failed before."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import jaccard_join
from corpusloom.llm.queries import JACCARD_SQL


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    met = 0
    for _ in range(3000):
        n = int(rng.integers(1, 300))
        pool = rng.integers(0, 1 << 63, 2 * n + 2).astype(np.uint64)
        x, gone = pool[:n], int(rng.integers(0, n * (100 - percent) // 100 + 1))
        y = np.concatenate([x[gone:], pool[n : n + int(rng.integers(0, gone + 2))]])
        common = n - gone
        if common and 100 * common >= percent * (n + len(y) - common):
            met += 1
            assert len(np.intersect1d(jaccard_join.signatures(x, percent), jaccard_join.signatures(y, percent)))
    assert met > 300


def test_unlike_sets_of_common_shingles_are_not_all_compared(spark, monkeypatch):
    """Texts in which every word is followed by one of two hold common n-grams only, which chain them to one
    block; it was compared whole."""
    rng, rows = random.Random(4), []
    after = [rng.sample(range(60), 2) for _ in range(60)]
    for _ in range(500):
        at = [rng.randrange(60)]
        while len(at) < 60:
            at.append(rng.choice(after[at[-1]]))
        rows.append([f"w{i}" for i in at])
    for i in range(100):
        copy = list(rows[i % 30])
        copy[rng.randrange(60)] = f"new{i}"
        rows.append(copy)
    table = [(i, " ".join(x)) for i, x in enumerate(rows)]
    units, whole = [], []

    def noted(df, name="table", keep=jaccard_join.written):
        out = keep(df, name)
        if name == "units":
            units.append(out.where("j >= 0").count())
        if name == "blocks":
            whole.append(out.groupBy("blk").count().agg(F.max("count")).first()[0] or 0)
        return out

    monkeypatch.setattr(jaccard_join, "written", noted)
    monkeypatch.setattr(jaccard_join, "PART_SETS", 32)
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", table)
    wanted = sorted(db.execute(JACCARD_SQL).fetchall())
    assert sorted(map(tuple, jaccard_join.ngram_jaccard_classes(docs, n=4, percent=85).collect())) == wanted
    assert whole[0] > 300 and sum(units) < 1500
    assert sum(r[2] for r in wanted) >= 200
    kept = jaccard_join.ngram_jaccard_classes(docs, n=4, percent=85, links=False)
    assert sorted((r.doc_id, r.component_id) for r in kept.collect()) == [(r[0], r[3]) for r in wanted]
    assert sum(units) < 3000
