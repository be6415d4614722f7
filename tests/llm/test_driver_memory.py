"""What stays out of the driver, and what the tasks send one another."""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import functions as F

from corpusloom.llm import components, jaccard_join, quality

DIR = "/root/testdata/sf0.01"


def test_quality_is_fitted_in_a_task(spark, monkeypatch):
    fit = quality.fit_ordinal

    def only_in_a_task(*args):
        assert TaskContext.get() is not None
        return fit(*args)

    monkeypatch.setattr(quality, "fit_ordinal", only_in_a_task)
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    assert np.count_nonzero(quality.train(docs, quality.graded(labels)).weights) > 0


def test_components_of_few_edges_need_no_rounds(spark, monkeypatch):
    tables, written = [], components.written
    monkeypatch.setattr(components, "written", lambda df, name: tables.append(name) or written(df, name))
    chain = spark.range(5000).select(F.xxhash64("id").alias("a"), F.xxhash64(F.col("id") + 1).alias("b"))
    pairs = spark.range(7).select((F.col("id") * 2).alias("a"), (F.col("id") * 2 + 1).alias("b"))
    rows = components.connected_components(chain.unionByName(pairs)).collect()
    assert len(tables) == 2
    least = min(r.node for r in rows if not 0 <= r.node < 14)
    assert {(r.node, r.root) for r in rows if 0 <= r.node < 14} == {(k, k - k % 2) for k in range(14)}
    assert sum(r.root == least for r in rows) == 5001 and len(rows) == 5015
    monkeypatch.setattr(components, "FEW_EDGES", 0)
    few = chain.where("id < 40").unionByName(pairs)
    by_rounds = {tuple(r) for r in components.connected_components(few).collect()}
    monkeypatch.setattr(components, "FEW_EDGES", 10**6)
    assert by_rounds == {tuple(r) for r in components.connected_components(few).collect()}


def test_sets_travel_as_texts(spark):
    """Copies of every text with one word more: shuffled 3.5 times the texts as hashes."""

    def shuffled() -> dict[int, int]:
        jvm, empty = spark._jvm, spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
        stages = spark.sparkContext._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, empty, jvm.java.util.ArrayList())
        return {stages.apply(k).stageId(): stages.apply(k).shuffleWriteBytes() for k in range(stages.size())}

    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.select((F.col("doc_id") + 10**6).alias("doc_id"), F.concat("text", F.lit(" more")).alias("text")))
    before = shuffled()
    rows = jaccard_join.ngram_jaccard_classes(docs, n=4, percent=85)
    assert rows.where("component_id <> doc_id").count() >= 900
    moved = sum(v for k, v in shuffled().items() if k not in before)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    assert moved < 2.7 * size
