"""Findings of round 3 on growth, each with a test that failed before."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom import queries
from corpusloom.operators import ingest, postings
from corpusloom.plans import pipeline
from corpusloom.publish import Transaction
from corpusloom.sources import jsonl
from corpusloom.sources.registry import load_registry, registry_frame

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_insert_shuffles_no_postings(spark, tmp_path, monkeypatch):
    store, append, seen = jsonl.Store(spark, str(tmp_path)), Transaction.append, {}
    monkeypatch.setattr(Transaction, "append", lambda self, table, rows, **facts: seen.setdefault(table, plan(rows)) and append(self, table, rows, **facts))
    rows = spark.createDataFrame([(f"e{k}#0000", f"e{k}", 1, None, f"a b{k} a", "x", "", "", k) for k in range(50)] + [("n", "n", 1, None, None, "x", "", "", 1)], store.schemas["chunks"])
    store.run(lambda tx: store.add_chunks(tx, rows))
    assert "Exchange" not in seen["postings"] and "Sort" not in seen["postings"]
    assert tuple(store.read("index_stats").first()) == (51, 150) and store.read("postings").count() == 100


def test_runs_are_sorted_and_whole(monkeypatch):
    """Tokens in several runs, some chunks empty or null, chunk ids out of order."""
    rng = random.Random(5)
    rows = [(f"c{rng.random()}", f"e{k}", [rng.choice("äbcdefg") * rng.randrange(1, 4) for _ in range(rng.randrange(0, 40))] if k % 11 else None) for k in range(900)]
    monkeypatch.setattr(postings, "RUN_BYTES", 30_000)
    monkeypatch.setattr(postings, "OUT_ROWS", 700)
    columns = [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([len(r[2] or ()) for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.string()))]
    batch = pa.RecordBatch.from_arrays(columns, ["chunk_id", "episode_id", "dl", "tokens"])
    out = list(postings._sorted_tokens(iter([batch.slice(0, 500), batch.slice(500)])))
    found = [(*r.values(),) for b in out for r in b.to_pylist()]
    wanted = {(t, c, e, len(ts), tuple(k for k, x in enumerate(ts) if x == t)) for c, e, ts in rows if ts for t in ts}
    assert {(*r[:4], tuple(r[4])) for r in found} == wanted and len(found) == len(wanted)
    breaks = sum(a[:2] > b[:2] for a, b in zip(found, found[1:], strict=False))
    assert 0 < breaks < 8 and max(b.num_rows for b in out) <= 700


@pytest.mark.parametrize("sent", [0, 50_000])
def test_texts_are_not_sorted_to_admit_them(spark, monkeypatch, sent):
    """Only keys, contents and the order are shuffled and stored; the rows are those that come first."""
    stored = []
    written = ingest.written
    monkeypatch.setattr(ingest, "written", lambda df, name="table": stored.append(df.columns) or written(df, name))
    monkeypatch.setattr(ingest, "SENT_ROWS", sent, raising=False)
    rng = random.Random(4)
    rows = [(k, f"c{rng.randrange(60)}", f"t{rng.randrange(60)}", f"text {k}", "out" if k % 7 == 3 else f"e{k % 3}") for k in range(400)]
    df = spark.createDataFrame(rows, "seq long, chunk_id string, content_key string, chunk_text string, episode_id string").repartition(3)
    held = spark.createDataFrame([("c1", "t2")], "chunk_id string, content_key string")
    barred = spark.createDataFrame([("out",)], "episode_id string")
    found = ingest.admitted_in_order(df, held, "chunk_id", "content_key", ["seq"], barred)
    keys, contents, wanted = {"c1"}, {"t2"}, []
    for r in rows:
        if r[4] != "out" and r[1] not in keys and r[2] not in contents:
            keys.add(r[1]), contents.add(r[2]), wanted.append(r)
    assert sorted(map(tuple, found.collect())) == wanted
    assert stored and not any("chunk_text" in c for c in stored)
    once = ingest.admitted_in_order(df.dropDuplicates(["chunk_id", "content_key"]).dropDuplicates(["chunk_id"]), held, "chunk_id", "content_key", ["seq"])
    last = once._jdf.queryExecution().optimizedPlan().toString()
    assert "SortMergeJoin" not in plan(once) and ("ShuffledHashJoin" if not sent else "BroadcastHashJoin") in plan(once) and "Join LeftSemi" in last


def test_equal_rows_are_admitted_once(spark):
    df = spark.createDataFrame([("e1", "k", "a"), ("e1", "k", "a"), ("e2", "l", "b")], "episode_id string, content_key string, text string")
    found = ingest.admitted_in_order(df, df.limit(0), "episode_id", "content_key", ["episode_id"])
    assert sorted(map(tuple, found.collect())) == [("e1", "k", "a"), ("e2", "l", "b")]


@pytest.mark.parametrize("sent", [0, 50_000])
def test_landed_texts_are_not_sorted(spark, monkeypatch, sent):
    monkeypatch.setattr(ingest, "SENT_ROWS", sent, raising=False)
    plans, written = {}, pipeline.written
    monkeypatch.setattr(pipeline, "written", lambda df, name: plans.setdefault(name, plan(df)) and written(df, name))
    rows = [("frog", f"s{k}", "https://e/", None, f"text {k % 6}", "unknown" if k == 3 else "cc_by", k) for k in range(9)]
    pages = spark.createDataFrame(rows, "publisher_id string, slug string, url string, html string, body string, rights_code string, seq long")
    sources = {"frog": load_registry()["frog"]}
    log = spark.createDataFrame([("frog", "frog_frogcast_s1", "cc_by", 1, "", False)], "publisher_id string, episode_id string, rights_code string, ingestion_date long, content_hash string, deprecated boolean")
    found = pipeline.judged(pages, registry_frame(spark, sources).drop("episodes"), log, ["frog"], incremental=True)
    assert "SortMergeJoin" not in plans["read"] and "SortMergeJoin" not in plan(found)
    verdicts = {r.seq: r.verdict for r in found.collect()}
    assert verdicts == {0: "admitted", 1: "skipped_incremental", 2: "admitted", 3: "rejected_rights", 4: "admitted", 5: "admitted", 6: "skipped_dedup", 7: "admitted", 8: "skipped_dedup"}


@pytest.mark.parametrize("name", ["tag_only_recency", "semantic_topk", "semantic_with_tags", "search_by_vector_alone"])
def test_tags_and_vectors_build_no_index(spark, monkeypatch, name):
    monkeypatch.setattr(queries, "chunk_index", None)
    assert queries.QUERIES[name](spark, SMALL).count() > 0


def test_the_log_is_scanned_without_the_documents(spark, monkeypatch):
    monkeypatch.setattr(queries, "_json_folder", None)
    monkeypatch.setattr(queries, "_made", {})
    assert queries.QUERIES["jsonl_governance_scan"](spark, SMALL).agg(F.sum("n")).first()[0] == spark.read.parquet(f"{SMALL}/events.parquet").count()


def test_json_lines_by_publisher(spark, tmp_path):
    """More publishers than files are kept open; the setting stays as it was."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    rows = spark.range(0, 1000, 1, 2).select(F.concat(F.lit("p/"), (F.col("id") % 150).cast("string")).alias("publisher"), "id")
    jsonl.append_jsonl(rows, f"{tmp_path}/x", "publisher")
    found = spark.read.json(f"{tmp_path}/x")
    assert sorted((r.publisher, r.id) for r in found.collect()) == sorted((r.publisher, r.id) for r in rows.collect()) and spark.conf.get(name) == before
    assert found.select("by").distinct().count() == 150 and jsonl.OPEN_FILES < 150


def test_fourths_need_no_join(spark):
    rows = queries._fourths(spark, SMALL)
    assert "Exchange" not in plan(rows) and "Join" not in plan(rows)
    assert rows.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
