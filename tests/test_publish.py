"""Atomic publishing, exactly-once batches, the positional index, ordered insertion, landing."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.errors import CommitConflict
from corpusloom.operators import governance, ingest, search
from corpusloom.operators.postings import Index
from corpusloom.plans.pipeline import Pipeline
from corpusloom.publish import Published, Transaction
from corpusloom.sources.jsonl import Store
from corpusloom.sources.registry import load_registry
from corpusloom.streaming.incremental import append_batch, query_id, stream_ingest, stream_store
from tests.test_engine import chunk, episode, folder, one_by_one


def tables(spark, tmp_path):
    schema = spark.createDataFrame([], "x long").schema
    return Published(spark, str(tmp_path / "t"), {"a": schema, "b": schema})


def held(t, name):
    return sorted(r.x for r in t.read(name).collect())


# -- publishing ----------------------------------------------------------------------------------


def test_all_tables_of_a_run_or_none(spark, tmp_path):
    t, rows = tables(spark, tmp_path), lambda *x: spark.createDataFrame([(k,) for k in x], "x long")
    with t.transaction() as tx:
        tx.append("a", rows(1))
        assert held(t, "a") == []
        tx.append("b", rows(1))
    with pytest.raises(RuntimeError), t.transaction() as tx:
        tx.append("a", rows(2))
        raise RuntimeError("lost between two tables")
    assert (held(t, "a"), held(t, "b"), t.version()) == ([1], [1], 1)
    gone = t.vacuum()
    assert len(gone) == 1 and held(t, "a") == [1]
    t.run(lambda tx: tx.append("a", rows(3)))
    assert held(t, "a") == [1, 3]


def test_the_second_of_two_runs_looks_again(spark, tmp_path):
    t, rows = tables(spark, tmp_path), lambda *x: spark.createDataFrame([(k,) for k in x], "x long")
    late = t.transaction()
    late.append("a", rows(1))
    t.run(lambda tx: tx.append("a", rows(2)))
    with pytest.raises(CommitConflict), late:
        pass
    assert held(t, "a") == [2]
    seen = []

    def work(tx):
        seen.append(tx.read("a").count())
        if len(seen) == 1:
            t.run(lambda other: other.append("a", rows(4)))
        tx.append("a", rows(5))

    assert t.run(work, ("s", 0)) and seen == [1, 2] and held(t, "a") == [2, 4, 5]
    assert not t.run(work, ("s", 0)) and t.run(lambda tx: tx.append("b", rows(1)), ("other", 0))
    assert t.last_batch("s") == 0 and t.last_batch("nobody") is None


@pytest.mark.parametrize("dies_at", ["chunks", "postings", "index_stats", "episodes", "governance"])
def test_a_build_that_dies_leaves_the_store_as_it_was(spark, tmp_path, monkeypatch, dies_at):
    (tmp_path / "in").mkdir()
    root = folder(tmp_path / "in", [episode("e1"), episode("e2", "unknown")], [chunk("e1", 0, "alpha beta"), chunk("e1", 1, "beta gamma")])
    store, append = Store(spark, str(tmp_path / "store")), Transaction.append

    def dying(self, table, rows, **facts):
        if table == dies_at:
            raise RuntimeError("killed")
        return append(self, table, rows, **facts)

    from corpusloom.plans.build import ingest_folder

    monkeypatch.setattr(Transaction, "append", dying)
    with pytest.raises(RuntimeError):
        ingest_folder(store, root, now=5)
    assert store.counts() == {"episodes": 0, "chunks": 0} and store.read("governance").count() == 0 and Index(store).postings.count() == 0
    monkeypatch.setattr(Transaction, "append", append)
    first = ingest_folder(store, root, now=5).first()
    assert (first.inserted, first.chunks_inserted) == (1, 2) and store.counts() == {"episodes": 1, "chunks": 2} and store.read("governance").count() == 2
    hits = search.search_store(store, search.SearchQuery("Beta gamma")).collect()
    assert [r.chunk_id for r in hits] == ["e1#0001"]


def test_streams_with_checkpoints_of_their_own(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = lambda *x: spark.createDataFrame([(e, t, "cc_by") for e, t in x], "episode_id string, text string, rights_code string")
    run = lambda name: stream_ingest(spark.readStream.schema(rows(("e", "t")).schema).parquet(str(tmp_path / name)), store, str(tmp_path / f"state-{name}")).awaitTermination()
    ids = lambda: sorted(r.episode_id for r in stream_store(spark, store).read("admitted").collect())
    rows(("e1", "one"), ("e2", "two")).write.parquet(str(tmp_path / "a"))
    rows(("e3", "three"), ("e4", "one")).write.parquet(str(tmp_path / "b"))
    run("a"), run("b"), run("a")
    assert ids() == ["e1", "e2", "e3"]
    rows(("e5", "five"), ("e1", "other")).write.mode("append").parquet(str(tmp_path / "b"))
    run("b"), run("b")
    assert ids() == ["e1", "e2", "e3", "e5"]
    again = stream_store(spark, store)
    assert not append_batch(again, rows(("e9", "nine")), query_id(spark, str(tmp_path / "state-a")), 0)
    assert append_batch(again, rows(("e9", "nine")), "a third source", 0) and ids()[-1] == "e9"


# -- index ---------------------------------------------------------------------------------------


def test_postings_give_the_rows_of_a_scan(spark, tmp_path):
    rng, words = random.Random(3), ["of", "the", "Café", "a", "b"]
    store = Store(spark, str(tmp_path / "store"))
    rows = [(f"e{k}#0000", f"e{k}", 1, None, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 30))), "x", "", "", k) for k in range(60)]
    df = spark.createDataFrame(rows, store.schemas["chunks"])
    for k in range(6):
        store.run(lambda tx, k=k: store.add_chunks(tx, df.where(F.col("created_at") % 6 == k)))
    assert sorted(f["level"] for f in store.folders("postings")) == [0, 0, 1]
    index, scan = Index(store), search.indexed(df)
    for phrase in (["of"], ["of", "the"], ["a", "a"], ["a", "a", "a"], ["the", "cafe", "of"], ["nowhere"], ["of", "nowhere"], []):
        found = lambda d: sorted((r.chunk_id, r.episode_id, round(r.bm25, 9)) for r in d.collect())
        assert found(index.bm25(phrase)) == found(search.bm25_phrase(scan, phrase)), phrase
    plan = index.occurrences(["of", "the"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("In(term, [of,the])") == 2 and "tokens" not in plan and "chunk_text" not in plan


def test_search_by_the_weights_of_a_pack(spark, tmp_path):
    from corpusloom.plans import pack

    store = Store(spark, str(tmp_path / "store"))
    texts = ["rare words here", "rare and more words that are here too"]
    store.run(lambda tx: store.add_chunks(tx, spark.createDataFrame([(f"e{k}#0000", f"e{k}", 1, None, t, "x", "", "", k) for k, t in enumerate(texts)], store.schemas["chunks"])))
    store.add_embeddings(spark.createDataFrame([("e0#0000", "m", [0.0, 1.0], 1), ("e1#0000", "m", [1.0, 0.0], 1)], store.schemas["embeddings"]))
    path = str(tmp_path / "x.pack")
    pack.build(store, path, level=1, weights=search.RankWeights(bm25=0.0, semantic=5.0))
    opened = pack.Pack.open(spark, path)
    query = search.SearchQuery("rare", query_embedding=(0.0, 1.0), semantic_model_tag="m", scope="include_embeddings")
    hits = search.search_store(opened.store(spark), opened.with_weights(query)).collect()
    assert [(r.chunk_id, round(r.rank_score, 6)) for r in hits] == [("e0#0000", 5.0), ("e1#0000", 0.0)]
    assert search.search_store(store, query).count() == 2 and search.search_store(store, search.SearchQuery("rare", limit=0)).count() == 2


# -- ordered insertion ---------------------------------------------------------------------------


@pytest.mark.parametrize("bound", [200_000, 1000, 10, 0])
def test_crossed_ids_and_contents(spark, monkeypatch, bound):
    """In a task, by groups, and by rounds where a group is larger than the bound."""
    monkeypatch.setattr(ingest, "ORDERED_ROWS", bound)
    none = spark.createDataFrame([], "chunk_id string, content_key string")
    take = lambda rows: sorted((r.chunk_id, r.content_key) for r in ingest.admitted_in_order(spark.createDataFrame(rows, "seq long, chunk_id string, content_key string"), none, "chunk_id", "content_key", ["seq"]).collect())
    n = 1000 if bound in (200_000, 1000) else 12
    chain = [(k, f"c{k // 2}", f"t{(k + 1) // 2}") for k in range(n)]
    rng = random.Random(4)
    mixed = [(10_000 + k, f"d{rng.randrange(9)}", f"u{rng.randrange(9)}") for k in range(40)]
    assert take(chain + mixed) == one_by_one(chain + mixed, (), ())


def test_connected_groups(spark):
    rows = [(k, f"c{k // 2}", f"t{(k + 1) // 2}") for k in range(60)] + [(100 + k, f"d{k}", "one") for k in range(20)] + [(200, "e", "alone")]
    got = ingest.connected(spark.createDataFrame(rows, "seq long, chunk_id string, content_key string"), "chunk_id", "content_key").collect()
    groups = {}
    for r in got:
        groups.setdefault(r.group, set()).add(r.seq)
    assert sorted(map(len, groups.values())) == [1, 20, 60] and len(got) == len(rows)


def test_attribution_to_a_hundred_thousand_publishers(spark):
    names = spark.range(100_000).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("publisher_id")).unionByName(spark.createDataFrame([("p7_x",), ("q",)], "publisher_id string"))
    log = spark.createDataFrame([("p7_x_1", None), ("p7_y_1", None), ("p99999_a", None), ("p100000_a", None), ("zz_1", "q"), ("p5_a", "not there"), ("p5", None), (None, "q"), (None, None), ("p7_x_1", None)], "episode_id string, publisher_id string")
    got = sorted((str(r.episode_id), str(r.publisher_id), r.publisher) for r in governance.attributed(log, names).collect())
    few = governance.attributed(log, ["p7_x", "q", "p5", "p7", "p99999"])
    assert got == sorted((str(r.episode_id), str(r.publisher_id), r.publisher) for r in few.collect())
    assert dict((g[0], g[2]) for g in got if g[0] != "None") == {"p7_x_1": "p7_x", "p7_y_1": "p7", "p99999_a": "p99999", "p100000_a": None, "zz_1": "q", "p5_a": "p5", "p5": None}


# -- landing -------------------------------------------------------------------------------------

PAGES = "publisher_id string, slug string, url string, html string, body string, rights_code string, seq long"


def test_landing_repeated_rows_and_dead_letters(spark, tmp_path):
    frog = {"frog": load_registry()["frog"]}
    run = Pipeline(spark, frog, str(tmp_path / "root"))
    same = ("frog", "one", "u", None, "one text", None, 1)
    rows = [same, same, ("frog", "one", "u", None, "changed text", None, 2), ("frog", "two", "u", "<article><p>Two</p></article>", None, None, 3), ("frog", "bad", "u", None, None, None, 4), ("frog", "late", "u", None, None, None, 5)]
    first = run.run(spark.createDataFrame(rows, PAGES), now=5).first()
    assert (first.admitted, first.skipped_dedup, first.failed) == (2, 2, 2)
    raw = {r.slug: (r.kind, r.content) for r in run.kept.read("raw").collect()}
    assert raw == {"one": ("txt", "one text"), "two": ("html", "<article><p>Two</p></article>")}
    assert {r.markdown for r in run.kept.read("normalised").collect()} == {"one text", "Two"}
    run.run(spark.createDataFrame([("frog", "late", "u", None, "here by now", None, 6)], PAGES), now=6)
    assert [(r.slug, r.attempt) for r in run.failures().collect()] == [("bad", 1)]
    assert run.retry(now=7).first().failed == 1
    assert [(r.slug, r.attempt, r.error, r.failed_at) for r in run.failures().collect()] == [("bad", 2, "no text", 7)]
    assert run.retry(now=8).count() == 0 and run.kept.read("dead_letters").count() == 3
    chunks = spark.read.json(f"{tmp_path}/root/chunks").collect()
    assert len({r.chunk_id for r in chunks}) == len(chunks) == 3 and all(re.fullmatch(r"frog_.*#\d{4}", r.chunk_id) for r in chunks)


def test_log_state_equals_a_replay(spark, tmp_path):
    import json

    from corpusloom.schemas import GOVERNANCE
    from corpusloom.sources.jsonl import read_governance
    from corpusloom.streaming.log_state import LogState

    rng, names = random.Random(8), ["ab", "ab_c", "q"]
    (tmp_path / "log").mkdir()
    state = LogState(spark, str(tmp_path / "state"), names)
    state.follow(str(tmp_path / "nothing"))
    assert state.known_ids().count() == 0
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    for k in range(6):
        rows = [(rng.choice([None, "ab", "zz"]), f"{rng.choice(['ab', 'ab_c', 'q', 'x'])}_s_{rng.randrange(9)}", rng.choice(["cc_by", "Unknown", "paywalled"]), k, f"h{rng.randrange(30)}", rng.random() < 0.5) for _ in range(12)]
        (tmp_path / f"log/{k}.json").write_text("not json\n" + "\n".join(json.dumps(dict(zip(GOVERNANCE.names, r, strict=True))) for r in rows))
        state.follow(str(tmp_path / "log"))
        if k in (0, 5):
            log = governance.attributed(read_governance(spark, str(tmp_path / "log")), names)
            for allow in (("cc_by",), ("cc_by", "unknown")):
                assert same(state.known_ids(allow), governance.known_ids(log, allow)) and same(state.rejected_ids(allow), governance.rejected_ids(log, allow))
            assert same(state.seen_hashes(), governance.seen_hashes(log))
    state.follow(str(tmp_path / "log"))
    assert sorted(f["level"] for f in state.folders("episodes")) == [0, 0, 1] and state.episodes().agg({"events": "sum"}).first()[0] == 72
