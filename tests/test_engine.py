from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom import cli
from corpusloom.errors import BadMagic, ChecksumMismatch, Invariant, RightsGateRefused, Truncated, UnsupportedPackVersion
from corpusloom.operators import chunking, governance, ingest, search
from corpusloom.plans import pack
from corpusloom.plans.build import ingest_folder
from corpusloom.plans.pipeline import Pipeline, exit_code
from corpusloom.schemas import EPISODE, GOVERNANCE
from corpusloom.sources import html
from corpusloom.sources.jsonl import Store, append_jsonl, read_governance
from corpusloom.sources.registry import load_registry
from corpusloom.streaming.incremental import stream_ingest, stream_store


# -- chunking ------------------------------------------------------------------------------------


def test_speaker_turns():
    found = chunking.speaker_turns("# Intro\nSIMON LONDON: Hello\nmore\nBOB:\nADAM GRANT: Hi\n\n## Next\n")
    assert found == [(None, "# Intro"), ("SIMON LONDON", "Hello\nmore\nBOB:"), ("ADAM GRANT", "Hi"), (None, "## Next")]


def test_chunk_rules():
    many = "\n".join(f"{'ABCD'[k]}X: " + "word " * 80 for k in range(4))
    chunks = chunking.chunk_text(many, 100, 20)
    assert len(chunks) >= 2 and all(n <= 300 for *_, n in chunks)
    assert {h for h, *_ in chunking.chunk_text("# Body\nAB: one\n# Wrapup\nAB: two", 200, 20)} == {"Body", "Wrapup"}
    long = chunking.chunk_text("AB: " + " ".join(f"w{k}" for k in range(2000)), 300, 50)
    assert len(long) >= 6 and long[0][1].split()[-50:] == long[1][1].split()[:50]
    tail = chunking.chunk_text("AB: " + " ".join(f"w{k}" for k in range(700)) + "\nBOB: short", 300, 50)
    assert tail[-1][1].split()[:50] == tail[-2][1].split()[-50:] and tail[-1][1].endswith("BOB: short")
    assert chunking.chunk_text(" ".join(["w"] * 400), 300, 0)[-1][2] == 100
    for bad in ((0, 0), (100, 200)):
        with pytest.raises(ValueError):
            chunking.chunk_text("x", *bad)


def test_native_chunks_equal_the_sequential_ones(spark):
    random.seed(3)
    texts = [" ".join(random.choice(["a", "bb,", "c\nd"]) for _ in range(n)) for n in (0, 1, 30, 69, 70, 71, 130, 200, 333)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chunking.plain_chunks(F.col("t"), 70, 12).alias("c")).collect()
    for t, c in rows:
        assert c == [x[1] for x in chunking.chunk_text(t, 70, 12)], t
    chunking.register(spark)
    assert spark.sql("SELECT * FROM chunk_text('a b c', 10, 2)").count() == 1


# -- ingest and governance -----------------------------------------------------------------------


def episode(eid, rights="free_access_copyrighted", publisher="pub", **more):
    base = {"episode_id": eid, "publisher": publisher, "series": "flagship", "title": "T", "publication_date": "", "source_type": "podcast_transcript_html", "language": "en", "primary_url": "https://x.org/" + eid, "rights_code": rights}
    return base | more


def folder(tmp_path, episodes, chunks, publisher="pub"):
    for sub, rows in (("metadata", episodes), ("chunks", chunks)):
        (tmp_path / sub).mkdir(exist_ok=True)
        (tmp_path / sub / f"{publisher}.jsonl").write_text("\n\n".join(json.dumps(r) for r in rows) + "\n")
    return str(tmp_path)


def chunk(eid, k, text):
    return {"chunk_id": f"{eid}#{k:04}", "episode_id": eid, "token_count": 3, "chunk_text": text, "citation_anchor": "a"}


def test_ingest_is_idempotent_and_gated(spark, tmp_path):
    root = folder(tmp_path / "in" if (tmp_path / "in").mkdir() is None else None, [episode("e1", industry_tags=["retail"]), episode("e2", "unknown")], [chunk("e1", 0, "alpha  "), chunk("e1", 1, "alpha"), chunk("e1", 2, "beta"), chunk("e2", 0, "gamma")])
    store = Store(spark, str(tmp_path / "store"))
    first = ingest_folder(store, root, now=5).first().asDict()
    assert first == {"publisher": "pub", "seen": 2, "inserted": 1, "existing": 0, "rejected": 1, "chunks_seen": 4, "chunks_inserted": 2, "chunks_deduped": 1, "chunks_rights_skipped": 1}
    again = ingest_folder(store, root, now=6).first().asDict()
    assert (again["inserted"], again["existing"], again["chunks_inserted"], again["chunks_deduped"]) == (0, 1, 0, 3)
    assert store.counts() == {"episodes": 1, "chunks": 2}
    log = store.read("governance")
    assert log.count() == 4 and log.where("deprecated").count() == 2
    assert store.read("chunks").where("content_hash is null").count() == 0


def test_ingest_refuses(spark, tmp_path):
    with pytest.raises(RightsGateRefused):
        ingest.check_rights("paywalled")
    ingest.check_rights("CC_BY")
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    with pytest.raises(Invariant):
        ingest_folder(Store(spark, str(tmp_path / "s1")), folder(tmp_path / "a", [episode("e1", publisher="other")], []))
    with pytest.raises(Invariant):
        ingest_folder(Store(spark, str(tmp_path / "s2")), folder(tmp_path / "b", [episode("e1")], [chunk("gone", 0, "x")]))
    assert ingest_folder(Store(spark, str(tmp_path / "s3")), str(tmp_path / "nothing")).count() == 0


def test_governance_replay(spark, tmp_path):
    rows = [("ab", "ab_s_1", "cc_by", 1, "h1", False), (None, "ab_c_s_2", "unknown", 2, "h2", True), (None, "zz_1", "cc_by", 3, "h3", False), (None, "ab_s_4", "cc_by", 4, "h4", True)]
    (tmp_path / "log").mkdir()
    (tmp_path / "log/x.jsonl").write_text("not json\n" + "\n".join(json.dumps(dict(zip(GOVERNANCE.names, r, strict=True))) for r in rows))
    log = governance.attributed(read_governance(spark, str(tmp_path / "log")), ["ab", "ab_c"])
    assert {tuple(r) for r in governance.known_ids(log).collect()} == {("ab", "ab_s_1"), ("ab_c", "ab_c_s_2")}
    assert [r[1] for r in governance.skip_set(log, False).collect()] == ["ab_c_s_2"]
    assert governance.skip_set(log, False, ("unknown",)).where("episode_id = 'ab_c_s_2'").count() == 0
    assert {r[0] for r in governance.seen_hashes(log).collect()} == {"h1", "h3"}
    governance.require_subset(governance.rejected_ids(log), governance.known_ids(log))


# -- search --------------------------------------------------------------------------------------

TEXTS = ("BEN: Costco's flywheel works because of the membership fee.", "DAVID: The treasure-hunt format keeps members engaged.", "BEN: Kirkland Signature is the single biggest CPG brand by revenue.")


@pytest.fixture
def corpus(spark):
    rows = [(f"e#{k:04}", "e", t, "a", f"Section {k}", 1000 * (k + 1)) for k, t in enumerate(TEXTS)]
    chunks = search.indexed(spark.createDataFrame(rows, "chunk_id string, episode_id string, chunk_text string, citation_anchor string, section_heading string, created_at long"))
    tags = search.tag_families(spark.createDataFrame([("e", ["retail"], ["strategy"], ["B2C"], ["US"], "podcast")], "episode_id string, industry_tags array<string>, function_tags array<string>, business_model_tags array<string>, country_region array<string>, source_type string"))
    vectors = spark.createDataFrame([("e#0000", "test-3d", [1.0, 0.0, 0.0], 1), ("e#0001", "test-3d", [0.0, 1.0, 0.0], 1), ("e#0002", "test-3d", [1.0, 0.0], 1)], "chunk_id string, model_tag string, embedding array<float>, created_at long")
    return chunks, tags, vectors


def test_search(corpus):
    chunks, tags, vectors = corpus
    find = lambda **q: search.search(chunks, tags, search.SearchQuery(**q), vectors).collect()
    tag = lambda *v: search.TagFilter(industry=v)
    hits = find(text="membership fee")
    assert len(hits) == 1 and "membership" in hits[0].chunk_text and hits[0].bm25_score > 0 and not hits[0].tag_match
    assert all(h.tag_match for h in find(text="Costco", tags=tag("retail"))) and find(text="Costco", tags=tag("finance")) == []
    recent = find(tags=tag("retail"))
    assert [h.chunk_id for h in recent] == ["e#0002", "e#0001", "e#0000"] and all(h.tag_match for h in recent)
    assert find(tags=tag("none")) == [] and find() == [] and find(text="?!") == []
    near = find(query_embedding=(0.9, 0.1, 0.0), semantic_model_tag="test-3d", scope="include_embeddings")
    assert [h.chunk_id for h in near] == ["e#0000", "e#0001"]
    assert find(query_embedding=(0.9, 0.1, 0.0), semantic_model_tag="test-3d", scope="include_embeddings", tags=tag("none")) == []
    both = find(text="members", query_embedding=(1.0, 0.0, 0.0), semantic_model_tag="test-3d", scope="include_embeddings", limit=5)
    assert {h.chunk_id for h in both} == {"e#0000", "e#0001"}
    assert json.loads(search.emit_json(search.search(chunks, tags, search.SearchQuery("Costco"))).first()[0])["chunkId"] == "e#0000"


def test_bm25_against_sqlite(corpus):
    import sqlite3

    chunks, _, _ = corpus
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE f USING fts5(id UNINDEXED, t, tokenize = 'unicode61 remove_diacritics 2')")
    db.executemany("INSERT INTO f VALUES (?, ?)", [(f"e#{k:04}", t) for k, t in enumerate(TEXTS)])
    for phrase in ("the", "membership fee", "ben"):
        wanted = dict(db.execute("SELECT id, -bm25(f) FROM f WHERE f MATCH ?", (f'"{phrase}"',)).fetchall())
        got = {r.chunk_id: r.bm25 for r in search.bm25_phrase(chunks, phrase.split()).collect()}
        assert got.keys() == wanted.keys() and all(abs(got[k] - wanted[k]) < 1e-9 for k in got)


# -- packs, stream, sources, pipeline ------------------------------------------------------------


def test_pack_round_trip_and_damage(spark, tmp_path):
    (tmp_path / "in").mkdir()
    store = Store(spark, str(tmp_path / "store"))
    ingest_folder(store, folder(tmp_path / "in", [episode("e1", industry_tags=["retail"])], [chunk("e1", k, t) for k, t in enumerate(TEXTS)]))
    path = tmp_path / "x.pack"
    manifest = pack.build(store, str(path), level=3, notes="n")
    assert manifest["chunk_count"] == 3 and manifest["publishers"] == [{"publisher": "pub", "episode_count": 1, "chunk_count": 3}]
    session = pack.Session(spark)
    handle = session.open_pack(str(path))
    assert handle == 1 and session.search(handle, {"text": "Costco", "tags": {"industry": ["retail"]}, "unknownKey": 1}).count() == 1
    session.close_pack(handle), session.close_pack(handle)
    data = path.read_bytes()
    cases = [(b"", Truncated), (data[:5], Truncated), (b"WRONG" + data[5:], BadMagic), (data[:5] + b"\x63" + data[6:], UnsupportedPackVersion), (data[:6] + b"\xff" * 8 + data[14:], Truncated), (data[:-4] + bytes([data[-4] ^ 1]) + data[-3:], ChecksumMismatch)]
    for bad, error in cases:
        with pytest.raises(error):
            pack.Pack(bad)
    assert cli.main(["search", "--pack", str(path), "--query", "costco", "--json"]) == 0
    assert cli.main(["search", "--pack", str(path), "--query", "  "]) == 2 and cli.main(["search", "--pack", str(path), "--limit", "0"]) == 2
    assert cli.main(["build", "--packs-root", str(tmp_path / "none"), "--output", str(path)]) == 1


def test_stream_ingest(spark, tmp_path):
    src, out, state = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = "episode_id string, text string, rights_code string"
    spark.createDataFrame([("a", "one", "cc_by"), ("b", "one ", "cc_by"), ("c", "two", "unknown")], schema).coalesce(1).write.parquet(src)
    run = lambda: stream_ingest(spark.readStream.schema(schema).parquet(src), out, state).awaitTermination()
    run()
    assert [r.episode_id for r in stream_store(spark, out).read("admitted").collect()] == ["a"]
    spark.createDataFrame([("d", "one", "cc_by"), ("a", "new", "cc_by"), ("e", "three", "CC_BY")], schema).coalesce(1).write.mode("append").parquet(src)
    run(), run()
    assert {r.episode_id for r in stream_store(spark, out).read("admitted").collect()} == {"a", "e"}


def test_sources():
    sources = load_registry()
    assert len(sources) == 17 and list(sources) == sorted(sources)
    for s in sources.values():
        assert s.rights_code in ("ogl_v3", "cc_by_nc_nd", "free_access_copyrighted") and (s.target_tokens, s.overlap_tokens) == (700, 120) and s.industry_tags and s.country_region
    assert html.source_markdown("<nav>x</nav><h2>Transcript</h2><p>BEN: hi<h3>Sub</h3><p>yes<h2>More</h2><p>no", "exit_five") == "BEN: hi\n\n### Sub\n\nyes"
    assert html.source_markdown("<main><p>x</main>", "masters_of_scale") == ""
    assert html.source_markdown("<article><p>a</p><h3>Related articles</h3><p>b</p></article>", "mckinsey") == "a"
    assert html.guests("<p>Guest: Ann Lee and Bo Ek</p>", "bcg") == ["Ann Lee", "Bo Ek"]
    assert html.assets('<a href="/x.pdf">p</a><a href="/x.pdf">q</a><a href="y.html">r</a>', "rics", "https://www.rics.org/a") == ["https://www.rics.org/x.pdf"]
    assert html.slugs("<loc>https://mastersofscale.com/episode/one/</loc><loc>https://mastersofscale.com/episode/one</loc>", "masters_of_scale") == ["one"]
    ld = '<script type="application/ld+json">[{"@type":"Episode","actor":[{"name":"Al"},"Bo"]},1]</script><script type="application/ld+json">{bad</script>'
    assert html.ld_people(ld, "actor") == ["Al", "Bo"] and html.is_type(html.json_ld(ld)[0], "Episode")


def test_pipeline_verdicts(spark, tmp_path):
    sources = {k: v for k, v in load_registry().items() if k in ("frog", "ncsc")}
    page = "<article><p>{}</p></article>"
    rows = [("frog", "one", "u1", page.format("HOST: first"), None, None, 1), ("frog", "two", "u2", page.format("HOST: first"), None, None, 2), ("frog", "three", "u3", page.format("x"), None, "paywalled", 3), ("ncsc", "g", "u4", None, "body text", None, 4)]
    pages = spark.createDataFrame(rows, "publisher_id string, slug string, url string, html string, body string, rights_code string, seq long")
    root = str(tmp_path / "root")
    got = {r.publisher_id: r for r in Pipeline(spark, sources, root).run(pages, now=7).collect()}
    assert (got["frog"].admitted, got["frog"].skipped_dedup, got["frog"].rejected_rights, got["ncsc"].admitted) == (1, 1, 1, 1)
    again = {r.publisher_id: r for r in Pipeline(spark, sources, root, incremental=True).run(pages).collect()}
    assert (again["frog"].skipped_incremental, again["frog"].skipped_dedup, again["ncsc"].skipped_incremental, again["ncsc"].seen) == (2, 1, 1, 0)
    opened = {r.publisher_id: r for r in Pipeline(spark, sources, root, allow=("paywalled", "ogl_v3")).run(pages).collect()}
    assert opened["frog"].admitted == 1 and opened["frog"].rejected_rights == 2 and opened["ncsc"].skipped_dedup == 1
    assert exit_code({"seen": 3}) == 1 and exit_code({"seen": 3, "skipped_dedup": 1}) == 0 and exit_code({}) == 0
    assert spark.read.schema(EPISODE).json(f"{root}/metadata").count() == 3


def test_append_jsonl_keeps_nulls(spark, tmp_path):
    append_jsonl(spark.createDataFrame([("a", None)], "x string, y string"), str(tmp_path / "j"))
    assert '"y":null' in "".join(f.read_text() for f in sorted((tmp_path / "j").glob("*.json")))


def test_blake3_batches():
    from corpusloom.functions.hashing import blake3_hex, blake3_many

    assert blake3_hex(b"") == "af1349b9f5f9a1a6a0404dea36dcc9499bcb25c9adc112b7cc9a93cae41f3262"
    assert blake3_hex(b"abc") == "6437b3ac38465133ffb63b75273a8db548c558465d79db03fd359c6cd5bd9d85"
    texts = [bytes(k % 251 for k in range(n)) for n in (0, 1, 64, 1023, 1024, 1025, 2049, 3073, 9000)]
    assert blake3_many(texts) == [blake3_hex(t) for t in texts] and blake3_many([]) == []


def one_by_one(rows, held_keys, held_contents):
    keys, contents, found = set(held_keys), set(held_contents), []
    for seq, key, content in sorted(rows):
        if content not in contents and key not in keys:
            found.append((key, content))
            keys.add(key)
            contents.add(content)
    return sorted(found)


def test_chunks_as_if_inserted_one_by_one(spark):
    held = spark.createDataFrame([("c1", "held text")], "chunk_id string, content_key string")
    same = [(1, "c1", "same"), (2, "c2", "same")]
    df = lambda rows: spark.createDataFrame(rows, "seq long, chunk_id string, content_key string")
    take = lambda rows, held: sorted((r.chunk_id, r.content_key) for r in ingest.admitted_in_order(df(rows), held, "chunk_id", "content_key", ["seq"]).collect())
    assert take(same, held) == [("c2", "same")]
    random.seed(9)
    for size in (1, 12, 60):
        rows = [(k, f"c{random.randrange(size)}", f"t{random.randrange(size)}") for k in range(2 * size)]
        assert take(rows, held) == one_by_one(rows, {"c1"}, {"held text"})
    chain = [(k, f"c{k // 2}", f"t{(k + 1) // 2}") for k in range(12)]
    assert take(chain, held.limit(0)) == one_by_one(chain, (), ())


def test_rows_come_in_the_order_of_files(spark, tmp_path):
    (tmp_path / "chunks").mkdir()
    sizes = {"a": 5, "b": 2000, "c": 100}
    for name, n in sizes.items():
        (tmp_path / "chunks" / f"{name}.jsonl").write_text("\n".join(json.dumps(chunk(name, k, f"{name} {k}")) for k in range(n)))
    from corpusloom.sources.jsonl import read_chunks

    rows = [r.chunk_id for r in read_chunks(spark, str(tmp_path)).orderBy("seq").select("chunk_id").collect()]
    assert rows == [f"{name}#{k:04}" for name, n in sizes.items() for k in range(n)]


def test_search_without_caps(corpus, monkeypatch):
    chunks, tags, vectors = corpus
    monkeypatch.setattr(search, "FTS_CAP", 1)
    monkeypatch.setattr(search, "SEMANTIC_CAP", 1)
    query = dict(text="the", query_embedding=(0.1, 0.9, 0.0), semantic_model_tag="test-3d", scope="include_embeddings")
    ids = lambda **more: {h.chunk_id for h in search.search(chunks, tags, search.SearchQuery(**query, **more), vectors).collect()}
    assert len(ids()) < len(ids(lane_caps=False)) == 3


def test_entry_without_a_library_of_the_subpackage(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    (tmp_path / "public_tokenizers.py").write_text("raise ModuleNotFoundError('not here', name='public_tokenizers')")
    code = f"import sys; sys.path[:0] = [{str(tmp_path)!r}, {str(root)!r}]; import __spark_entry__ as e; assert 'hybrid_search' in e.queries() and 'pipeline' not in e.queries()"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True).returncode == 0


def test_crawl_build_search(spark, tmp_path):
    sources = {k: v for k, v in load_registry().items() if k in ("frog", "acquired")}
    head = '<head><title>A talk</title><meta name="description" content="What &amp; why"><script type="application/ld+json">{"@graph":[{"@type":"PodcastEpisode","actor":[{"name":"Ann Lee"}]}]}</script></head>'
    rows = [("frog", "one", "https://x.org/1", "<article><p>HOST: about widgets</p></article>", 1), ("acquired", "two", "https://x.org/2", f'{head}<div class="transcript"><p>HOST: about gadgets</p></div>', 2)]
    pages = spark.createDataFrame(rows, "publisher_id string, slug string, url string, html string, seq long").withColumn("body", F.lit(None).cast("string"))
    root, packed = str(tmp_path / "root"), str(tmp_path / "x.pack")
    Pipeline(spark, sources, root).run(pages, now=7)
    assert cli.main(["build", "--packs-root", root, "--output", packed]) == 0
    store = pack.Pack.open(spark, packed).store(spark)
    episodes = {r.publisher: r for r in store.read("episodes").collect()}
    assert set(episodes) == {"frog", "acquired"} and store.read("chunks").count() == 2
    assert (episodes["acquired"].guest, episodes["acquired"].summary, episodes["acquired"].title) == (["Ann Lee"], "What & why", "A talk")
    assert episodes["acquired"].rights_summary and episodes["acquired"].credibility_notes
    found = search.search(search.indexed(store.read("chunks")), search.tag_families(store.read("episodes")), search.SearchQuery("gadgets")).collect()
    assert [h.episode_id for h in found] == [episodes["acquired"].episode_id]


def test_transcript_links_and_plain_rows(spark):
    link = lambda page, source: html.transcript_link(page, source, "https://p.org/a/")
    assert link('<a href="x.pdf">Slides</a><a href="/t.pdf">Read the transcript</a>', "bcg") == "https://p.org/t.pdf"
    assert link('<a href="https://web-assets.bcg.com/ab/ep-Transcript.pdf">Here</a>', "bcg") == "https://web-assets.bcg.com/ab/ep-Transcript.pdf"
    assert link('<a href="/wp-content/uploads/a.pdf">Transcript.</a><a href="/b.pdf">Episode transcript</a>', "thomson_reuters") == "https://p.org/b.pdf"
    assert link('<a href="/c.pdf">Transcript</a><a href="/wp-content/uploads/a.pdf">Transcript.</a>', "thomson_reuters") == "https://p.org/wp-content/uploads/a.pdf"
    assert link('<a href="/c.pdf">Transcript</a>', "thomson_reuters") is None and link('<a href="/c.pdf">Transcript</a>', "frog") is None
    from corpusloom.sources.jsonl import as_dict

    row = spark.sql("SELECT 1 AS a, struct(2 AS b, array(struct(3 AS c)) AS d) AS e, map('k', struct(4 AS f)) AS g").first()
    assert as_dict(row) == {"a": 1, "e": {"b": 2, "d": [{"c": 3}]}, "g": {"k": {"f": 4}}}
