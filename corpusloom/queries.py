"""Registered queries over the test tables, each with its DuckDB counterpart where SQL has one.

Documents stand for episodes and chunks, labels for tags, conversations for speaker turns, pages for
landed pages and events for the governance log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import storage
from corpusloom.functions import hashing, text, vectors
from corpusloom.operators import chunking, governance, ingest, search
from corpusloom.operators.postings import Index
from corpusloom.operators.vector_index import VectorIndex
from corpusloom.plans import build, pack, pipeline
from corpusloom.schemas import EPISODE
from corpusloom.sources import html, jsonl
from corpusloom.sources.registry import load_registry, registry_frame
from corpusloom.streaming import incremental
from corpusloom.streaming.log_state import LogState

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    storage.small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- views of the test tables --------------------------------------------------------------------

#: Rights code by last digit of the document's id, in mixed case.
CODES = ("CC_BY", "ogl_v3", "Free_Access_Copyrighted", "unknown", "public_domain", "paywalled", "cc_by_nd", "cc_by_sa", "cc_by_nc", "CC_BY_NC_ND")
ALLOW_SQL = "lower(rights_code) IN ('ogl_v3','cc_by','cc_by_sa','cc_by_nc','cc_by_nc_nd','free_access_copyrighted','public_domain')"
BASE = 1_600_000_000
CODE_SQL = "CASE doc_id % 10 " + " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(CODES)) + " END"
CANON_SQL = r"regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace({}, '\r\n?', chr(10), 'g'), chr(9), ' '), '[ \f\v]+(\n|$)', '\1', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"
TOKENS_SQL = r"len(regexp_extract_all({}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]'))"
FTS_SQL = r"regexp_extract_all(lower(strip_accents({})), '[\p{{L}}\p{{N}}]+')"

EPISODES_SQL = f"""episodes AS (
  SELECT d.doc_id, d.source || '_flagship_' || d.doc_id AS episode_id, d.source AS publisher, d.lang, d.text, {CODE_SQL.replace('doc_id', 'd.doc_id')} AS rights_code,
    [d.lang] AS industry_tags, ['f' || (d.doc_id % 4)] AS function_tags,
    CASE WHEN l.toxic = 1 THEN ['regulated'] WHEN l.toxic = 0 THEN ['b2b', 'saas'] ELSE [] END AS business_model_tags,
    [CASE WHEN d.doc_id % 3 = 0 THEN 'US' ELSE 'global' END] AS geography_tags,
    [CASE WHEN l.quality = 1 THEN 'quality' WHEN l.quality = 0 THEN 'junk' ELSE 'unrated' END] AS evidence_type,
    {BASE} + d.doc_id * 60 AS created_at
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    code = F.element_at(F.array(*map(F.lit, CODES)), (F.col("doc_id") % 10 + 1).cast("int"))
    none = F.array().cast("array<string>")
    return d.select("doc_id", "text", "lang", "source").join(labels.select("doc_id", "quality", "toxic"), "doc_id", "left").select(
        "doc_id", F.concat("source", F.lit("_flagship_"), F.col("doc_id").cast("string")).alias("episode_id"), F.col("source").alias("publisher"), "lang", "text", code.alias("rights_code"),
        F.array("lang").alias("industry_tags"), F.array(F.concat(F.lit("f"), (F.col("doc_id") % 4).cast("string"))).alias("function_tags"),
        F.when(F.col("toxic") == 1, F.array(F.lit("regulated"))).when(F.col("toxic") == 0, F.array(F.lit("b2b"), F.lit("saas"))).otherwise(none).alias("business_model_tags"),
        F.array(F.when(F.col("doc_id") % 3 == 0, "US").otherwise("global")).alias("geography_tags"),
        F.array(F.when(F.col("quality") == 1, "quality").when(F.col("quality") == 0, "junk").otherwise("unrated")).alias("evidence_type"),
        (F.lit(BASE) + F.col("doc_id") * 60).cast("long").alias("created_at"),
    )


def plain_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes without tags, so without the labels' join."""
    d = table(spark, sf_dir, "documents")
    code = F.element_at(F.array(*map(F.lit, CODES)), (F.col("doc_id") % 10 + 1).cast("int"))
    return d.select("doc_id", F.concat("source", F.lit("_flagship_"), F.col("doc_id").cast("string")).alias("episode_id"), F.col("source").alias("publisher"), "lang", "text", code.alias("rights_code"))


_made: dict[tuple, object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, make):
    """What ``make`` gives, made once a session: a store and an index outlive a query."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def chunk_index(spark: SparkSession, sf_dir: str) -> jsonl.Store:
    """A store with a chunk a document and its full-text index, filled by two inserts, a source at a
    time in halves of all sources. Searches by tags and vectors alone need no index, so they take the
    rows as they are."""

    def make():
        store = jsonl.Store(spark, storage.shared_dir(spark))
        rows = _chunk_rows(spark, sf_dir)
        for half in (0, 1):
            store.run(lambda tx, half=half: store.add_chunks(tx, rows.where(F.pmod(F.hash("publisher"), F.lit(2)) == half)))
        return store

    return once(spark, sf_dir, "index", make)


def chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_index(spark, sf_dir).read("chunks")


def _chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    rows = d.select(
        F.concat("source", F.lit("_flagship_"), F.col("doc_id").cast("string")).alias("episode_id"), F.col("text").alias("chunk_text"), (F.lit(BASE) + F.col("doc_id") * 60).cast("long").alias("created_at"),
        F.concat(F.lit("https://example.com/"), F.col("doc_id").cast("string")).alias("citation_anchor"), F.lit(None).cast("string").alias("section_heading"), F.col("source").alias("publisher"),
        F.lit(0).alias("token_count"), F.lit(None).cast("string").alias("content_key"), F.lit(None).cast("string").alias("content_hash"),
    )
    return rows.withColumn("chunk_id", F.concat("episode_id", F.lit("#0000")))


def vector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, d = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "documents")
    keyed = d.select("doc_id", F.concat("source", F.lit("_flagship_"), F.col("doc_id").cast("string"), F.lit("#0000")).alias("chunk_id"))
    return e.join(keyed, e.vec_id == keyed.doc_id).select("chunk_id", F.concat(F.lit("m"), (F.col("label") % 2).cast("string")).alias("model_tag"), "embedding")


def first_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    return table(spark, sf_dir, "embeddings").where("vec_id = 0").select("embedding").first()[0]


CHUNKS_SQL = f"chunks AS (SELECT source || '_flagship_' || doc_id AS episode_id, source || '_flagship_' || doc_id || '#0000' AS chunk_id, text AS chunk_text, {BASE} + doc_id * 60 AS created_at, {FTS_SQL.format('text')} AS tokens FROM documents)"
VECTORS_SQL = "vecs AS (SELECT d.source || '_flagship_' || d.doc_id || '#0000' AS chunk_id, d.source || '_flagship_' || d.doc_id AS episode_id, 'm' || (e.label % 2) AS model_tag, e.embedding::DOUBLE[] AS v FROM embeddings e JOIN documents d ON e.vec_id = d.doc_id), q AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = 0)"


def bm25_sql(phrase: list[str], name: str = "lane") -> str:
    k = len(phrase)
    wanted = "[" + ", ".join(f"'{p}'" for p in phrase) + "]"
    count = f"len(list_filter(range(1, len(tokens) - {k} + 2), lambda i: tokens[i:i + {k} - 1] = {wanted}))" if k > 1 else f"len(list_filter(tokens, lambda t: t = '{phrase[0]}'))"
    return (
        f"counted AS (SELECT *, len(tokens) AS dl, {count} AS f FROM chunks), stats AS (SELECT count(*) AS n_all, avg(dl) AS avgdl, count(*) FILTER (WHERE f > 0) AS n_hit FROM counted), "
        f"{name} AS (SELECT chunk_id, episode_id, created_at, CASE WHEN ln((n_all - n_hit + 0.5) / (n_hit + 0.5)) <= 0 THEN 1e-6 ELSE ln((n_all - n_hit + 0.5) / (n_hit + 0.5)) END * f * 2.2 / (f + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl)) AS bm25 FROM counted, stats WHERE f > 0)"
    )


# -- text functions ------------------------------------------------------------------------------

_MESSY = "chr(32) || text || chr(9) || chr(13) || chr(10) || chr(10) || chr(10) || chr(13) || chr(10) || 'end' || chr(9) || 'x  ' || chr(10)"
_messy = lambda: F.concat(F.lit(" "), "text", F.lit("\t\r\n\n\n\r\nend\tx  \n"))


@query(f"SELECT doc_id, sha256({CANON_SQL.format('(' + _MESSY + ')')}) AS canonical_sha FROM documents")
def canonicalise(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", hashing.dedup_key(text.canonicalise(_messy())).alias("canonical_sha"))


@query(f"SELECT doc_id, CAST({TOKENS_SQL.format('text')} AS BIGINT) AS n_tokens FROM documents")
def token_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.count_tokens("text").cast("long").alias("n_tokens"))


@query(r"SELECT doc_id, sha256(trim(regexp_replace(lower(strip_accents(text)), '[^\p{L}\p{N}]+', '-', 'g'), '-')) AS slug_sha FROM documents")
def slugify_latin(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.slugify_native("text"), 256).alias("slug_sha"))


@query(ORACLE_SQL["slugify_latin"])
def slugify_ascii(spark, sf_dir):
    """The Python function, over all texts."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.slugify("text"), 256).alias("slug_sha"))


@query(r"SELECT doc_id, sha256(trim(regexp_replace(lower(strip_accents(text || ' ﬁn Ⅷ ½ Å ①') ), '[^\p{L}\p{N}]+', '-', 'g'), '-')) AS slug_sha FROM documents".replace("text || ' ﬁn Ⅷ ½ Å ①'", "text || ' fin VIII 1-2 A 1'"))
def slugify_unicode(spark, sf_dir):
    """Letters, numbers and fractions that decompose into others, beside the accents of the texts."""
    mixed = F.concat("text", F.lit(" ﬁn Ⅷ ½ Å ①"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.slugify_native(mixed), 256).alias("slug_sha"))


@query(r"SELECT doc_id, sha256(trim(regexp_replace(text || chr(10) || '  ' || chr(10) || chr(9) || 'x', '\s+', ' ', 'g'))) AS sha FROM documents")
def collapse_whitespace(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.collapse_whitespace(F.concat("text", F.lit("\n  \n\tx"))), 256).alias("sha"))


@query(r"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(text || chr(10) || '  ' || chr(10) || chr(10) || chr(10) || chr(10) || 'x', chr(13), chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]+(\n|$)', '\1', 'g'), '^\s+|\s+$', '', 'g') AS tidy FROM documents")
def collapse_blank_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.collapse_blank_lines(F.concat("text", F.lit("\n  \n\n\n\nx"))).alias("tidy"))


@query("SELECT doc_id, CASE WHEN length(text) > 280 THEN left(text, 280) || '…' ELSE text END AS shown FROM documents")
def truncate_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.truncate_text("text").alias("shown"))


@query("SELECT doc_id, source || '_flagship_' || doc_id || '#' || CASE WHEN doc_id < 10000 THEN lpad(CAST(doc_id AS VARCHAR), 4, '0') ELSE CAST(doc_id AS VARCHAR) END AS chunk_id FROM documents")
def chunk_ids(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.chunk_id(text.episode_id(F.col("source"), F.lit("flagship"), F.col("doc_id").cast("string")), F.col("doc_id")).alias("chunk_id"))


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def content_hash_sha(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", hashing.dedup_key(F.col("text")).alias("sha"))


@query()
def content_hash_blake3(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", hashing.content_hash("text").alias("content_hash"))


@query(r"SELECT doc_id, list_filter(list_transform(regexp_split_to_array(replace(text, chr(10), ' '), ',| and '), lambda x: trim(x)), lambda x: length(x) > 0) AS names FROM documents")
def split_names(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.split_names(F.replace("text", F.lit("\n"), F.lit(" "))).alias("names"))


@query(r"SELECT doc_id, sha256(trim(regexp_replace(text || ' (Transcript)', '\s*[(\[]?\s*[Tt]ranscript\s*[)\]]?\s*$', ''))) AS title_sha FROM documents")
def transcript_suffix(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.sha2(text.strip_transcript_suffix(F.concat("text", F.lit(" (Transcript)"))), 256).alias("title_sha"))


@query("SELECT doc_id, sha256(text || ' <&>') AS sha FROM documents")
def html_unescape(spark, sf_dir):
    escaped = F.replace(F.replace(F.concat("text", F.lit(" <&>")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.unescape_html(escaped), 256).alias("sha"))


@query("SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/x/' || page_id AS link FROM pages")
def absolute_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.url_join("url", F.concat(F.lit("/x/"), F.col("page_id").cast("string"))).alias("link"))


# -- rights, ingest, deduplication ---------------------------------------------------------------


@query(f"SELECT doc_id, {ALLOW_SQL} AS admitted FROM (SELECT doc_id, {CODE_SQL} AS rights_code FROM documents)")
def rights_gate(spark, sf_dir):
    return plain_episodes(spark, sf_dir).select("doc_id", ingest.rights_allowed(F.col("rights_code")).alias("admitted"))


@query(f"SELECT doc_id, lower(rights_code) IN ('unknown', 'paywalled') AS admitted FROM (SELECT doc_id, {CODE_SQL} AS rights_code FROM documents)")
def rights_gate_override(spark, sf_dir):
    return plain_episodes(spark, sf_dir).select("doc_id", ingest.rights_allowed(F.col("rights_code"), ("Unknown", "PAYWALLED")).alias("admitted"))


@query(f"SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 2 = 0 THEN '' ELSE {CODE_SQL} END, ''), 'cc_by') AS code FROM documents")
def rights_override_by_episode(spark, sf_dir):
    e = plain_episodes(spark, sf_dir)
    return e.select("doc_id", ingest.effective_rights(F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("rights_code")), F.lit("cc_by")).alias("code"))


@query(f"SELECT source AS publisher_id, source || '_flagship_' || doc_id AS episode_id, rights_code, true AS deprecated FROM (SELECT *, {CODE_SQL} AS rights_code FROM documents) WHERE NOT ({ALLOW_SQL})")
def rights_rejected_log(spark, sf_dir):
    e = plain_episodes(spark, sf_dir).where(~ingest.rights_allowed(F.col("rights_code")))
    return e.select(F.col("publisher").alias("publisher_id"), "episode_id", "rights_code", F.lit(True).alias("deprecated"))


@query("SELECT doc_id, text_sha, copies FROM (SELECT min(doc_id) AS doc_id, sha256(text) AS text_sha, count(*) AS copies FROM documents GROUP BY text)")
def content_dedup_first_wins(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", hashing.dedup_key(F.col("text")).alias("text_sha"))
    return d.groupBy("text_sha").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


#: What a store holds before: the documents of a language.
_HELD = "lang = 'de'"


@query(f"SELECT source || '_flagship_' || doc_id AS episode_id, source AS publisher FROM documents WHERE NOT {_HELD}")
def insert_or_ignore_episode(spark, sf_dir):
    e = plain_episodes(spark, sf_dir).withColumn("seq", F.col("doc_id"))
    return ingest.insert_or_ignore(e.unionByName(e).select("episode_id", "publisher", "seq"), e.where(_HELD), "episode_id", ["seq"]).select("episode_id", "publisher")


@query("WITH n AS (SELECT sha256(text) AS chunk_id, doc_id AS seq, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) SELECT chunk_id, seq FROM n WHERE k = 1 AND chunk_id NOT IN (SELECT sha256(text) FROM documents WHERE source = (SELECT min(source) FROM documents))")
def chunk_pk_conflict(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(hashing.dedup_key(F.col("text")).alias("chunk_id"), F.col("doc_id").alias("seq"), "source")
    held = d.join(d.agg(F.min("source").alias("source")), "source", "left_semi")
    return ingest.insert_or_ignore(d.select("chunk_id", "seq"), held, "chunk_id", ["seq"])


#: The first copy of every text has an id that is held for another text, so the second goes in.
@query("WITH n AS (SELECT 'c' || doc_id AS chunk_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY text) AS copies FROM documents) SELECT chunk_id, sha256(text) AS content_key FROM n WHERE k = CASE WHEN copies > 1 THEN 2 ELSE 1 END")
def insert_chunks_in_order(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("chunk_id"), hashing.dedup_key(F.col("text")).alias("content_key"), F.col("doc_id").alias("seq"))
    copied = d.groupBy("content_key").agg(F.min_by("chunk_id", "seq").alias("chunk_id"), F.count("*").alias("copies")).where("copies > 1")
    held = copied.select("chunk_id", F.concat(F.lit("other "), "content_key").alias("content_key"))
    return ingest.admitted_in_order(d, held, "chunk_id", "content_key", ["seq"]).select("chunk_id", "content_key")


@query("SELECT 'k' || o_orderkey AS chunk_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0)")
def orphan_chunks(spark, sf_dir):
    chunks = table(spark, sf_dir, "orders").select(F.concat(F.lit("k"), F.col("o_orderkey").cast("string")).alias("chunk_id"), F.col("o_custkey").alias("episode_id"))
    held = table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("episode_id"))
    return ingest.orphans(chunks, held).select("chunk_id")


_STATS_SQL = f"""
e AS (SELECT *, source AS publisher, source || '_flagship_' || doc_id AS episode_id, {CODE_SQL} AS rights_code FROM documents),
j AS (SELECT *, {ALLOW_SQL} AS ok, sha256({CANON_SQL.format('text')}) AS k FROM e),
w AS (SELECT k, min(doc_id) AS doc_id FROM j WHERE ok GROUP BY k),
s AS (SELECT publisher, count(*) AS seen, count(*) FILTER (WHERE ok AND NOT lang = 'de') AS inserted, count(*) FILTER (WHERE ok AND lang = 'de') AS existing, count(*) FILTER (WHERE NOT ok) AS rejected,
  count(*) AS chunks_seen, count(*) FILTER (WHERE ok AND w.doc_id IS NOT NULL AND NOT j.k IN (SELECT k FROM j WHERE lang = 'de')) AS chunks_inserted,
  count(*) FILTER (WHERE ok AND NOT (w.doc_id IS NOT NULL AND NOT j.k IN (SELECT k FROM j WHERE lang = 'de'))) AS chunks_deduped, count(*) FILTER (WHERE NOT ok) AS chunks_rights_skipped
  FROM j LEFT JOIN w USING (doc_id) GROUP BY publisher)"""


def _ingested(spark, sf_dir):
    e = plain_episodes(spark, sf_dir).withColumn("seq", F.col("doc_id"))
    chunks = e.select(F.concat("episode_id", F.lit("#0000")).alias("chunk_id"), "episode_id", F.col("text").alias("chunk_text"), "seq")
    held = e.where(_HELD)
    held_chunks = held.select(F.concat("episode_id", F.lit("#0000")).alias("chunk_id"), hashing.dedup_key(text.canonicalise("text")).alias("content_key"))
    return ingest.ingest(e.select("episode_id", "publisher", "rights_code", "seq"), chunks, held, held_chunks)


@query(f"WITH {_STATS_SQL} SELECT * FROM s".replace("LEFT JOIN w USING (doc_id)", "LEFT JOIN (SELECT doc_id FROM w) w ON w.doc_id = j.doc_id").replace("(WHERE ok AND NOT doc_id", "(WHERE ok AND NOT j.doc_id").replace("(WHERE ok AND doc_id", "(WHERE ok AND j.doc_id"))
def ingest_stats(spark, sf_dir):
    return _ingested(spark, sf_dir)[2]


@query("SELECT " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ingest.STATS) + " FROM (" + ORACLE_SQL["ingest_stats"] + ")")
def ingest_totals(spark, sf_dir):
    return ingest.totals(_ingested(spark, sf_dir)[2])


@query("SELECT c_mktsegment AS publisher, count(DISTINCT c_custkey) AS episode_count, count(o_orderkey) AS chunk_count FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def publisher_manifest(spark, sf_dir):
    e = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("publisher"), F.col("c_custkey").alias("episode_id"))
    return ingest.publisher_manifest(e, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("episode_id"), F.col("o_orderkey").alias("chunk_id")))


@query("SELECT count(*) AS episode_count, count(DISTINCT source) AS publisher_count FROM documents")
def global_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("episode_count"), F.countDistinct("source").alias("publisher_count"))


@query(f"SELECT source || '_flagship_' || doc_id AS episode_id FROM documents WHERE source <> lang")
def publisher_agreement(spark, sf_dir):
    e = plain_episodes(spark, sf_dir)
    return ingest.disagreeing(e, "lang").select("episode_id")


_PUBLISHERS = ("click", "view", "purchase", "error", "error_late")
LOG_SQL = """log AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type END AS publisher_id,
  event_type || CASE WHEN event_id % 5 = 0 THEN '_late' ELSE '' END || '_s_' || user_id AS episode_id,
  CASE event_id % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN 'paywalled' ELSE 'CC_BY' END AS rights_code,
  floor(epoch(ts))::BIGINT AS ingestion_date, md5('' || user_id) AS content_hash, event_id % 4 < 2 AS deprecated FROM events),
 reg AS (SELECT unnest(['click', 'view', 'purchase', 'error', 'error_late']) AS pid),
 att AS (SELECT log.*, coalesce((SELECT pid FROM reg WHERE pid = publisher_id), (SELECT max_by(pid, length(pid)) FROM reg WHERE starts_with(episode_id, pid || '_'))) AS publisher FROM log)"""


# -- JSON Lines, stores, packs, landing, stream ---------------------------------------------------


def _episode_rows(spark, sf_dir):
    e, d = plain_episodes(spark, sf_dir), {}
    values = {"series": F.lit("flagship"), "title": F.sha2("text", 256), "host": F.array("lang"), "publication_date": F.lit("2024-01-02"), "country_region": F.array(F.lit("US")), "source_type": F.lit("podcast_transcript_html"), "language": F.col("lang"), "primary_url": F.concat(F.lit("https://example.com/"), F.col("doc_id").cast("string"))}
    for f in EPISODE.fields:
        held = values.get(f.name)
        d[f.name] = held if held is not None else F.col(f.name) if f.name in ("episode_id", "publisher", "rights_code") else F.lit(None).cast(f.dataType)
    return e.select(*(c.alias(name) for name, c in d.items()))


def _json_folder(spark, sf_dir):
    """The test documents as JSON Lines of episodes and chunks, by publisher."""

    def make():
        root = storage.shared_dir(spark)
        jsonl.append_jsonl(_episode_rows(spark, sf_dir), f"{root}/metadata", "publisher")
        d = plain_episodes(spark, sf_dir)
        chunks = d.select(
            F.concat("episode_id", F.lit("#0000")).alias("chunk_id"), "episode_id", F.length("text").alias("token_count"), F.lit(None).cast("string").alias("section_heading"),
            F.col("text").alias("chunk_text"), F.lit("https://example.com/").alias("citation_anchor"), "publisher",
        )
        jsonl.append_jsonl(chunks.withColumn("by", F.col("publisher")).drop("publisher"), f"{root}/chunks", "by")
        return root

    return once(spark, sf_dir, "json", make)


def _json_log(spark, sf_dir):
    """The log as JSON Lines, in a folder of its own."""

    def make():
        path = f"{storage.shared_dir(spark)}/governance"
        jsonl.append_jsonl(_log(spark, sf_dir).select("publisher_id", "episode_id", "rights_code", "ingestion_date", "content_hash", "deprecated"), path)
        return path

    return once(spark, sf_dir, "json log", make)


@query(f"SELECT source || '_flagship_' || doc_id AS episode_id, source AS publisher, source AS stem, {CODE_SQL} AS rights_code, [lang] AS host, sha256(sha256(text)) AS title_sha FROM documents")
def jsonl_metadata_scan(spark, sf_dir):
    rows = jsonl.read_metadata(spark, _json_folder(spark, sf_dir))
    return rows.select("episode_id", "publisher", "stem", "rights_code", "host", F.sha2("title", 256).alias("title_sha"))


@query("SELECT source || '_flagship_' || doc_id || '#0000' AS chunk_id, CAST(length(text) AS INT) AS token_count, sha256(text) AS text_sha FROM documents")
def jsonl_chunk_scan(spark, sf_dir):
    rows = jsonl.read_chunks(spark, _json_folder(spark, sf_dir))
    return rows.select("chunk_id", "token_count", F.sha2("chunk_text", 256).alias("text_sha"))


@query(f"WITH {LOG_SQL} SELECT publisher_id, episode_id, rights_code, ingestion_date, deprecated, count(*) AS n FROM log GROUP BY ALL")
def jsonl_governance_scan(spark, sf_dir):
    rows = jsonl.read_governance(spark, _json_log(spark, sf_dir))
    return rows.groupBy("publisher_id", "episode_id", "rights_code", "ingestion_date", "deprecated").agg(F.count("*").alias("n"))


def _stored(spark, sf_dir):
    """A store that has taken in the folder twice, with the statistics of both runs."""

    def make():
        store = jsonl.Store(spark, storage.shared_dir(spark))
        return store, *(build.ingest_folder(store, _json_folder(spark, sf_dir), now=now) for now in (5, 6))

    return once(spark, sf_dir, "store", make)


_STORED_SQL = f"""e AS (SELECT *, source AS publisher, {CODE_SQL} AS rights_code FROM documents), j AS (SELECT *, {ALLOW_SQL} AS ok, sha256({CANON_SQL.format('text')}) AS k FROM e),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY source, doc_id) AS nth FROM j WHERE ok)"""


@query(f"WITH {_STORED_SQL} SELECT count(*) AS seen, count(*) FILTER (WHERE ok) AS inserted, count(*) FILTER (WHERE NOT ok) AS rejected, count(DISTINCT k) FILTER (WHERE ok) AS chunks_inserted, count(*) FILTER (WHERE ok) - count(DISTINCT k) FILTER (WHERE ok) AS chunks_deduped FROM j")
def store_ingest(spark, sf_dir):
    return ingest.totals(_stored(spark, sf_dir)[1]).select("seen", "inserted", "rejected", "chunks_inserted", "chunks_deduped")


@query(f"WITH {_STORED_SQL} SELECT publisher, count(*) AS seen, CAST(0 AS BIGINT) AS inserted, count(*) FILTER (WHERE ok) AS existing, CAST(0 AS BIGINT) AS chunks_inserted, count(*) FILTER (WHERE ok) AS chunks_deduped FROM j GROUP BY publisher")
def store_ingest_again(spark, sf_dir):
    return _stored(spark, sf_dir)[2].select("publisher", "seen", "inserted", "existing", "chunks_inserted", "chunks_deduped")


@query(f"WITH {_STORED_SQL} SELECT source || '_flagship_' || doc_id AS episode_id, publisher, rights_code, source || '_flagship_' || doc_id AS json_id, lang AS json_host FROM j WHERE ok")
def store_episodes(spark, sf_dir):
    rows = _stored(spark, sf_dir)[0].read("episodes")
    return rows.select("episode_id", "publisher", "rights_code", F.get_json_object("metadata_json", "$.episode_id").alias("json_id"), F.get_json_object("metadata_json", "$.host[0]").alias("json_host"))


@query(f"WITH {_STORED_SQL} SELECT DISTINCT k AS content_key FROM j WHERE ok")
def store_chunks(spark, sf_dir):
    return _stored(spark, sf_dir)[0].read("chunks").select("content_key")


@query(f"WITH {_STORED_SQL} SELECT source || '_flagship_' || doc_id AS episode_id, rights_code, NOT ok AS deprecated, unnest([5, 6])::BIGINT AS ingestion_date FROM j")
def store_governance(spark, sf_dir):
    return _stored(spark, sf_dir)[0].read("governance").select("episode_id", "rights_code", "deprecated", "ingestion_date")


@query(f"WITH {_STORED_SQL} SELECT 1 AS schema_version, count(*) FILTER (WHERE ok) AS episodes, count(DISTINCT k) FILTER (WHERE ok) AS chunks FROM j")
def store_version_and_counts(spark, sf_dir):
    store = _stored(spark, sf_dir)[0]
    count = lambda name: store.read(name).agg(F.count("*").alias(name))
    return store.read("version").crossJoin(F.broadcast(count("episodes"))).crossJoin(F.broadcast(count("chunks")))


@query(f"WITH {VECTORS_SQL} SELECT chunk_id, model_tag, round(list_sum(v), 4) AS total FROM vecs")
def store_embeddings(spark, sf_dir):
    def make():
        store = jsonl.Store(spark, storage.shared_dir(spark))
        store.add_embeddings(vector_table(spark, sf_dir).withColumn("created_at", F.lit(1).cast("long")))
        return store

    rows = once(spark, sf_dir, "vectors", make).read("embeddings")
    return rows.select("chunk_id", "model_tag", F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


def _packed(spark, sf_dir):
    def make():
        path = f"{storage.shared_dir(spark)}/corpus.pack"
        manifest = pack.build(_stored(spark, sf_dir)[0], path, level=3)
        return path, manifest, pack.Pack.open(spark, path).store(spark)

    return once(spark, sf_dir, "pack", make)


@query(ORACLE_SQL["store_episodes"])
def pack_episodes(spark, sf_dir):
    rows = _packed(spark, sf_dir)[2].read("episodes")
    return rows.select("episode_id", "publisher", "rights_code", F.get_json_object("metadata_json", "$.episode_id").alias("json_id"), F.get_json_object("metadata_json", "$.host[0]").alias("json_host"))


@query(ORACLE_SQL["store_chunks"])
def pack_chunks(spark, sf_dir):
    return _packed(spark, sf_dir)[2].read("chunks").select("content_key")


@query(f"WITH {_STORED_SQL} SELECT publisher, count(*) AS episode_count, CAST(count(*) FILTER (WHERE nth = 1) AS BIGINT) AS chunk_count FROM o GROUP BY publisher")
def pack_manifest(spark, sf_dir):
    rows = _packed(spark, sf_dir)[1]["publishers"]
    return spark.createDataFrame([(r["publisher"], r["episode_count"], r["chunk_count"]) for r in rows], "publisher string, episode_count long, chunk_count long")


def _landed(spark, sf_dir):
    """Documents as landed pages of two publishers, and a log that holds some ids and contents."""

    def make():
        d = plain_episodes(spark, sf_dir)
        pages = d.select(F.when(F.col("doc_id") % 2 == 0, "frog").otherwise("ncsc").alias("publisher_id"), F.col("doc_id").cast("string").alias("slug"), F.lit("https://example.com/").alias("url"), F.lit(None).cast("string").alias("html"), F.col("text").alias("body"), "rights_code", F.col("doc_id").alias("seq"), "lang")
        sources = {k: v for k, v in load_registry().items() if k in ("frog", "ncsc")}
        name = text.episode_id(F.col("publisher_id"), F.when(F.col("publisher_id") == "frog", sources["frog"].series_id).otherwise(sources["ncsc"].series_id), F.col("slug"))
        known = pages.where("lang = 'es'").select("publisher_id", name.alias("episode_id"), F.lit("cc_by").alias("rights_code"), F.lit(1).cast("long").alias("ingestion_date"), F.lit("").alias("content_hash"), F.lit(False).alias("deprecated"))
        seen = pages.where("lang = 'fr'").select(F.lit("elsewhere").alias("publisher_id"), F.lit("elsewhere_x").alias("episode_id"), F.lit("cc_by").alias("rights_code"), F.lit(1).cast("long").alias("ingestion_date"), hashing.content_hash(text.canonicalise("body")).alias("content_hash"), F.lit(False).alias("deprecated"))
        registry = registry_frame(spark, sources).drop("episodes")
        rows = pipeline.judged(pages, registry, known.unionByName(seen), list(sources), incremental=True)
        return storage.written(rows.select("publisher_id", "seq", "verdict"), "judged")

    return once(spark, sf_dir, "landed", make)


_LANDED_SQL = f"""r AS (SELECT doc_id, lang, CASE WHEN doc_id % 2 = 0 THEN 'frog' ELSE 'ncsc' END AS publisher_id, coalesce(nullif({CODE_SQL}, ''), '') AS rights_code, sha256({CANON_SQL.format('text')}) AS k FROM documents),
g AS (SELECT *, CASE WHEN lang = 'es' THEN 'skipped_incremental' WHEN NOT ({ALLOW_SQL}) THEN 'rejected_rights' END AS gate, k IN (SELECT k FROM r WHERE lang = 'fr') AS seen FROM r),
v AS (SELECT *, coalesce(gate, CASE WHEN seen OR row_number() OVER (PARTITION BY k, gate IS NULL ORDER BY publisher_id, doc_id) > 1 THEN 'skipped_dedup' ELSE 'admitted' END) AS verdict FROM g)"""


@query(f"WITH {_LANDED_SQL} SELECT doc_id AS seq, verdict FROM v")
def landing_verdicts(spark, sf_dir):
    return _landed(spark, sf_dir).select("seq", "verdict")


@query(f"WITH {_LANDED_SQL} SELECT publisher_id, count(*) FILTER (WHERE verdict <> 'skipped_incremental') AS seen, " + ", ".join(f"count(*) FILTER (WHERE verdict = '{v}') AS {v}" for v in pipeline.VERDICTS) + " FROM v GROUP BY publisher_id")
def landing_stats(spark, sf_dir):
    return pipeline.stats(_landed(spark, sf_dir))


_TWICE_SQL = f"""r AS (SELECT doc_id, {CODE_SQL} AS rights_code, sha256({CANON_SQL.format('text')}) AS k FROM documents), o AS (SELECT * FROM r WHERE {ALLOW_SQL}),
w AS (SELECT k, min(doc_id) AS doc_id FROM o GROUP BY k)"""


def _landing(spark, sf_dir):
    """A landing of every document twice under its slug, and of one page a document that has no text;
    these fail, are tried once more and then reported."""

    def make():
        d = plain_episodes(spark, sf_dir)
        empty = F.lit(None).cast("string")
        page = lambda slug, body, seq: d.select(F.lit("frog").alias("publisher_id"), slug.alias("slug"), F.lit("https://example.com/").alias("url"), empty.alias("html"), body.alias("body"), F.col("rights_code"), seq.cast("long").alias("seq"))
        name, once_more = F.col("doc_id").cast("string"), F.lit(1 << 40)
        pages = page(name, F.col("text"), F.col("doc_id")).unionByName(page(name, F.col("text"), once_more + F.col("doc_id"))).unionByName(page(F.concat(F.lit("late-"), name), empty, 2 * once_more + F.col("doc_id")))
        run = pipeline.Pipeline(spark, {"frog": load_registry()["frog"]}, storage.shared_dir(spark))
        found = [run.run(pages, now=5).collect(), run.retry(now=6).collect(), run.retry(now=7).collect()]
        return run, found

    return once(spark, sf_dir, "landing", make)


@query(f"WITH {_TWICE_SQL} SELECT 3 * (SELECT count(*) FROM r) AS seen, (SELECT count(*) FROM w) AS admitted, 2 * (SELECT count(*) FROM o) - (SELECT count(*) FROM w) AS skipped_dedup, 3 * ((SELECT count(*) FROM r) - (SELECT count(*) FROM o)) AS rejected_rights, (SELECT count(*) FROM o) AS failed")
def landing_repeated_slugs(spark, sf_dir):
    rows = _landing(spark, sf_dir)[1][0]
    return spark.createDataFrame(rows).select("seen", "admitted", "skipped_dedup", "rejected_rights", "failed")


@query(f"WITH {_TWICE_SQL} SELECT 'frog_frogcast_' || doc_id AS episode_id, k AS markdown_sha FROM w")
def landing_normalised(spark, sf_dir):
    return _landing(spark, sf_dir)[0].kept.read("normalised").select("episode_id", F.sha2("markdown", 256).alias("markdown_sha"))


@query(f"WITH {_TWICE_SQL} SELECT 'frog_frogcast_' || doc_id AS episode_id, CAST(doc_id AS VARCHAR) AS slug, CASE WHEN text = '' THEN 'bin' ELSE 'txt' END AS kind, sha256(text) AS content_sha FROM w JOIN documents USING (doc_id)")
def landing_raw(spark, sf_dir):
    return _landing(spark, sf_dir)[0].kept.read("raw").select("episode_id", "slug", "kind", F.sha2("content", 256).alias("content_sha"))


@query(f"WITH {_TWICE_SQL} SELECT 'frog_frogcast_late-' || doc_id AS episode_id, 'no text' AS error, CAST(unnest([1, 2]) AS INT) AS attempt FROM o")
def landing_dead_letters(spark, sf_dir):
    return _landing(spark, sf_dir)[0].kept.read("dead_letters").select("episode_id", "error", "attempt")


@query(f"WITH {_TWICE_SQL} SELECT 'frog_frogcast_late-' || doc_id AS episode_id, CAST(2 AS INT) AS attempt, CAST(6 AS BIGINT) AS failed_at FROM o")
def landing_failures(spark, sf_dir):
    return _landing(spark, sf_dir)[0].failures().select("episode_id", "attempt", "failed_at")


@query(f"WITH s AS (SELECT *, row_number() OVER (PARTITION BY sha256({CANON_SQL.format('text')}) ORDER BY episode_id) AS nth FROM (SELECT source || '_flagship_' || doc_id AS episode_id, text, {CODE_SQL} AS rights_code FROM documents) WHERE {ALLOW_SQL}) SELECT episode_id, rights_code FROM s WHERE nth = 1")
def stream_admitted(spark, sf_dir):
    def make():
        root = storage.shared_dir(spark)
        rows = plain_episodes(spark, sf_dir).select("episode_id", "text", "rights_code")
        rows.write.parquet(f"{root}/arrived")
        for _ in range(2):  # the second run finds nothing new
            incremental.stream_ingest(spark.readStream.schema(rows.schema).parquet(f"{root}/arrived"), f"{root}/store", f"{root}/state").awaitTermination()
        return incremental.stream_store(spark, f"{root}/store")

    return once(spark, sf_dir, "stream", make).read("admitted").select("episode_id", "rights_code")


#: The fourth of the documents that a source gets, and the order in which they arrive.
_FOURTH, _ARRIVALS = "ascii(right(source, 1)) % 4", (("a", 0), ("b", 2), ("a", 1), ("b", 3))


def _fourths(spark, sf_dir):
    e = plain_episodes(spark, sf_dir).withColumnRenamed("publisher", "source")
    return e.select("episode_id", "text", "rights_code", F.expr(_FOURTH).alias("part"))


@query(f"""WITH e AS (SELECT source || '_flagship_' || doc_id AS episode_id, text, {CODE_SQL} AS rights_code, CASE {_FOURTH} WHEN 0 THEN 0 WHEN 2 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS arrival FROM documents),
s AS (SELECT *, row_number() OVER (PARTITION BY sha256({CANON_SQL.format('text')}) ORDER BY arrival, episode_id) AS nth FROM e WHERE {ALLOW_SQL})
SELECT episode_id, rights_code, CAST(arrival // 2 AS BIGINT) AS batch_id FROM s WHERE nth = 1""")
def stream_two_sources(spark, sf_dir):
    """Two streaming queries with checkpoints of their own feed one store in turn, each restarted; then
    every batch comes once more, as after a crash between the commit and the checkpoint."""

    def make():
        root = storage.shared_dir(spark)
        e = _fourths(spark, sf_dir)
        part = lambda k: e.where(F.col("part") == k).drop("part")
        for name, k in _ARRIVALS:
            part(k).write.mode("append").parquet(f"{root}/{name}")
            incremental.stream_ingest(spark.readStream.schema(part(k).schema).parquet(f"{root}/{name}"), f"{root}/store", f"{root}/state-{name}").awaitTermination()
        store = incremental.stream_store(spark, f"{root}/store")
        for k, (name, fourth) in enumerate(_ARRIVALS):
            if incremental.append_batch(store, part(fourth), incremental.query_id(spark, f"{root}/state-{name}"), k // 2):
                raise ValueError("a batch went in twice")
        return store

    return once(spark, sf_dir, "streams", make).read("admitted").select("episode_id", "rights_code", "batch_id")


# -- governance log ------------------------------------------------------------------------------

def _log(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    log = e.select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("publisher_id"),
        F.concat("event_type", F.when(F.col("event_id") % 5 == 0, "_late").otherwise(""), F.lit("_s_"), F.col("user_id").cast("string")).alias("episode_id"),
        F.when(F.col("event_id") % 4 == 0, "unknown").when(F.col("event_id") % 4 == 1, "paywalled").otherwise("CC_BY").alias("rights_code"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("ingestion_date"), F.md5(F.col("user_id").cast("string")).alias("content_hash"), (F.col("event_id") % 4 < 2).alias("deprecated"),
    )
    return governance.attributed(log, _PUBLISHERS)


@query(f"WITH {LOG_SQL} SELECT publisher, count(*) AS n FROM att GROUP BY 1")
def publisher_prefix_attribution(spark, sf_dir):
    return _log(spark, sf_dir).groupBy("publisher").agg(F.count("*").alias("n"))


@query(f"WITH {LOG_SQL.split(' reg AS')[0]} reg AS (SELECT DISTINCT event_type || CASE WHEN event_id % 5 = 0 THEN '_late' ELSE '' END || CASE user_id % 3 WHEN 0 THEN '_s_' || user_id ELSE '_s' END AS pid FROM events) SELECT event_id, coalesce((SELECT pid FROM reg WHERE pid = publisher_id), (SELECT max_by(pid, length(pid)) FROM reg WHERE starts_with(log.episode_id, pid || '_'))) AS publisher FROM log".replace("FROM log", "FROM (SELECT *, episode_id AS e FROM log) log"))
def attribution_large_registry(spark, sf_dir):
    """A registry as large as the users of the log, met by equality of prefixes."""
    e = table(spark, sf_dir, "events")
    name = F.concat("event_type", F.when(F.col("event_id") % 5 == 0, "_late").otherwise(""), F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("_s_"), F.col("user_id").cast("string"))).otherwise("_s"))
    return governance.attributed(_log(spark, sf_dir), e.select(name.alias("publisher_id"))).select("event_id", "publisher")


_KNOWN_SQL = "SELECT DISTINCT publisher, episode_id FROM att WHERE publisher IS NOT NULL AND (NOT deprecated OR lower(rights_code) NOT IN {})"
_ALLOWED = "('ogl_v3','cc_by','cc_by_sa','cc_by_nc','cc_by_nc_nd','free_access_copyrighted','public_domain')"


@query(f"WITH {LOG_SQL} " + _KNOWN_SQL.format(_ALLOWED))
def governance_replay_known(spark, sf_dir):
    return governance.known_ids(_log(spark, sf_dir))


@query(f"WITH {LOG_SQL} SELECT DISTINCT publisher, episode_id FROM att WHERE publisher IS NOT NULL AND deprecated AND lower(rights_code) NOT IN {_ALLOWED}")
def governance_replay_rejected(spark, sf_dir):
    return governance.rejected_ids(_log(spark, sf_dir))


@query(f"WITH {LOG_SQL} SELECT DISTINCT content_hash FROM log WHERE NOT deprecated")
def governance_replay_hashes(spark, sf_dir):
    return governance.seen_hashes(_log(spark, sf_dir))


def _to_fetch(incremental: bool):
    def rows(spark, sf_dir):
        log = _log(spark, sf_dir)
        skip = governance.skip_set(log, incremental, allow=("cc_by", "paywalled"))
        return log.where("publisher is not null").join(skip, ["publisher", "episode_id"], "left_anti").groupBy("publisher").agg(F.countDistinct("episode_id").alias("to_fetch"))

    return rows


_FETCH_SQL = "SELECT publisher, count(DISTINCT episode_id) AS to_fetch FROM att WHERE publisher IS NOT NULL AND NOT EXISTS (SELECT 1 FROM att k WHERE k.publisher = att.publisher AND k.episode_id = att.episode_id AND {}) GROUP BY publisher"


@query(f"WITH {LOG_SQL} " + _FETCH_SQL.format("k.deprecated AND lower(k.rights_code) NOT IN ('cc_by', 'paywalled')"))
def skip_set_default(spark, sf_dir):
    return _to_fetch(False)(spark, sf_dir)


@query(f"WITH {LOG_SQL} " + _FETCH_SQL.format("(NOT k.deprecated OR lower(k.rights_code) NOT IN ('cc_by', 'paywalled'))"))
def skip_set_incremental(spark, sf_dir):
    return _to_fetch(True)(spark, sf_dir)


@query(f"WITH {LOG_SQL} SELECT DISTINCT publisher, episode_id FROM att WHERE publisher IS NOT NULL AND deprecated AND lower(rights_code) NOT IN ('cc_by', 'unknown')")
def readmit_after_allowlist(spark, sf_dir):
    return governance.skip_set(_log(spark, sf_dir), incremental=False, allow=("cc_by", "unknown"))


@query(f"WITH {LOG_SQL} SELECT count(*) AS n_deprecated FROM log WHERE deprecated")
def governance_deprecated_count(spark, sf_dir):
    return _log(spark, sf_dir).where("deprecated").agg(F.count("*").alias("n_deprecated"))


@query(f"WITH {LOG_SQL} SELECT episode_id, max_by(deprecated, event_id) AS deprecated, count(*) AS events FROM log GROUP BY 1")
def governance_current_status(spark, sf_dir):
    return governance.current_status(_log(spark, sf_dir), "event_id")


@query("WITH s AS (SELECT user_id, 1 AS part, min(event_id) AS pos, event_type AS slug FROM events WHERE event_id % 2 = 0 GROUP BY user_id, event_type UNION ALL SELECT user_id, 2, min(event_id), event_type FROM events WHERE event_id % 2 = 1 GROUP BY user_id, event_type), f AS (SELECT user_id, slug, min(part * 1000000000000 + pos) AS k FROM s GROUP BY user_id, slug) SELECT user_id, list(slug ORDER BY k) AS slugs FROM f GROUP BY user_id")
def seed_discovery_merge(spark, sf_dir):
    part = lambda name, rest: F.transform(F.array_sort(F.collect_list(F.when(F.col("event_id") % 2 == rest, F.struct("event_id", "event_type")))), lambda x: x["event_type"]).alias(name)
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(part("seeds", 0), part("found", 1))
    return e.select("user_id", ingest.merge_slugs(F.col("seeds"), F.col("found")).alias("slugs"))


def _log_state(spark, sf_dir):
    """The state of the log, taken in by eight batches, the last of which comes twice."""

    def make():
        state = LogState(spark, storage.shared_dir(spark), _PUBLISHERS)
        log = storage.written(_log(spark, sf_dir).drop("publisher"), "log")
        for k in (*range(8), 7):
            state.add(log.where(F.pmod(F.xxhash64("event_id"), F.lit(8)) == k), "events", k)
        return state

    return once(spark, sf_dir, "log state", make)


@query(ORACLE_SQL["governance_replay_known"])
def log_state_known(spark, sf_dir):
    return _log_state(spark, sf_dir).known_ids()


@query(ORACLE_SQL["governance_replay_rejected"])
def log_state_rejected(spark, sf_dir):
    return _log_state(spark, sf_dir).rejected_ids()


@query(ORACLE_SQL["governance_replay_hashes"])
def log_state_hashes(spark, sf_dir):
    return _log_state(spark, sf_dir).seen_hashes()


@query(ORACLE_SQL["readmit_after_allowlist"])
def log_state_readmit(spark, sf_dir):
    return _log_state(spark, sf_dir).skip_set(incremental=False, allow=("cc_by", "unknown"))


@query(f"WITH {LOG_SQL} SELECT publisher, episode_id, count(*) AS events FROM att GROUP BY ALL")
def log_state_events(spark, sf_dir):
    return _log_state(spark, sf_dir).episodes().select("publisher", "episode_id", "events")


# -- chunking ------------------------------------------------------------------------------------

_PLAIN_SQL = f"""WITH t AS (SELECT doc_id, source, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS s, list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '') AS w FROM documents),
u AS (SELECT *, {TOKENS_SQL.format('s')} AS n_tokens, len(w) AS n, CASE WHEN len(w) <= 700 THEN 1 ELSE CAST(ceil((len(w) - 700) / 580.0) AS BIGINT) + 1 END AS nwin FROM t),
c AS (SELECT doc_id, source, CASE WHEN s = '' THEN [] WHEN n_tokens <= 700 THEN [s] ELSE list_concat(list_transform(range(nwin), lambda k: array_to_string(w[k * 580 + 1:k * 580 + 700], ' ')), CASE WHEN n - (nwin - 1) * 580 > 120 THEN [array_to_string(w[n - 119:n], ' ')] ELSE [] END) END AS chunks FROM u)"""


def _plain(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source", chunking.plain_chunks(F.col("text")).alias("chunks"))


@query(_PLAIN_SQL + ", x AS (SELECT doc_id, unnest(chunks) AS chunk_text, generate_subscripts(chunks, 1) - 1 AS k FROM c) SELECT doc_id, CAST(k AS INT) AS chunk_index, sha256(chunk_text) AS chunk_sha FROM x")
def chunk_documents(spark, sf_dir):
    rows = _plain(spark, sf_dir).select("doc_id", F.posexplode("chunks").alias("chunk_index", "chunk_text"))
    return rows.select("doc_id", "chunk_index", F.sha2("chunk_text", 256).alias("chunk_sha"))


@query(_PLAIN_SQL + " SELECT source, count(*) AS docs, CAST(sum(len(chunks)) AS BIGINT) AS n_chunks FROM c GROUP BY source")
def chunk_stats_by_source(spark, sf_dir):
    return _plain(spark, sf_dir).groupBy("source").agg(F.count("*").alias("docs"), F.sum(F.size("chunks")).alias("n_chunks"))


@query(_PLAIN_SQL + " SELECT c.doc_id, sha256(chunks[len(chunks)]) AS seed_sha FROM c JOIN u USING (doc_id) WHERE n_tokens > 700 AND n - (nwin - 1) * 580 > 120")
def chunk_seed_only(spark, sf_dir):
    words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    d = table(spark, sf_dir, "documents").select("doc_id", chunking.plain_chunks(F.col("text")).alias("chunks"), words.alias("n"), text.count_tokens("text").alias("n_tokens"))
    left = F.col("n") - F.greatest(F.lit(0), F.ceil((F.col("n") - 700) / F.lit(580))) * 580
    return d.where((F.col("n_tokens") > 700) & (left > 120)).select("doc_id", F.sha2(F.element_at("chunks", -1), 256).alias("seed_sha"))


@query(_PLAIN_SQL + ", x AS (SELECT doc_id, unnest(chunks) AS chunk_text, generate_subscripts(chunks, 1) - 1 AS k FROM c) SELECT doc_id, CAST(k AS INT) AS chunk_index, sha256(chunk_text) AS chunk_sha FROM x")
def chunk_documents_by_turns(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.inline(chunking.chunks_udf("text", F.lit(700), F.lit(120))))
    return rows.select("doc_id", "chunk_index", F.sha2("chunk_text", 256).alias("chunk_sha"))


def _transcripts(spark, sf_dir):
    line = F.concat(F.upper("role"), F.lit(": "), F.regexp_replace("text", r"\s+", " "))
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))).alias("turns"))
    return turns.select("conv_id", F.array_join(F.transform("turns", lambda t: t["line"]), "\n").alias("text"))


@query(r"SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS turn, upper(role) AS speaker, trim(regexp_replace(text, '\s+', ' ', 'g')) AS body FROM conversations WHERE trim(regexp_replace(text, '\s+', ' ', 'g')) <> ''")
def speaker_turns(spark, sf_dir):
    rows = _transcripts(spark, sf_dir).select("conv_id", F.posexplode(chunking.turns_udf("text")).alias("turn", "x"))
    return rows.select("conv_id", "turn", "x.speaker", "x.body")


@query()
def speaker_turn_chunks(spark, sf_dir):
    return _transcripts(spark, sf_dir).select("conv_id", F.inline(chunking.chunks_udf("text", F.lit(100), F.lit(20))))


# -- search --------------------------------------------------------------------------------------

_PHRASE, _TERM = ["of", "the"], "with"
_TAGS = search.TagFilter(industry=("en", "de"), evidence_type=("quality",))
_TAG_SQL = "list_has_any(industry_tags, ['en', 'de']) AND list_has_any(evidence_type, ['quality'])"
_score = lambda c: F.round(c, 6)


@query(f"WITH {EPISODES_SQL} SELECT episode_id FROM episodes WHERE {_TAG_SQL}")
def tag_filter_or_and(spark, sf_dir):
    return search.matching_episodes(episodes(spark, sf_dir), _TAGS)


@query("SELECT doc_id, [lang] AS industry_tags, [source] AS function_tags, ['x'] AS business_model_tags, CAST([] AS VARCHAR[]) AS geography_tags, ['t'] AS evidence_type FROM documents")
def tag_family_projection(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").alias("episode_id"), F.array("lang").alias("industry_tags"), F.array("source").alias("function_tags"), F.array(F.lit("x")).alias("business_model_tags"), F.lit(None).cast("array<string>").alias("country_region"), F.lit("t").alias("source_type"))
    return search.tag_families(d).withColumnRenamed("episode_id", "doc_id")


@query(f"WITH {EPISODES_SQL} SELECT episode_id || '#0000' AS chunk_id, created_at FROM episodes WHERE {_TAG_SQL} ORDER BY created_at DESC, chunk_id LIMIT 500")
def tag_only_recency(spark, sf_dir):
    chunks = _chunk_rows(spark, sf_dir).select("chunk_id", "episode_id", "created_at")
    top = search.tag_lane(chunks, search.matching_episodes(episodes(spark, sf_dir), _TAGS))
    return top.join(chunks, "chunk_id").select("chunk_id", "created_at")


@query(f"WITH {CHUNKS_SQL}, {bm25_sql(_PHRASE)} SELECT chunk_id, round(bm25, 6) AS bm25 FROM lane")
def fts_phrase_bm25(spark, sf_dir):
    return Index(chunk_index(spark, sf_dir)).bm25(_PHRASE).select("chunk_id", _score("bm25").alias("bm25"))


@query(f"WITH {CHUNKS_SQL}, {bm25_sql([_TERM])} SELECT chunk_id, round(bm25, 6) AS bm25 FROM lane")
def fts_single_term(spark, sf_dir):
    return Index(chunk_index(spark, sf_dir)).bm25([_TERM]).select("chunk_id", _score("bm25").alias("bm25"))


@query(ORACLE_SQL["fts_phrase_bm25"])
def fts_phrase_by_scan(spark, sf_dir):
    """The same rows without an index."""
    return search.bm25_phrase(search.indexed(_chunk_rows(spark, sf_dir)), _PHRASE).select("chunk_id", _score("bm25").alias("bm25"))


@query(f"WITH {CHUNKS_SQL}, t AS (SELECT chunk_id, len(tokens) AS dl, unnest(tokens) AS term FROM chunks) SELECT chunk_id, term, CAST(dl AS INT) AS dl, count(*) AS f FROM t WHERE term IN ('of', 'the', 'with') GROUP BY ALL")
def index_postings(spark, sf_dir):
    rows = Index(chunk_index(spark, sf_dir)).postings.where(F.col("term").isin("of", "the", "with"))
    return rows.select("chunk_id", "term", "dl", F.size("positions").cast("long").alias("f"))


@query(f"WITH {CHUNKS_SQL} SELECT count(*) AS docs, CAST(sum(len(tokens)) AS BIGINT) AS tokens FROM chunks")
def index_statistics(spark, sf_dir):
    return Index(chunk_index(spark, sf_dir)).stats.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


@query("SELECT '?! --' AS query, 0 AS hits UNION ALL SELECT 'with', CAST(least(500, (SELECT count(*) FROM documents WHERE regexp_matches(lower(strip_accents(text)), '(^|[^\\p{L}\\p{N}])with($|[^\\p{L}\\p{N}])'))) AS INT)".replace("\\\\", "\\"))
def fts_punctuation_empty(spark, sf_dir):
    chunks, index = chunk_table(spark, sf_dir), Index(chunk_index(spark, sf_dir))
    hits = lambda q: search.fts_lane(chunks, search.query_tokens(spark, q), None, index=index).agg(F.count("*").cast("int").alias("hits")).select(F.lit(q).alias("query"), "hits")
    return hits("?! --").unionByName(hits("with"))


@query(f"WITH {EPISODES_SQL}, {CHUNKS_SQL}, {bm25_sql([_TERM])}, top AS (SELECT * FROM lane ORDER BY bm25 DESC, chunk_id LIMIT 500) SELECT chunk_id, round(bm25, 6) AS bm25 FROM top WHERE episode_id IN (SELECT episode_id FROM episodes WHERE {_TAG_SQL})")
def fts_capped_then_tagged(spark, sf_dir):
    lane = search.fts_lane(chunk_table(spark, sf_dir), [_TERM], search.matching_episodes(episodes(spark, sf_dir), _TAGS), index=Index(chunk_index(spark, sf_dir)))
    return lane.select("chunk_id", _score("bm25").alias("bm25"))


_COS = "list_cosine_similarity(v, qv)"


def _vectors(spark, sf_dir, matching=None, model="m1", cap=5000):
    return search.semantic_lane(_chunk_rows(spark, sf_dir).select("chunk_id", "episode_id"), vector_table(spark, sf_dir), first_vector(spark, sf_dir), model, matching, cap)


@query(f"WITH {VECTORS_SQL}, lane AS (SELECT * FROM vecs, q WHERE model_tag = 'm1' ORDER BY chunk_id LIMIT 5000) SELECT chunk_id, round({_COS}, 6) AS cosine FROM lane")
def semantic_topk(spark, sf_dir):
    return _vectors(spark, sf_dir).select("chunk_id", _score("cosine").alias("cosine"))


@query(f"WITH {EPISODES_SQL}, {VECTORS_SQL}, lane AS (SELECT * FROM vecs, q WHERE model_tag = 'm1' AND episode_id IN (SELECT episode_id FROM episodes WHERE {_TAG_SQL})) SELECT chunk_id, round({_COS}, 6) AS cosine FROM lane")
def semantic_with_tags(spark, sf_dir):
    return _vectors(spark, sf_dir, search.matching_episodes(episodes(spark, sf_dir), _TAGS), cap=None).select("chunk_id", _score("cosine").alias("cosine"))


def vector_index(spark, sf_dir):
    return once(spark, sf_dir, "vector index", lambda: VectorIndex(vector_table(spark, sf_dir), 64))


@query(f"WITH {VECTORS_SQL} SELECT chunk_id, round({_COS}, 6) AS cosine FROM vecs, q WHERE model_tag = 'm1' ORDER BY {_COS} DESC, chunk_id LIMIT 50")
def semantic_exact_topk(spark, sf_dir):
    """The nearest of all vectors, by centres and bounds instead of a scan."""
    return vector_index(spark, sf_dir).top(first_vector(spark, sf_dir), "m1", 50).select("chunk_id", _score("cosine").alias("cosine"))


@query(f"WITH {VECTORS_SQL} SELECT chunk_id, round(1.5 * {_COS}, 6) AS rank_score FROM vecs, q WHERE model_tag = 'm0' ORDER BY {_COS} DESC, chunk_id LIMIT 10")
def search_by_vector_alone(spark, sf_dir):
    q = search.SearchQuery(query_embedding=tuple(first_vector(spark, sf_dir)), semantic_model_tag="m0", scope="include_embeddings", lane_caps=False)
    hits = search.search(_chunk_rows(spark, sf_dir), episodes(spark, sf_dir), q, vector_table(spark, sf_dir), vectors=vector_index(spark, sf_dir))
    return hits.select("chunk_id", _score("rank_score").alias("rank_score"))


@query("SELECT vec_id FROM embeddings WHERE len(CASE WHEN vec_id % 3 = 0 THEN embedding[1:63] ELSE embedding END) = 64 AND label % 2 = 1 AND vec_id IN (SELECT doc_id FROM documents)")
def semantic_dim_guard(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").join(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id")), "vec_id", "left_semi")
    vecs = e.select(F.col("vec_id").cast("string").alias("chunk_id"), F.concat(F.lit("m"), (F.col("label") % 2).cast("string")).alias("model_tag"), F.when(F.col("vec_id") % 3 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding")).alias("embedding"))
    chunks = e.select(F.col("vec_id").cast("string").alias("chunk_id"), F.col("vec_id").cast("string").alias("episode_id"))
    return search.semantic_lane(chunks, vecs, first_vector(spark, sf_dir), "m1", None, cap=None).select(F.col("chunk_id").cast("long").alias("vec_id"))


@query("SELECT vec_id, true AS same FROM embeddings")
def vector_codec(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", (vectors.decode_blobs(vectors.encode_blobs("embedding")) == F.col("embedding")).alias("same"))


def _hybrid_sql(w=(2.0, 1.5, 0.75), limit=10, caps=(" ORDER BY bm25 DESC, chunk_id LIMIT 500", " ORDER BY chunk_id LIMIT 5000")):
    return f"""WITH {EPISODES_SQL}, {CHUNKS_SQL}, {VECTORS_SQL}, m AS (SELECT episode_id FROM episodes WHERE {_TAG_SQL}), {bm25_sql([_TERM])},
fts AS (SELECT * FROM (SELECT * FROM lane{caps[0]}) WHERE episode_id IN (SELECT episode_id FROM m)),
sem AS (SELECT chunk_id, {_COS} AS cosine FROM (SELECT * FROM vecs, q WHERE model_tag = 'm1' AND episode_id IN (SELECT episode_id FROM m){caps[1]})),
u AS (SELECT chunk_id, {w[0]} * bm25 AS score, bm25, NULL::DOUBLE AS cosine FROM fts UNION ALL SELECT chunk_id, {w[1]} * cosine, NULL, cosine FROM sem),
g AS (SELECT chunk_id, sum(score) + {w[2]} AS rank_score, max(bm25) AS bm25_score, max(cosine) AS semantic_score FROM u GROUP BY chunk_id)
SELECT chunk_id, round(rank_score, 6) AS rank_score, round(bm25_score, 6) AS bm25_score, round(semantic_score, 6) AS semantic_score, true AS tag_match FROM g JOIN chunks USING (chunk_id) ORDER BY g.rank_score DESC, created_at DESC, chunk_id LIMIT {limit}"""


def _hybrid(spark, sf_dir, **more):
    q = search.SearchQuery("with", _TAGS, tuple(first_vector(spark, sf_dir)), "m1", scope="include_embeddings", **more)
    hits = search.search(chunk_table(spark, sf_dir), episodes(spark, sf_dir), q, vector_table(spark, sf_dir), Index(chunk_index(spark, sf_dir)))
    return hits.select("chunk_id", *(_score(c).alias(c) for c in ("rank_score", "bm25_score", "semantic_score")), "tag_match")


@query(_hybrid_sql())
def hybrid_search(spark, sf_dir):
    return _hybrid(spark, sf_dir)


@query(_hybrid_sql((0.5, 3.0, 0.25), 25))
def hybrid_weights_override(spark, sf_dir):
    return _hybrid(spark, sf_dir, weights=search.RankWeights(0.5, 3.0, 0.25), limit=25)


@query(f"WITH {CHUNKS_SQL}, {bm25_sql([_TERM])} SELECT 'no such tag' AS tag, CAST(0 AS BIGINT) AS hits UNION ALL SELECT 'any', least(10, count(*)) FROM lane")
def search_unmatched_tags_empty(spark, sf_dir):
    hits = lambda name, tags: search.search(chunk_table(spark, sf_dir), episodes(spark, sf_dir), search.SearchQuery("with", tags), index=Index(chunk_index(spark, sf_dir))).agg(F.count("*").alias("hits")).select(F.lit(name).alias("tag"), "hits")
    return hits("no such tag", search.TagFilter(industry=("no such tag",))).unionByName(hits("any", search.TagFilter()))


@query(_hybrid_sql(limit=3, caps=("", "")))
def search_limit(spark, sf_dir):
    """The best of all hits of both lanes."""
    return _hybrid(spark, sf_dir, limit=3, lane_caps=False)


@query(_hybrid_sql())
def search_limit_zero(spark, sf_dir):
    """A limit of 0 is the default."""
    return _hybrid(spark, sf_dir, limit=0)


@query(f"WITH {EPISODES_SQL} SELECT episode_id FROM episodes WHERE list_has_any(industry_tags, ['en', 'de'])")
def tag_flags(spark, sf_dir):
    """Families as flags of the command line: blanks and empty parts go, an empty flag asks nothing."""
    flags = {"industry": " en,, de ,", "function": "", "evidence_type": " , "}
    return search.matching_episodes(episodes(spark, sf_dir), search.TagFilter(**{f: tuple(text.parse_csv(v)) for f, v in flags.items()}))


@query(_hybrid_sql((0.25, 4.0, 1.5)))
def search_by_pack_weights(spark, sf_dir):
    """The weights of a pack's header, taken for its search."""
    def make():
        store = jsonl.Store(spark, storage.shared_dir(spark))
        store.append("governance", _log(spark, sf_dir).select("publisher_id", "episode_id", "rights_code", "ingestion_date", "content_hash", "deprecated"))
        path = f"{storage.shared_dir(spark)}/weights.pack"
        pack.build(store, path, level=1, weights=search.RankWeights(0.25, 4.0, 1.5))
        return pack.Pack.open(spark, path)

    weights = once(spark, sf_dir, "weights", make).with_weights(search.SearchQuery()).weights
    return _hybrid(spark, sf_dir, weights=weights)


@query("WITH h AS (" + _hybrid_sql() + ") SELECT chunk_id, tag_match, rank_score FROM h")
def hits_as_json(spark, sf_dir):
    q = search.SearchQuery("with", _TAGS, tuple(first_vector(spark, sf_dir)), "m1", scope="include_embeddings")
    hits = search.emit_json(search.search(chunk_table(spark, sf_dir), episodes(spark, sf_dir), q, vector_table(spark, sf_dir), Index(chunk_index(spark, sf_dir))))
    field = lambda name, kind: F.get_json_object("json", f"$.{name}").cast(kind)
    return hits.select(field("chunkId", "string").alias("chunk_id"), field("tagMatch", "boolean").alias("tag_match"), F.round(field("rankScore", "double"), 6).alias("rank_score"))


@query(f"WITH {EPISODES_SQL}, {CHUNKS_SQL}, {VECTORS_SQL}, m AS (SELECT episode_id FROM episodes WHERE {_TAG_SQL}), {bm25_sql([_TERM])}, u AS (SELECT chunk_id, 2.0 * bm25 AS s FROM lane WHERE episode_id IN (SELECT episode_id FROM m) UNION ALL SELECT chunk_id, 1.5 * {_COS} FROM vecs, q WHERE model_tag = 'm1' AND episode_id IN (SELECT episode_id FROM m)) SELECT chunk_id, round(sum(s) + 0.75, 6) AS rank_score FROM u GROUP BY chunk_id")
def search_without_caps(spark, sf_dir):
    q = search.SearchQuery("with", _TAGS, tuple(first_vector(spark, sf_dir)), "m1", scope="include_embeddings", limit=None, lane_caps=False)
    hits = search.search(chunk_table(spark, sf_dir), episodes(spark, sf_dir), q, vector_table(spark, sf_dir), Index(chunk_index(spark, sf_dir)))
    return hits.select("chunk_id", _score("rank_score").alias("rank_score"))


# -- pages ---------------------------------------------------------------------------------------


@query(r"SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS title FROM pages")
def page_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.page_title("html").alias("title"))


@query("SELECT page_id, left(regexp_extract(html || '<meta name=\"date\" content=\"2024-05-06T10:00\">', '(?i)name=[\"'']date[\"'']\\s+content=[\"'']([^\"'']+)[\"'']', 1), 10) AS published FROM pages".replace("\\\\", "\\"))
def page_date(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.publication_date(F.concat("html", F.lit('<meta name="date" content="2024-05-06T10:00">'))).alias("published"))


@query("SELECT page_id, list_distinct_in_order AS links FROM (SELECT page_id, list(link ORDER BY k) AS list_distinct_in_order FROM (SELECT page_id, link, min(k) AS k FROM (SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) AS k FROM (SELECT page_id, regexp_extract_all(html, 'href=\"([^\"]+)\"', 1) AS l FROM pages)) GROUP BY page_id, link) GROUP BY page_id)")
def page_links(spark, sf_dir):
    found = F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)))
    return table(spark, sf_dir, "pages").select("page_id", found.alias("links")).where(F.size("links") > 0)


@query("SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, len(list_filter(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1), lambda x: starts_with(x, '/'))) AS own_links FROM pages")
def page_same_origin_filter(spark, sf_dir):
    own = F.size(F.filter(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)), lambda x: F.startswith(x, F.lit("/"))))
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("host"), own.cast("long").alias("own_links"))


@query("SELECT page_id, regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) AS h1 FROM pages")
def page_h1(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "(?is)<h1[^>]*>(.*?)</h1>", 1).alias("h1"))


@query()
def page_markdown(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.page_markdown("html").alias("markdown"))


@query()
def page_by_source_rule(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", html.read_page(F.lit("frog"), "url", "html").alias("x"))
    return p.select("page_id", "x.markdown", "x.guests", "x.assets", "x.error")


@query("SELECT page_id, ['ep-' || page_id] AS slugs FROM pages")
def page_discovery(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    sitemap = F.concat(F.lit("<loc>https://mastersofscale.com/episode/ep-"), F.col("page_id").cast("string"), F.lit("/</loc>"))
    return p.select("page_id", html.slugs_native(sitemap, "masters_of_scale").alias("slugs"))


@query("SELECT page_id, list_transform(range(1, 26), lambda k: 'ep-' || (page_id + k)) AS slugs FROM pages")
def discovery_cap(spark, sf_dir):
    links = F.transform(F.sequence(F.lit(1), F.lit(40)), lambda k: F.concat(F.lit("<loc>https://mastersofscale.com/episode/ep-"), (F.col("page_id") + k).cast("string"), F.lit("/</loc>")))
    return table(spark, sf_dir, "pages").select("page_id", html.slugs_native(F.array_join(links, ""), "masters_of_scale").alias("slugs"))


@query("SELECT page_id, list_transform(range(1, 21), lambda k: 'https://www.bcg.com/f' || page_id || '/' || k || '.pdf') AS assets, 'https://www.bcg.com/f' || page_id || '/1.pdf' AS transcript FROM pages")
def page_assets_cap(spark, sf_dir):
    links = F.transform(F.sequence(F.lit(1), F.lit(30)), lambda k: F.concat(F.lit("<a href='/f"), F.col("page_id").cast("string"), F.lit("/"), k.cast("string"), F.lit(".pdf'>Transcript</a>")))
    read = html.read_page(F.lit("bcg"), F.lit("https://www.bcg.com/a"), F.concat(F.array_join(links, ""), "html"))
    return table(spark, sf_dir, "pages").select("page_id", read.alias("x")).select("page_id", "x.assets", "x.transcript")


@query("SELECT page_id, ['Guest ' || page_id, 'Bo'] AS people FROM pages")
def page_json_ld_people(spark, sf_dir):
    script = F.concat(F.lit('<script type="application/ld+json">{"@graph":[{"@type":"PodcastEpisode","actor":[{"name":"Guest '), F.col("page_id").cast("string"), F.lit('"},"Bo"]},{"guest":"Bo"}]}</script>'))
    return table(spark, sf_dir, "pages").select("page_id", html.page_people(F.concat("html", script)).alias("people"))


@query("SELECT page_id, 'On page ' || page_id || ' & more' AS description FROM pages")
def page_description(spark, sf_dir):
    meta = F.concat(F.lit('<meta property="og:description" content="other"><meta content="On  page '), F.col("page_id").cast("string"), F.lit(' &amp; more" name="description">'))
    return table(spark, sf_dir, "pages").select("page_id", html.page_description(F.concat(meta, "html")).alias("description"))


@query()
def source_registry(spark, sf_dir):
    return registry_frame(spark, load_registry())
