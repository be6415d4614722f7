"""Schemas of the stored entities and the engine's fixed values."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

_S, _L = StringType(), ArrayType(StringType())

CHUNKING_POLICY = StructType([StructField("target_tokens", IntegerType()), StructField("overlap_tokens", IntegerType())])
EPISODE = StructType(
    [StructField(n, _S, False) for n in ("episode_id", "publisher", "series", "title")]
    + [StructField("host", _L), StructField("guest", _L), StructField("publication_date", _S, False)]
    + [StructField(n, _L) for n in ("country_region", "industry_tags", "function_tags", "business_model_tags")]
    + [StructField(n, _S, False) for n in ("source_type", "language", "primary_url")]
    + [StructField("asset_urls", _L), StructField("rights_code", _S, False)]
    + [StructField(n, _S) for n in ("rights_summary", "credibility_notes", "summary")]
    + [StructField("chunking_policy", CHUNKING_POLICY)]
)
CHUNK = StructType([
    StructField("chunk_id", _S, False), StructField("episode_id", _S, False), StructField("token_count", IntegerType(), False),
    StructField("section_heading", _S), StructField("chunk_text", _S, False), StructField("citation_anchor", _S, False),
])
GOVERNANCE = StructType([
    StructField("publisher_id", _S), StructField("episode_id", _S, False), StructField("rights_code", _S, False),
    StructField("ingestion_date", LongType(), False), StructField("content_hash", _S, False), StructField("deprecated", BooleanType()),
])
EMBEDDING = StructType([
    StructField("chunk_id", _S, False), StructField("model_tag", _S, False), StructField("embedding", ArrayType(FloatType()), False), StructField("created_at", LongType(), False),
])
HIT = StructType([
    *(StructField(n, _S) for n in ("chunk_id", "episode_id", "chunk_text", "citation_anchor", "section_heading")),
    StructField("rank_score", DoubleType()), StructField("bm25_score", DoubleType()), StructField("semantic_score", DoubleType()),
    StructField("tag_match", BooleanType()), StructField("created_at", LongType()),
])

SCHEMA_VERSION = 1
#: Defaults of chunking, search and the rights gate.
DEFAULT_TARGET_TOKENS, DEFAULT_OVERLAP_TOKENS = 700, 120
FTS_CAP, TAG_CAP, SEMANTIC_CAP, DEFAULT_LIMIT = 500, 500, 5000, 10
DISCOVERY_CAP, RESULT_CHARS = 25, 280
DEFAULT_RIGHTS = ("ogl_v3", "cc_by", "cc_by_sa", "cc_by_nc", "cc_by_nc_nd", "free_access_copyrighted", "public_domain")
REQUIRED = {s.json(): [f.name for f in s.fields if not f.nullable] for s in (EPISODE, CHUNK, GOVERNANCE)}
ARRAYS = [f.name for f in EPISODE.fields if isinstance(f.dataType, ArrayType)]
TEXT_DEFAULTS = ("rights_summary", "credibility_notes", "summary")
