"""Hybrid search: full text, tags and vectors in one ranking.

Each lane is a DataFrame of (chunk_id, score parts); lanes are united and summed by chunk, boosted
for tags and cut by one top-k sort. The full-text lane reads the postings of a store's index, or scans
a chunk table that carries its tokens (``indexed``); neither needs Python.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.errors import InvalidArgument
from corpusloom.functions.text import fts_tokens, truncate_text
from corpusloom.functions.vectors import cosine
from corpusloom.operators.postings import K1, B, Index
from corpusloom.operators.vector_index import VectorIndex
from corpusloom.publish import Published
from corpusloom.schemas import DEFAULT_LIMIT, FTS_CAP, HIT, SEMANTIC_CAP, TAG_CAP

#: Request family by column of the episode table.
FAMILIES = {"industry": "industry_tags", "function": "function_tags", "business_model": "business_model_tags", "geography": "geography_tags", "evidence_type": "evidence_type"}


@dataclass(frozen=True)
class TagFilter:
    industry: tuple[str, ...] = ()
    function: tuple[str, ...] = ()
    business_model: tuple[str, ...] = ()
    geography: tuple[str, ...] = ()
    evidence_type: tuple[str, ...] = ()

    @property
    def active(self) -> bool:
        return any(getattr(self, f) for f in FAMILIES)


@dataclass(frozen=True)
class RankWeights:
    bm25: float = 2.0
    semantic: float = 1.5
    tag_boost: float = 0.75


@dataclass(frozen=True)
class SearchQuery:
    text: str = ""
    tags: TagFilter = field(default_factory=TagFilter)
    query_embedding: tuple[float, ...] | None = None
    semantic_model_tag: str | None = None
    #: None: all hits.
    limit: int | None = DEFAULT_LIMIT
    scope: str = "text_only"
    weights: RankWeights = field(default_factory=RankWeights)
    #: False: all chunks and vectors are candidates, not only the first of each lane.
    lane_caps: bool = True

    @classmethod
    def from_request(cls, request: dict) -> SearchQuery:
        """From camelCase keys and kebab-case scope; unknown keys are dropped, weights stay."""
        tags = request.get("tags") or {}
        own = TagFilter(**{f: tuple(tags.get(c) or ()) for f, c in (("industry", "industry"), ("function", "function"), ("business_model", "businessModel"), ("geography", "geography"), ("evidence_type", "evidenceType"))})
        vector = request.get("queryEmbedding")
        limit = request.get("limit", DEFAULT_LIMIT)
        if not isinstance(limit, int) or limit < 0:
            raise InvalidArgument(f"limit {limit!r}")
        return cls(request.get("text") or "", own, tuple(vector) if vector else None, request.get("semanticModelTag"), limit, str(request.get("scope") or "text-only").replace("-", "_"))


def indexed(chunks: DataFrame) -> DataFrame:
    """Chunks with the columns that search needs: tokens and their number."""
    return chunks.withColumn("tokens", fts_tokens("chunk_text")).withColumn("dl", F.size("tokens"))


def tag_families(episodes: DataFrame) -> DataFrame:
    """The five tag columns of each episode; geography and evidence come from other fields."""
    none = F.array().cast("array<string>")
    return episodes.select(
        "episode_id", *(F.coalesce(c, none).alias(c) for c in ("industry_tags", "function_tags", "business_model_tags")),
        F.coalesce("country_region", none).alias("geography_tags"), F.array("source_type").alias("evidence_type"),
    )


def matching_episodes(families: DataFrame, tags: TagFilter) -> DataFrame:
    """Ids of episodes with any value of every family asked for; of none when nothing is asked."""
    wanted = [F.arrays_overlap(F.col(c), F.array(*map(F.lit, v))) for f, c in FAMILIES.items() if (v := getattr(tags, f))]
    return families.where(reduce(Column.__and__, wanted) if wanted else F.lit(False)).select("episode_id").distinct()


def query_tokens(spark: SparkSession, text: str) -> list[str]:
    return spark.range(1).select(fts_tokens(F.lit(text))).first()[0]


def phrase_frequency(tokens: Column, phrase: list[str]) -> Column:
    """Occurrences of the phrase, overlapping ones too."""
    if not phrase:
        return F.lit(0)
    if len(phrase) == 1:
        return F.size(F.filter(tokens, lambda t: t == phrase[0]))
    wanted, k = F.array(*map(F.lit, phrase)), len(phrase)

    def count(held: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(held) - k + 1)
        return F.when((F.size(held) >= k) & F.array_contains(held, phrase[0]), F.size(F.filter(starts, lambda i: (F.get(held, i - 1) == phrase[0]) & (F.slice(held, i, k) == wanted)))).otherwise(0)

    # the tokens are bound to a variable of the lambda, so that they are made once a row
    return F.element_at(F.transform(F.array(tokens), count), 1)


def bm25_phrase(chunks: DataFrame, phrase: list[str]) -> DataFrame:
    """Chunks that hold the phrase with ``bm25``, higher is better. The statistics are one row over
    all chunks, sent to the tasks as such."""
    counted = chunks.withColumn("f", phrase_frequency(F.col("tokens"), phrase))
    # only the numbers that the statistics need are read for them, not the texts
    stats = counted.select("f", "dl").agg(F.count("*").alias("_docs"), F.avg("dl").alias("_avgdl"), F.count_if(F.col("f") > 0).alias("_hits"))
    raw = F.log((F.col("_docs") - F.col("_hits") + 0.5) / (F.col("_hits") + 0.5))
    idf = F.when(raw <= 0, F.lit(1e-6)).otherwise(raw)
    score = idf * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("dl") / F.col("_avgdl")))
    return counted.where("f > 0").crossJoin(F.broadcast(stats)).withColumn("bm25", score).drop("_docs", "_avgdl", "_hits", "f")


def capped(rows: DataFrame, order: list, cap: int | None) -> DataFrame:
    """The first ``cap`` rows in order; all of them for None, the exact way beyond the cap."""
    return rows if cap is None else rows.orderBy(*order).limit(cap)


def fts_lane(chunks: DataFrame, phrase: list[str], matching: DataFrame | None, cap: int | None = FTS_CAP, index: Index | None = None) -> DataFrame:
    """The best ``cap`` chunks by bm25; only then the tag filter. With an index the chunks are not
    read."""
    if not phrase:
        return chunks.limit(0).select("chunk_id", "episode_id", F.lit(0.0).alias("bm25"))
    rows = index.bm25(phrase) if index else bm25_phrase(chunks.select("chunk_id", "episode_id", "tokens", "dl"), phrase)
    top = capped(rows, [F.desc("bm25"), "chunk_id"], cap).select("chunk_id", "episode_id", "bm25")
    return top.join(matching, "episode_id", "left_semi") if matching is not None else top


def tag_lane(chunks: DataFrame, matching: DataFrame, cap: int | None = TAG_CAP) -> DataFrame:
    rows = chunks.select("chunk_id", "episode_id", "created_at").join(matching, "episode_id", "left_semi")
    return capped(rows, [F.desc("created_at"), "chunk_id"], cap).select("chunk_id", "episode_id")


def semantic_lane(chunks: DataFrame, embeddings: DataFrame, vector: list[float], model_tag: str, matching: DataFrame | None, cap: int | None = SEMANTIC_CAP) -> DataFrame:
    """Cosines of at most ``cap`` vectors of the model, tags first; other sizes are left out."""
    rows = embeddings.where(F.col("model_tag") == model_tag).select("chunk_id", "embedding").join(chunks.select("chunk_id", "episode_id"), "chunk_id")
    if matching is not None:
        rows = rows.join(matching, "episode_id", "left_semi")
    query = F.array(*(F.lit(float(v)) for v in vector)).cast("array<float>")
    return capped(rows, ["chunk_id"], cap).where(F.size("embedding") == len(vector)).select("chunk_id", "episode_id", cosine(F.col("embedding"), query).alias("cosine"))


def search(chunks: DataFrame, families: DataFrame, query: SearchQuery, embeddings: DataFrame | None = None, index: Index | None = None, vectors: VectorIndex | None = None) -> DataFrame:
    """Hits in order, with the columns of HIT. ``chunks`` has tokens (``indexed``) or comes with the
    index of its store. A query by vector alone, without the caps of the lanes, is answered by
    ``vectors`` if it is given: exactly, without a scan."""
    spark, w = chunks.sparkSession, query.weights
    caps = (FTS_CAP, TAG_CAP, SEMANTIC_CAP) if query.lane_caps else (None, None, None)
    text, active = query.text.strip(), query.tags.active
    matching = matching_episodes(families, query.tags) if active else None
    phrase = query_tokens(spark, text) if text else []
    none = F.lit(None).cast("double")
    lanes = []
    if text:
        lanes.append(fts_lane(chunks, phrase, matching, caps[0], index).select("chunk_id", "episode_id", (w.bm25 * F.col("bm25")).alias("score"), F.col("bm25"), none.alias("cosine")))
    elif active:
        lanes.append(tag_lane(chunks, matching, caps[1]).select("chunk_id", "episode_id", F.lit(0.0).alias("score"), none.alias("bm25"), none.alias("cosine")))
    if query.scope == "include_embeddings" and query.query_embedding and query.semantic_model_tag and embeddings is not None:
        alone = vectors is not None and not text and not active and not query.lane_caps and query.limit is not None
        if alone:
            # equal cosines go by age and id of the chunk, so all that reach the last one are candidates
            top = vectors.top(list(query.query_embedding), query.semantic_model_tag, query.limit or DEFAULT_LIMIT, ties=True)
            lane = top.join(chunks.select("chunk_id", "episode_id"), "chunk_id")
        else:
            lane = semantic_lane(chunks, embeddings, list(query.query_embedding), query.semantic_model_tag, matching, caps[2])
        lanes.append(lane.select("chunk_id", "episode_id", (w.semantic * F.col("cosine")).alias("score"), none.alias("bm25"), F.col("cosine")))
    if not lanes:
        return spark.createDataFrame([], HIT)
    merged = reduce(DataFrame.unionByName, lanes).groupBy("chunk_id").agg(F.sum("score").alias("score"), F.max("bm25").alias("bm25_score"), F.max("cosine").alias("semantic_score"))
    rank = F.col("score") + (w.tag_boost if active else 0.0)
    order = [F.desc("rank_score"), F.desc("created_at"), "chunk_id"]
    if query.lane_caps:  # two lanes of a fixed number of rows each
        merged = F.broadcast(merged)
    elif query.limit is not None:  # ranked without the texts, which are joined to the best only
        best = chunks.select("chunk_id", "created_at").join(merged, "chunk_id").withColumn("rank_score", rank).orderBy(*order).limit(query.limit or DEFAULT_LIMIT)
        merged = best.select(*merged.columns).distinct()
        merged = F.broadcast(merged) if (query.limit or DEFAULT_LIMIT) <= SEMANTIC_CAP else merged
    hits = chunks.select("chunk_id", "episode_id", "chunk_text", "citation_anchor", "section_heading", "created_at").join(merged, "chunk_id").select(
        "chunk_id", "episode_id", "chunk_text", "citation_anchor", "section_heading", rank.alias("rank_score"), "bm25_score", "semantic_score", F.lit(active).alias("tag_match"), "created_at"
    )
    hits = hits.orderBy(*order)
    return hits if query.limit is None else hits.limit(query.limit or DEFAULT_LIMIT)


def search_store(store: Published, query: SearchQuery) -> DataFrame:
    """Hits of a store by its own index; other tokens than the phrase's are not read."""
    return search(store.read("chunks"), tag_families(store.read("episodes")), query, store.read("embeddings"), Index(store))


def emit_json(hits: DataFrame) -> DataFrame:
    """One camelCase JSON object a hit; absent scores are left out."""
    names = {"chunk_id": "chunkId", "episode_id": "episodeId", "chunk_text": "chunkText", "citation_anchor": "citationAnchor", "section_heading": "sectionHeading", "rank_score": "rankScore", "bm25_score": "bm25Score", "semantic_score": "semanticScore", "tag_match": "tagMatch", "created_at": "createdAt"}
    return hits.select(F.to_json(F.struct(*(F.col(a).alias(b) for a, b in names.items()))).alias("json"))


def emit_text(hits: DataFrame) -> DataFrame:
    return hits.select(F.concat_ws("\n", F.concat(F.lit("["), F.round("rank_score", 4).cast("string"), F.lit("] "), "chunk_id"), F.col("citation_anchor"), truncate_text("chunk_text")).alias("text"))
