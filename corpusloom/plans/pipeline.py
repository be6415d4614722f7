"""The landing pipeline: landed pages -> rights gate -> normalise -> deduplicate -> chunk -> log.

One pass of joins over a DataFrame of landed pages gives each page exactly one verdict:
skipped_incremental, rejected_rights, failed, skipped_dedup or admitted. Fetching is not part of
the engine: pages come as rows (publisher_id, slug, url, html or body, optional rights_code, title,
seq).
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.hashing import content_hash, dedup_key
from corpusloom.functions.text import canonicalise, episode_id, page_title, publication_date
from corpusloom.operators import chunking, governance
from corpusloom.operators.ingest import admitted_in_order, effective_rights, meeting, rights_allowed
from corpusloom.publish import Published, Transaction
from corpusloom.schemas import DEFAULT_RIGHTS
from corpusloom.sources.html import page_description, read_page
from corpusloom.sources.jsonl import append_jsonl
from corpusloom.sources.registry import Source, registry_frame
from corpusloom.storage import written
from corpusloom.streaming.log_state import LogState

VERDICTS = ("skipped_incremental", "rejected_rights", "failed", "skipped_dedup", "admitted")


def judged(pages: DataFrame, registry: DataFrame, log: DataFrame | LogState, publishers: Sequence[str], incremental: bool, allow: Sequence[str] = DEFAULT_RIGHTS) -> DataFrame:
    """Pages with their registry fields, normalised text and ``verdict``. The registry is a few
    dozen rows by construction, so it goes to every task. Pages are read once and stored; of the open
    ones each goes in, by publisher and seq, unless its text or its id has gone in before it. ``log``
    is the governance log, which is replayed, or the state that is kept of it."""
    if isinstance(log, LogState):
        skipped, seen = log.skip_set(incremental, allow), log.seen_hashes()
    else:
        named = governance.attributed(log, publishers)
        skipped, seen = governance.skip_set(named, incremental, allow), governance.seen_hashes(log)
    own = pages.withColumnRenamed("rights_code", "own_rights") if "rights_code" in pages.columns else pages.withColumn("own_rights", F.lit(None).cast("string"))
    rows = own.join(F.broadcast(registry), "publisher_id").withColumn("episode_id", episode_id(F.col("publisher_id"), F.col("series_id"), F.col("slug")))
    rows = rows.withColumn("code", effective_rights(F.col("own_rights"), F.col("rights_code")))
    skip = written(skipped.select("episode_id", F.lit(True).alias("skip")).distinct(), "skipped")
    rows = meeting(rows, skip, ["episode_id"], "left")
    gate = F.when(F.col("skip"), "skipped_incremental").when(~rights_allowed(F.col("code"), allow), "rejected_rights")
    rows = rows.withColumn("gate", gate)
    read = read_page("publisher_id", "url", F.when(F.col("gate").isNull() & F.col("body").isNull(), F.col("html")))
    rows = rows.withColumn("page", F.when(F.col("gate").isNull(), read)).withColumn("text", canonicalise(F.coalesce("body", F.when(F.col("html").isNotNull(), F.col("page.markdown")))))
    rows = rows.withColumn("key", dedup_key(F.col("text"))).withColumn("hash", F.when(F.col("gate").isNull(), content_hash(F.col("text"))))
    gate = F.coalesce("gate", F.when(F.col("page.error").isNotNull() | F.col("text").isNull(), F.lit("failed")))
    rows = written(rows.withColumn("gate", gate).withColumn("row", F.monotonically_increasing_id()), "read")
    # only pages that are still open meet the log's hashes and one another
    opened = rows.where("gate is null").select("row", "key", "episode_id", "publisher_id", "seq", F.col("hash").alias("content_hash"))
    fresh = opened.join(seen, "content_hash", "left_anti").drop("content_hash")
    none = fresh.limit(0).select("episode_id", "key")
    winners = written(admitted_in_order(fresh, none, "episode_id", "key", ["publisher_id", "seq", "row"]).select("row", F.lit(True).alias("wins")), "winners")
    judged = meeting(rows.where("gate is null"), winners, ["row"], "left").withColumn("verdict", F.when(F.col("wins"), "admitted").otherwise("skipped_dedup")).drop("wins")
    return judged.unionByName(rows.where("gate is not null").withColumn("verdict", F.col("gate"))).drop("row")


def stats(rows: DataFrame) -> DataFrame:
    """Verdicts by publisher; pages that an incremental run passes over don't count as seen."""
    count = lambda v: F.count_if(F.col("verdict") == v).alias(v)
    return rows.groupBy("publisher_id").agg(F.count_if(F.col("verdict") != "skipped_incremental").alias("seen"), *map(count, VERDICTS))


def exit_code(totals: dict[str, int]) -> int:
    """1 for a run that saw pages and neither admitted, rejected nor recognised any."""
    return int(totals.get("seen", 0) > 0 and not any(totals.get(k, 0) for k in ("admitted", "rejected_rights", "skipped_dedup")))


def episodes_of(rows: DataFrame) -> DataFrame:
    html = F.coalesce("html", F.lit(""))
    given = F.col("title") if "title" in rows.columns else F.lit(None).cast("string")
    return rows.where("verdict = 'admitted'").select(
        "episode_id", F.col("publisher_id").alias("publisher"), F.col("series_id").alias("series"), F.coalesce(given, page_title(html)).alias("title"),
        F.when(F.col("host") != "", F.array("host")).otherwise(F.array().cast("array<string>")).alias("host"), F.coalesce("page.guests", F.array().cast("array<string>")).alias("guest"),
        publication_date(html).alias("publication_date"), "country_region", "industry_tags", "function_tags", "business_model_tags", "source_type", "language",
        F.col("url").alias("primary_url"), F.coalesce("page.assets", F.array().cast("array<string>")).alias("asset_urls"), F.col("code").alias("rights_code"), "rights_summary", "credibility_notes",
        page_description(html).alias("summary"), F.struct("target_tokens", "overlap_tokens").alias("chunking_policy"),
    )


def content_kind(rows: DataFrame) -> Column:
    """The ending under which a raw page is kept: what its bytes are, by their start."""
    raw = F.coalesce("html", "body")
    start = F.lower(F.substring(F.ltrim(raw), 1, 256))
    return F.when(F.startswith(start, F.lit("%pdf")), "pdf").when(F.col("html").isNotNull() | F.rlike(start, F.lit("^<(!doctype html|html|head|body)")), "html").when(F.length(raw) > 0, "txt").otherwise("bin")


#: What a run keeps beside its JSON Lines, published together: raw and normalised pages of admitted
#: episodes, and the pages that could not be read, with how often that was tried.
_PAGE = "publisher_id string, slug string, url string, html string, body string, rights_code string, title string, seq long"
KEPT = {
    "raw": "episode_id string, publisher_id string, slug string, url string, kind string, content string",
    "normalised": "episode_id string, markdown string, content_hash string",
    "dead_letters": f"{_PAGE}, episode_id string, error string, attempt int, failed_at long",
}
#: Attempts to read a page before it is only reported.
MOST_ATTEMPTS = 2


class Pipeline:
    """Runs over landed pages and appends episodes, chunks and governance rows under ``root``, and the
    tables of ``KEPT`` under ``root``/kept."""

    def __init__(self, spark: SparkSession, sources: dict[str, Source], root: str, incremental: bool = False, allow: Sequence[str] = DEFAULT_RIGHTS):
        self.spark, self.sources, self.root, self.incremental, self.allow = spark, sources, root.rstrip("/"), incremental, allow
        self.kept = Published(spark, f"{self.root}/kept", {t: spark.createDataFrame([], s).schema for t, s in KEPT.items()})

    def run(self, pages: DataFrame, publishers: Sequence[str] | None = None, now: int | None = None) -> DataFrame:
        """Stats by publisher; unknown names in ``publishers`` are left out, no names mean all."""
        wanted = [p for p in (publishers or self.sources) if p in self.sources]
        return stats(self._land(pages, wanted, int(now or time.time())))

    def retry(self, now: int | None = None) -> DataFrame:
        """Reads the pages again that failed fewer than ``MOST_ATTEMPTS`` times; stats by publisher."""
        again = self.failures().where(F.col("attempt") < MOST_ATTEMPTS)
        return stats(self._land(again, list(self.sources), int(now or time.time())))

    def failures(self) -> DataFrame:
        """The newest dead letter of each episode that is not admitted by now."""
        letters = self.kept.read("dead_letters")
        newest = letters.groupBy("episode_id").agg(F.max_by(F.struct(*(c for c in letters.columns if c != "episode_id")), "attempt").alias("x")).select("episode_id", "x.*")
        return newest.join(self.kept.read("normalised"), "episode_id", "left_anti")

    def _land(self, pages: DataFrame, wanted: list[str], now: int) -> DataFrame:
        registry = registry_frame(self.spark, {p: self.sources[p] for p in wanted}).drop("episodes")
        log = LogState(self.spark, f"{self.root}/log_state", list(self.sources))
        log.follow(f"{self.root}/governance")
        governance.require_subset(log.rejected_ids(self.allow), log.known_ids(self.allow))
        attempts = self.kept.read("dead_letters").groupBy("episode_id").agg(F.max("attempt").alias("tried"))
        pages = pages.drop("episode_id", "error", "attempt", "failed_at")
        rows = written(judged(pages, registry, log, list(self.sources), self.incremental, self.allow), "judged")
        admitted = rows.where("verdict = 'admitted'").withColumn("policy", F.struct("target_tokens", "overlap_tokens"))
        append_jsonl(episodes_of(rows), f"{self.root}/metadata", "publisher")
        chunks = chunking.chunk_documents(admitted.withColumnRenamed("url", "primary_url"), "text", "policy")
        append_jsonl(chunks, f"{self.root}/chunks")
        entry = rows.where("verdict in ('admitted', 'rejected_rights')").select(
            "publisher_id", "episode_id", F.col("code").alias("rights_code"), F.lit(now).cast("long").alias("ingestion_date"),
            F.coalesce("hash", F.lit("")).alias("content_hash"), (F.col("verdict") == "rejected_rights").alias("deprecated"),
        )
        append_jsonl(entry, f"{self.root}/governance")
        self.kept.run(lambda tx: self._keep(tx, rows, admitted, attempts, now))
        return rows

    def _keep(self, tx: Transaction, rows: DataFrame, admitted: DataFrame, attempts: DataFrame, now: int) -> None:
        tx.append("raw", admitted.select("episode_id", "publisher_id", "slug", "url", content_kind(admitted).alias("kind"), F.coalesce("html", "body").alias("content")))
        tx.append("normalised", admitted.select("episode_id", F.col("text").alias("markdown"), F.col("hash").alias("content_hash")))
        title = F.col("title") if "title" in rows.columns else F.lit(None).cast("string")
        failed = rows.where("verdict = 'failed'").join(attempts, "episode_id", "left").select(
            "publisher_id", "slug", "url", "html", "body", F.col("own_rights").alias("rights_code"), title.alias("title"), "seq", "episode_id",
            F.coalesce("page.error", F.lit("no text")).alias("error"), (F.coalesce("tried", F.lit(0)) + 1).alias("attempt"), F.lit(now).alias("failed_at"),
        )
        tx.append("dead_letters", failed)
