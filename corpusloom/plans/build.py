"""From JSON Lines folders to a store."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import ingest as ops
from corpusloom.publish import Transaction
from corpusloom.schemas import DEFAULT_RIGHTS
from corpusloom.sources.jsonl import Store, read_chunks, read_metadata


def ingest_folder(store: Store, root: str, allow: Sequence[str] = DEFAULT_RIGHTS, now: int | None = None) -> DataFrame:
    """Reads ``root``/metadata and ``root``/chunks into the store and returns stats by publisher.
    Rows come in the order of files by path; a second run inserts nothing. Chunks, index, episodes and
    log become visible together, so a run that dies leaves the store as it was."""
    now = int(now or time.time())
    episodes = ops.with_defaults(read_metadata(store.spark, root))
    ops.require_publishers(episodes, "stem")
    chunks, found = read_chunks(store.spark, root), []

    def work(tx: Transaction) -> None:
        more, fresh, stats = ops.ingest(episodes, chunks, tx.read("episodes"), tx.read("chunks"), allow)
        held = tx.read("episodes").select("episode_id").unionByName(episodes.select("episode_id"))
        ops.require_no_orphans(fresh, held)
        found[:] = [stats.collect(), stats.schema]
        store.add_chunks(tx, fresh.withColumn("created_at", F.lit(now)))
        tx.append("episodes", more.withColumn("metadata_json", ops.metadata_json(more)).withColumn("created_at", F.lit(now)))
        tx.append("governance", ops.governance_rows(episodes, now, allow))

    store.run(work)
    return store.spark.createDataFrame(*found)
