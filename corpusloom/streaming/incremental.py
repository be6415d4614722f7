"""Incremental ingest: each micro-batch is the batch ingest against what the store holds.

Content seen in any earlier run is recognised by an anti-join with the store, which never forgets,
unlike a watermarked deduplication. A batch becomes visible in one commit stamped with the query's id,
which its checkpoint keeps, and the batch's number: a batch that a restart repeats is passed over, the
batches of other queries, which count from 0 too, are not. Two queries may feed one store: whichever
comes second looks at the store again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.hashing import dedup_key
from corpusloom.functions.text import canonicalise
from corpusloom.operators.ingest import admitted_in_order, rights_allowed
from corpusloom.publish import Published, Transaction
from corpusloom.schemas import DEFAULT_RIGHTS
from corpusloom.storage import read_bytes

#: The table that streams feed.
SCHEMAS = {"admitted": "episode_id string, text string, rights_code string, content_key string, source string, batch_id long"}


def stream_store(spark: SparkSession, root: str) -> Published:
    return Published(spark, root, {t: spark.createDataFrame([], s).schema for t, s in SCHEMAS.items()})


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint over restarts."""
    return json.loads(read_bytes(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def admit_batch(batch: DataFrame, held: DataFrame, allow: Sequence[str] = DEFAULT_RIGHTS) -> DataFrame:
    """Rows (episode_id, text, rights_code) to append: allowed, new by id and by content, in
    the order of ids, then contents."""
    rows = batch.where(rights_allowed(F.col("rights_code"), allow)).withColumn("text", canonicalise("text")).withColumn("content_key", dedup_key(F.col("text")))
    return admitted_in_order(rows, held, "episode_id", "content_key", ["episode_id"])


def append_batch(store: Published, batch: DataFrame, source: str, batch_id: int, allow: Sequence[str] = DEFAULT_RIGHTS) -> bool:
    """Admits a batch of ``source`` exactly once; False if it is in the store already."""

    def work(tx: Transaction) -> None:
        new = admit_batch(batch, tx.read("admitted"), allow)
        tx.append("admitted", new.withColumn("source", F.lit(source)).withColumn("batch_id", F.lit(batch_id)))

    return store.run(work, (source, batch_id))


def stream_ingest(source: DataFrame, store_path: str, checkpoint: str, allow: Sequence[str] = DEFAULT_RIGHTS) -> StreamingQuery:
    """Starts a run over what has arrived; the checkpoint remembers the files it has read. The store
    is read with ``stream_store``."""

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        append_batch(stream_store(spark, store_path), batch, query_id(spark, checkpoint), batch_id, allow)

    return source.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
