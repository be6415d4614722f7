"""The state of the governance log, kept between runs instead of replayed.

A streaming query reads each log file once; every batch is summed up by episode and added as a segment,
with the query's id and the batch's number, in one commit. Segments of a level are merged into one of
the next whenever there are ``FAN`` of them, so a reader sums up a few segments, each with a row an
episode at most, however long the log is. What the rights list decides is decided on reading, since the
list may change: rejected codes are kept, not verdicts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.governance import attributed
from corpusloom.operators.ingest import rights_allowed
from corpusloom.publish import Published, Transaction
from corpusloom.schemas import DEFAULT_RIGHTS, GOVERNANCE
from corpusloom.storage import exists
from corpusloom.streaming.incremental import query_id

FAN = 4
TABLES = {"episodes": "publisher string, episode_id string, admitted boolean, rejected_codes array<string>, events long", "hashes": "content_hash string"}


def _summed(segments: DataFrame) -> DataFrame:
    codes = F.array_distinct(F.flatten(F.collect_list("rejected_codes"))).alias("rejected_codes")
    return segments.groupBy("publisher", "episode_id").agg(F.max("admitted").alias("admitted"), codes, F.sum("events").alias("events"))


class LogState(Published):
    """State under ``root`` of a log whose rows are attributed to ``publishers``, a list or a table."""

    def __init__(self, spark: SparkSession, root: str, publishers: Sequence[str] | DataFrame):
        super().__init__(spark, root, {t: spark.createDataFrame([], s).schema for t, s in TABLES.items()})
        self.publishers = publishers

    def _fold(self, tx: Transaction, log: DataFrame) -> None:
        log = attributed(log, self.publishers).withColumn("deprecated", F.coalesce("deprecated", F.lit(False)))
        code = F.when(F.col("deprecated"), F.coalesce(F.lower("rights_code"), F.lit("")))
        delta = log.groupBy("publisher", "episode_id").agg(F.max(~F.col("deprecated")).alias("admitted"), F.collect_set(code).alias("rejected_codes"), F.count("*").alias("events"))
        tx.append("episodes", delta, level=0)
        tx.append("hashes", log.where("not deprecated and content_hash != ''").select("content_hash").distinct(), level=0)
        for table, merged in (("episodes", _summed), ("hashes", DataFrame.distinct)):
            level = 0
            while len(full := [f for f in tx.folders(table) if f["level"] == level]) >= FAN:
                rows = self.spark.read.schema(self.schemas[table]).parquet(*(f"{self.root}/{f['path']}" for f in full))
                tx.append(table, merged(rows), level=level + 1)
                tx.drop(full)
                level += 1

    def add(self, log: DataFrame, source: str, batch_id: int) -> bool:
        """Adds a batch of log rows once; False if it is in the state already."""
        return self.run(lambda tx: self._fold(tx, log), (source, batch_id))

    def follow(self, log_path: str) -> None:
        """Reads what has been added to a folder of JSON Lines since the last time; malformed lines
        are left out, as in ``read_governance``."""
        if not exists(self.spark, log_path):
            return
        schema, checkpoint = GOVERNANCE, f"{self.root}/checkpoint"
        source = self.spark.readStream.schema(schema).option("mode", "DROPMALFORMED").json(log_path).where("episode_id is not null")
        add = lambda batch, batch_id: self.add(batch, query_id(self.spark, checkpoint), batch_id) and None
        source.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    def episodes(self) -> DataFrame:
        """(publisher, episode_id, admitted, rejected_codes, events), a row an episode."""
        return _summed(self.read("episodes"))

    def _chosen(self, admitted: bool, allow: Sequence[str]) -> DataFrame:
        still = F.exists("rejected_codes", lambda c: ~rights_allowed(c, allow))
        return self.episodes().where(F.col("publisher").isNotNull() & (still | F.col("admitted") if admitted else still)).select("publisher", "episode_id")

    def known_ids(self, allow: Sequence[str] = DEFAULT_RIGHTS) -> DataFrame:
        return self._chosen(True, allow)

    def rejected_ids(self, allow: Sequence[str] = DEFAULT_RIGHTS) -> DataFrame:
        return self._chosen(False, allow)

    def skip_set(self, incremental: bool, allow: Sequence[str] = DEFAULT_RIGHTS) -> DataFrame:
        return self._chosen(incremental, allow)

    def seen_hashes(self) -> DataFrame:
        return self.read("hashes").distinct()
