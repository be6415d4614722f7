"""Token-id files: documents in ascending id order, coded in Simple-8b.

A dataset of token files is a folder of Parquet files, so that it can stand in any store that
Spark writes to. A row is one block of a shard: ``shard`` (ranges of ids, ascending), ``block``,
``start`` (ids of the shard before the block), ``doc_ids``, ``lengths`` (ids of each document) and
``payload`` (all ids of the block, see simple8b).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm import simple8b
from corpusloom.llm.byte_bpe import byte_bpe
from corpusloom.llm.storage import shared_dir

FORMAT = "shard int, block int, start long, doc_ids array<long>, lengths array<long>, payload binary"
BLOCK_IDS = 1 << 18


def _encode(tokenizer: str, end_id: int):
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        bpe, shard = byte_bpe(tokenizer), TaskContext.get().partitionId()
        block, start, held, ids, parts = 0, 0, 0, [], []

        def row():
            lengths = [len(x) // 4 for x in parts]
            payload = simple8b.encode(np.frombuffer(b"".join(parts), "<u4"))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())), pa.array([payload], pa.binary())], ["shard", "block", "start", "doc_ids", "lengths", "payload"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packed = bpe.encode_packed(text.as_py() or "") + end
                ids.append(doc_id)
                parts.append(packed)
                held += len(packed) // 4
                if held >= BLOCK_IDS:
                    yield row()
                    block, start, held, ids, parts = block + 1, start + held, 0, [], []
        if ids:
            yield row()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every whole text, appends ``end_id`` and writes token files to ``path``.

    Documents stand in ascending id order (null first; repeated ids by text); a null or empty text
    is the end id alone. Other columns are ignored. No rows give an empty folder of files.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(_encode(tokenizer, end_id), FORMAT).write.parquet(path)


def _decoded(batches, kind: pa.DataType, name: str, of):
    """Rows of all documents of the blocks, with ``of`` of each document's packed ids."""
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), kind)
    for batch in batches:
        out: list[tuple] = []
        for row in batch.to_pylist():
            values, at = memoryview(simple8b.decode(row["payload"]).astype("<u4")).cast("B"), 0
            for doc_id, length in zip(row["doc_ids"], row["lengths"], strict=True):
                out.append((doc_id, row["shard"], row["start"] + at, length, of(values[4 * at : 4 * (at + length)])))
                at += length
        columns = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "shard", "local_start", "n_tokens", name])


def _decode(batches):
    return _decoded(batches, pa.binary(), "ids", bytes)


def _digest(batches):
    return _decoded(batches, pa.int64(), "ids_crc32", zlib.crc32)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, shard, local_start, n_tokens, ids) of every document; ids packed as <u4."""
    return spark.read.schema(FORMAT).parquet(path).mapInArrow(_decode, "doc_id long, shard int, local_start long, n_tokens long, ids binary")


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, first): ids of all shards before each; one row a shard."""
    files = spark.read.schema(FORMAT).parquet(path)
    totals = files.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))


def token_file_digest(docs: DataFrame, tokenizer: str, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Writes token files and reads them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/tokens"
    write_token_files(docs, path, tokenizer, end_id)
    read = spark.read.schema(FORMAT).parquet(path).mapInArrow(_digest, "doc_id long, shard int, local_start long, n_tokens long, ids_crc32 long")
    return read.join(shard_starts(spark, path), "shard").select("doc_id", (F.col("first") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
