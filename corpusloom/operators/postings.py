"""A positional full-text index kept up on insert.

Each insert adds a segment: for every term of the new chunks, the chunks that hold it with their
positions, in runs sorted by term, and one row of statistics. A task writes the runs of its own chunks,
so an insert shuffles nothing. Segments of a level are merged into one of the next, sorted as a whole,
whenever there are ``FAN`` of them. A search reads the pages of its own terms only, by the ranges of
terms that Parquet keeps, and finds phrases by joining positions; no text is read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from corpusloom.publish import Published, Transaction

FAN = 4
K1, B = 1.2, 0.75
#: Bytes of tokens that are sorted at once; a worker needs some eight times as much for it.
RUN_BYTES = 32 << 20
#: Chunks that are added to a run at once, and postings that are handed on at once.
SLICE_ROWS, OUT_ROWS = 256, 16_384
#: The tables of an index, by name.
TABLES = {
    "postings": StructType().add("term", StringType()).add("chunk_id", StringType()).add("episode_id", StringType()).add("dl", IntegerType()).add("positions", ArrayType(IntegerType())),
    "index_stats": StructType().add("docs", LongType()).add("tokens", LongType()),
}


def _sorted_run(held: list[pa.RecordBatch]):
    """Postings of all chunks in the batches (chunk_id, episode_id, dl, tokens), by term and chunk."""
    rows = pa.Table.from_batches(held).combine_chunks()
    tokens = rows.column(3).combine_chunks()
    sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    at = (np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
    terms = tokens.flatten().dictionary_encode()
    place, ids = np.empty(len(terms.dictionary), np.int64), np.empty(len(sizes), np.int64)
    place[pc.sort_indices(terms.dictionary).to_numpy()] = np.arange(len(place))
    ids[pc.sort_indices(rows.column(0)).to_numpy()] = np.arange(len(ids))
    key = place[terms.indices.to_numpy(zero_copy_only=False)] * max(1, len(sizes)) + ids[row]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([key[:1] == key[:1], key[1:] != key[:-1]]))
    ends, at = np.append(first, len(key)), at[order]
    own = rows.select(["chunk_id", "episode_id", "dl"])
    for start in range(0, len(first), OUT_ROWS):
        part = first[start : start + OUT_ROWS]
        end = ends[start : start + len(part) + 1]
        positions = pa.ListArray.from_arrays(pa.array((end - end[0]).astype(np.int32)), pa.array(at[end[0] : end[-1]]))
        columns = [c.combine_chunks() for c in own.take(pa.array(row[order[part]])).columns]
        yield pa.RecordBatch.from_arrays([terms.dictionary.take(terms.indices.take(pa.array(order[part]))), *columns, positions], ["term", "chunk_id", "episode_id", "dl", "positions"])


def _sorted_tokens(batches):
    """Postings of chunks, each of which is whole in its batch, so no token needs to be sent anywhere; in
    runs of ``RUN_BYTES`` of tokens, each sorted by itself."""
    held, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            held.append(part)
            size += part.nbytes
            if size >= RUN_BYTES:
                yield from _sorted_run(held)
                held, size = [], 0
    if held:
        yield from _sorted_run(held)


def postings(chunks: DataFrame) -> DataFrame:
    """(term, chunk_id, episode_id, dl, positions) of chunks with tokens and dl."""
    return chunks.select("chunk_id", "episode_id", "dl", "tokens").mapInArrow(_sorted_tokens, TABLES["postings"])


def _by_term(rows: DataFrame) -> DataFrame:
    """By ranges of term and chunk, so that a term in very many chunks spans several files."""
    return rows.repartitionByRange("term", "chunk_id").sortWithinPartitions("term", "chunk_id")


def add_segment(tx: Transaction, chunks: DataFrame) -> None:
    """Indexes new chunks (with tokens and dl) in the transaction that appends them, and merges the
    levels that are full then."""
    stored = tx.append("postings", postings(chunks), level=0)
    # every token has one position, so the texts need not be split again to count them
    tokens = stored.agg(F.coalesce(F.sum(F.size("positions")), F.lit(0)).alias("tokens"))
    tx.append("index_stats", chunks.agg(F.count("*").alias("docs")).crossJoin(F.broadcast(tokens)), level=0)
    for table in TABLES:
        level = 0
        while len(full := [f for f in tx.folders(table) if f["level"] == level]) >= FAN:
            rows = tx.tables.spark.read.schema(TABLES[table]).parquet(*(f"{tx.tables.root}/{f['path']}" for f in full))
            merged = _by_term(rows) if table == "postings" else rows.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            tx.append(table, merged, level=level + 1)
            tx.drop(full)
            level += 1


def _shifted(positions: Column, by: int) -> Column:
    return F.transform(positions, lambda p: p - by)


class Index:
    """The index of a store as one list of folders has it."""

    def __init__(self, tables: Published):
        state = tables.state()
        self.postings, self.stats = tables.read("postings", state), tables.read("index_stats", state)

    def occurrences(self, phrase: list[str]) -> DataFrame:
        """(chunk_id, episode_id, dl, f): chunks that hold the phrase, with how often, overlapping
        occurrences too."""
        held = self.postings.where(F.col("term").isin(sorted(set(phrase)))) if phrase else self.postings.where(F.lit(False))
        found = None
        for k, term in enumerate(phrase or [""]):
            starts = _shifted(F.col("positions"), k)
            one = held.where(F.col("term") == term)
            if found is None:
                found = one.select("chunk_id", "episode_id", "dl", starts.alias("at"))
            else:
                found = found.join(one.select("chunk_id", starts.alias("next")), "chunk_id").withColumn("at", F.array_intersect("at", "next")).drop("next").where(F.size("at") > 0)
        return found.select("chunk_id", "episode_id", "dl", F.size("at").alias("f"))

    def bm25(self, phrase: list[str]) -> DataFrame:
        """(chunk_id, episode_id, bm25) of chunks that hold the phrase, higher is better."""
        found = self.occurrences(phrase)
        total = self.stats.agg(F.sum("docs").alias("_docs"), (F.sum("tokens") / F.sum("docs")).alias("_avgdl"))
        stats = total.crossJoin(F.broadcast(found.agg(F.count("*").alias("_hits"))))  # one row each
        raw = F.log((F.col("_docs") - F.col("_hits") + 0.5) / (F.col("_hits") + 0.5))
        idf = F.when(raw <= 0, F.lit(1e-6)).otherwise(raw)
        score = idf * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("dl") / F.col("_avgdl")))
        return found.crossJoin(F.broadcast(stats)).select("chunk_id", "episode_id", score.alias("bm25"))
