"""JSON Lines and stores of Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.errors import IncompatibleSchema, Invariant
from corpusloom.functions.text import fts_tokens
from corpusloom.operators.postings import TABLES as INDEX_TABLES
from corpusloom.operators.postings import add_segment
from corpusloom.publish import Published, Transaction
from corpusloom.schemas import CHUNK, EMBEDDING, EPISODE, GOVERNANCE, SCHEMA_VERSION
from corpusloom.storage import exists

#: Files that a task writes side by side.
OPEN_FILES = 64
SEQ = StructType().add("file", "string").add("block", "long").add("row", "long")


def _optional(schema: StructType) -> StructType:
    out = StructType()
    for f in schema.fields:
        out = out.add(f.name, f.dataType, True)
    return out


def read_strict(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Blank lines are skipped, a bad line ends the job, and so does a missing required field when
    the rows are used. ``stem`` is the file's name without its ending, or the value of its folder; ``seq`` orders rows by path,
    block of the file and place in it, however Spark deals files to tasks."""
    rows = spark.read.schema(_optional(schema)).option("mode", "FAILFAST").json(path)
    # URL forms in the path: of the folder by= that Spark makes, or of the file itself
    folder, name = F.regexp_extract(F.col("_metadata.file_path"), "/by=([^/]+)/[^/]+$", 1), F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.jsonl$", 1)
    rows = rows.withColumn("stem", F.url_decode(F.url_decode(F.coalesce(F.nullif(folder, F.lit("")), name))))
    rows = rows.withColumn("seq", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")))
    for f in schema.fields:
        if not f.nullable:
            rows = rows.withColumn(f.name, F.when(F.col(f.name).isNull(), F.raise_error(F.lit(f"missing field {f.name}")).cast(f.dataType)).otherwise(F.col(f.name)))
    return rows


def _read_all(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Files of one publisher each, and the folders that ``append_jsonl`` makes of many."""
    paths = [p for p in (f"{root}/*.jsonl", f"{root}/*.json", f"{root}/by=*/*.json") if exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], _optional(schema).add("stem", "string").add("seq", SEQ))
    found = [read_strict(spark, p, schema) for p in paths]
    return reduce(DataFrame.unionByName, found)


def read_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Episodes of all publishers under ``root``/metadata; none if the folder is missing."""
    return _read_all(spark, f"{root}/metadata", EPISODE)


def read_chunks(spark: SparkSession, root: str) -> DataFrame:
    return _read_all(spark, f"{root}/chunks", CHUNK)


def read_governance(spark: SparkSession, path: str) -> DataFrame:
    """The log, without malformed lines."""
    if not exists(spark, path):
        return spark.createDataFrame([], _optional(GOVERNANCE))
    return spark.read.schema(_optional(GOVERNANCE)).option("mode", "DROPMALFORMED").json(path).where("episode_id is not null")


def append_jsonl(rows: DataFrame, path: str, by: str | None = None) -> None:
    """Appends a file a task, in a folder for each value of the column ``by`` if it is given. A task keeps
    up to ``OPEN_FILES`` of these open; only rows of further values are sorted."""
    writer = (rows.withColumn("by", F.col(by)) if by else rows).write.mode("append").option("ignoreNullFields", "false")
    name = "spark.sql.maxConcurrentOutputFileWriters"
    conf = rows.sparkSession.conf
    before = conf.get(name)
    try:
        conf.set(name, str(max(OPEN_FILES, int(before))))
        (writer.partitionBy("by") if by else writer).json(path)
    finally:
        conf.set(name, before)


def as_dict(row: Row) -> dict:
    """A row with its inner rows, also those in lists and maps, as plain dictionaries."""

    def plain(x):
        if isinstance(x, Row):
            return {k: plain(v) for k, v in x.asDict().items()}
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x

    return plain(row)


class Store(Published):
    """Append-only Parquet tables under one folder, with a version stamp and a full-text index."""

    TABLES = {
        "episodes": _optional(EPISODE).add("metadata_json", "string").add("created_at", "long"),
        "chunks": _optional(CHUNK).add("content_key", "string").add("content_hash", "string").add("created_at", "long"),
        "governance": _optional(GOVERNANCE),
        "embeddings": _optional(EMBEDDING),
        "version": StructType().add("schema_version", "integer"),
        **INDEX_TABLES,
    }

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, self.TABLES)
        stamp = self.read("version").agg(F.max("schema_version")).first()[0]
        if stamp is None:
            self.append("version", spark.createDataFrame([(SCHEMA_VERSION,)], self.TABLES["version"]))
        elif stamp > SCHEMA_VERSION:
            raise IncompatibleSchema(f"the store has schema {stamp}, this engine reads up to {SCHEMA_VERSION}")

    def append(self, table: str, rows: DataFrame) -> None:
        """Rows of one table alone."""
        self.run(lambda tx: tx.append(table, rows))

    def add_chunks(self, tx: Transaction, rows: DataFrame) -> None:
        """Appends chunks and indexes their texts, in one transaction."""
        stored = tx.append("chunks", rows)
        add_segment(tx, stored.select("chunk_id", "episode_id", fts_tokens("chunk_text").alias("tokens")).withColumn("dl", F.size("tokens")))

    def add_embeddings(self, rows: DataFrame) -> None:
        keys = ["chunk_id", "model_tag"]

        def work(tx: Transaction) -> None:
            if rows.groupBy(keys).count().where("count > 1").head(1) or rows.join(tx.read("embeddings"), keys, "left_semi").head(1):
                raise Invariant("a chunk has one vector for a model")
            tx.append("embeddings", rows)

        self.run(work)

    def counts(self) -> dict[str, int]:
        return {t: self.read(t).count() for t in ("episodes", "chunks")}
