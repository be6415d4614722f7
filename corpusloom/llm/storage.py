"""Tables that cut lineage, written where every executor can read them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusloom.storage import discard, release, shared_dir, written

__all__ = ["bucketed", "discard", "discard_bucketed", "load", "release", "shared_dir", "written", "written_by"]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written_by(df: DataFrame, name: str, column: str) -> DataFrame:
    """Like ``written``, in a folder for each value of ``column``, so that one value's rows are read
    alone."""
    folder = shared_dir(df.sparkSession)
    df.write.partitionBy(column).parquet(f"{folder}/{name}")
    out = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
    out.stored_in = folder
    return out


def bucketed(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` computed once and stored in the shared folder, dealt into buckets by ``keys`` and sorted
    by them within each, as many buckets as a shuffle has partitions: joins and groups of such tables
    by these keys need no shuffle."""
    spark = df.sparkSession
    folder, name = shared_dir(spark), f"run_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{folder}/{name}").saveAsTable(name)
    out = spark.table(name)
    out.stored_in, out.table_name = folder, name
    return out


def discard_bucketed(*tables: DataFrame) -> None:
    for df in tables:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.table_name}")
        discard(df)
