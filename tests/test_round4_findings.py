"""Findings of round 4, each with a test that failed before."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusloom import queries


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """12,000 documents with vectors, of which more than a lane's 5,000 have the model and the tags."""
    folder = str(tmp_path_factory.mktemp("many"))
    ids = spark.range(12_000)
    word = F.when(F.col("id") % 3 < 2, F.concat(F.lit("with the "), F.repeat(F.lit("and "), (F.col("id") % 40).cast("int")))).otherwise(F.lit("nothing"))
    ids.select(F.col("id").alias("doc_id"), word.alias("text"), F.lit("en").alias("lang"), F.concat(F.lit("src"), (F.col("id") % 4).cast("string")).alias("source"), F.length(word).cast("long").alias("n_chars")).write.parquet(f"{folder}/documents.parquet")
    ids.select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{folder}/labels.parquet")
    vector = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda k: (F.pmod(F.hash("id", k), F.lit(100)) - 40).cast("float"))
    ids.select(F.col("id").alias("vec_id"), F.lit(1).alias("label"), vector.alias("embedding")).write.parquet(f"{folder}/embeddings.parquet")
    return folder


def by_sql(folder, name):
    db = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    return db.execute(queries.ORACLE_SQL[name]).fetchall()


def test_tagged_vectors_are_all_ranked(spark, many):
    wanted = sorted(by_sql(many, "semantic_with_tags"))
    found = sorted(map(tuple, queries.QUERIES["semantic_with_tags"](spark, many).collect()))
    assert len(wanted) > 5000 and [r[0] for r in found] == [r[0] for r in wanted]
    assert all(abs(a[1] - b[1]) < 1e-5 for a, b in zip(found, wanted, strict=True))


def test_limited_search_ranks_all_hits(spark, many):
    """8,000 chunks with the term and 12,000 vectors: the best by both stand outside the lanes' caps."""
    capped = [r[0] for r in queries.QUERIES["hybrid_search"](spark, many).collect()][:3]
    wanted, found = by_sql(many, "search_limit"), [tuple(r) for r in queries.QUERIES["search_limit"](spark, many).collect()]
    assert len(wanted) == 3 and [r[0] for r in found] == [r[0] for r in wanted] and [r[0] for r in wanted] != capped
    assert all(abs(a - b) < 1e-5 for x, y in zip(found, wanted, strict=True) for a, b in zip(x[1:4], y[1:4], strict=True) if b is not None)
