"""Exact nearest vectors without reading them all.

Vectors are taken at length 1, where the cosine follows from the distance. Centres are fitted on a
bounded sample; every vector then goes to its nearest centre with its distance from it, into a table
with a folder for each model and centre. A search reads the centres nearest to the query until they
hold k vectors; the k-th best distance is a bound, and by the triangle inequality a vector can only beat
it if its distance from its centre differs from the query's by no more. Centres that are too far off
for all of their vectors are not read at all. Results equal those of a scan.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.vectors import cosine
from corpusloom.storage import shared_dir

#: Vectors that the centres are fitted on at most, centres, rounds of fitting.
SAMPLE_ROWS, CENTRES, ROUNDS = 20_000, 64, 8
#: What rounding may add to a distance.
SLACK = 1e-5
#: Vectors of length 0, which have the cosine 0 with everything, are always read.
NOWHERE = -1


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each vector, and the distance."""
    far = np.maximum((vectors**2).sum(1)[:, None] - 2 * vectors @ centres.T + (centres**2).sum(1)[None, :], 0)
    best = far.argmin(1)
    return best, np.linalg.norm(vectors - centres[best], axis=1)


def fit_centres(embeddings: DataFrame, dimension: int, count: int = CENTRES) -> np.ndarray:
    """Centres of at most ``SAMPLE_ROWS`` vectors, picked by the hash of their ids."""
    sample = embeddings.where(F.size("embedding") == dimension).orderBy(F.xxhash64("chunk_id", "model_tag"), "chunk_id", "model_tag").limit(SAMPLE_ROWS)
    rows = [r[0] for r in sample.select("embedding").collect()]
    vectors = _unit(np.array(rows, np.float64).reshape(len(rows), dimension))
    vectors = vectors[np.linalg.norm(vectors, axis=1) > 0]
    if not len(vectors):
        return np.zeros((1, dimension))
    centres = vectors[np.linspace(0, len(vectors) - 1, min(count, len(vectors))).astype(int)]
    for _ in range(ROUNDS):
        best, _ = _nearest(vectors, centres)
        n = np.bincount(best, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, best, vectors)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


class VectorIndex:
    """All vectors (chunk_id, model_tag, embedding) of one dimension, by centre."""

    def __init__(self, embeddings: DataFrame, dimension: int, count: int = CENTRES):
        """Vectors of other dimensions, and null ones, are left out, as in a scan. Rows of one id and
        model each count."""
        spark, self.dimension = embeddings.sparkSession, dimension
        rows = embeddings.where(F.size("embedding") == dimension).select("chunk_id", "model_tag", "embedding")
        self.centres = centres = fit_centres(rows, dimension, count)

        def assign(batches):
            for batch in batches:
                flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                own = _unit(flat.reshape(len(batch), dimension))
                best, far = _nearest(own, centres)
                best[np.linalg.norm(own, axis=1) == 0] = NOWHERE
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.int32()), pa.array(far)], [*batch.schema.names, "centre", "far"])

        schema = "chunk_id string, model_tag string, embedding array<float>, centre int, far double"
        self.folder = shared_dir(spark)
        rows.mapInArrow(assign, schema).repartition("model_tag", "centre", F.pmod(F.xxhash64("chunk_id"), F.lit(8))).write.partitionBy("model_tag", "centre").parquet(f"{self.folder}/vectors")
        self.rows = spark.read.schema(schema).parquet(f"{self.folder}/vectors")
        stats = self.rows.groupBy("model_tag", "centre").agg(F.count("*").alias("n"), F.min("far").alias("low"), F.max("far").alias("high"))
        #: One row for each model and centre.
        self.stats = stats.collect()
        #: Centres that the last search read and did not read.
        self.read, self.skipped = 0, 0

    def top(self, vector: list[float], model_tag: str, k: int, ties: bool = False) -> DataFrame:
        """(chunk_id, cosine) of the k vectors of the model with the highest cosine, equal ones by
        ascending id: the rows that a scan gives. With ``ties`` all that equal the k-th come too."""
        spark = self.rows.sparkSession
        held = [s for s in self.stats if s.model_tag == model_tag]
        if len(vector) != self.dimension or not held or k < 1:
            return spark.createDataFrame([], "chunk_id string, cosine double")
        query = _unit(np.array([vector], np.float64))[0]
        away = {s.centre: 0.0 if s.centre == NOWHERE else float(np.linalg.norm(self.centres[s.centre] - query)) for s in held}
        near, found = [], 0
        for s in sorted(held, key=lambda s: away[s.centre]):
            if found < k:
                near.append(s.centre)
                found += s.n
        wanted = F.array(*(F.lit(float(v)) for v in vector)).cast("array<float>")
        mine = self.rows.where(F.col("model_tag") == model_tag)
        scored = lambda rows: rows.select("chunk_id", cosine(F.col("embedding"), wanted).alias("cosine")).orderBy(F.desc("cosine"), "chunk_id").limit(k)
        first = scored(mine.where(F.col("centre").isin(near))).agg(F.count("*"), F.min("cosine")).first()
        # vectors of length 1 with the cosine c are sqrt(2 - 2c) apart; the zero query has no direction
        bound = float("inf") if first[0] < k or not query.any() else float(np.sqrt(max(0.0, 2 - 2 * first[1]))) + SLACK
        live = [s.centre for s in held if s.centre == NOWHERE or s.low - bound <= away[s.centre] <= s.high + bound]
        self.read, self.skipped = len(live), len(held) - len(live)
        gap = F.element_at(F.create_map(*(F.lit(x) for c in live for x in (c, away[c]))), F.col("centre")) - F.col("far")
        rows = mine.where(F.col("centre").isin(live))
        if ties and first[0] == k:
            least = scored(rows).agg(F.min("cosine").alias("least"))
            return rows.select("chunk_id", cosine(F.col("embedding"), wanted).alias("cosine")).join(F.broadcast(least), F.col("cosine") >= F.col("least")).drop("least")
        return scored(rows if bound == float("inf") else rows.where((F.col("centre") == NOWHERE) | (F.abs(gap) <= bound)))
