"""Connected components by alternating large and small stars, and joins that hot keys don't load."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.storage import discard, written

#: Keys that a join sends to all tasks, at most.
HOT_KEYS = 10_000
#: Edges that are closed in one task, at most: 16 MB of ids.
FEW_EDGES = 1_000_000


def join_hot(left: DataFrame, right: DataFrame, key: str, weight: str, total: int, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which has one row a key and in ``weight`` how many of the
    ``total`` rows of ``left`` have it, at least.

    Keys of more than ``total / HOT_KEYS`` rows go to all tasks, ``HOT_KEYS`` of them at most since
    their weights add up to ``total``; all others are shuffled, so no task gets more than its share.
    """
    hot = F.col(weight) > total / HOT_KEYS
    few, rest = right.where(hot).drop(weight), right.where(~hot).drop(weight)
    near = left.join(F.broadcast(few), key)
    far = left.join(F.broadcast(few.select(key)), key, "left_anti").join(rest, key, how)
    return near.unionByName(far)


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Links each node's larger neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("rows"))
    return join_hot(both.where("b > a"), least, "a", "rows", 2 * total).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("rows"))
    rest = join_hot(edges, least, "a", "rows", total).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _unfinished(edges: DataFrame) -> bool:
    """Whether a node has two edges to smaller ones, or one to a node that has such an edge too."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return bool(seen.where("ups > 1 or ups = 1 and least = 0").head(1))


def _closed(batches):
    """(node, root) of all edges of a task: roots hook on to smaller ones until none is left to."""
    if not (batches := [b for b in batches if b.num_rows]):
        return
    table = pa.Table.from_batches(batches)
    nodes, place = np.unique(np.concatenate([table.column(c).to_numpy() for c in ("a", "b")]), return_inverse=True)
    x, y = place[: table.num_rows], place[table.num_rows :]
    root = np.arange(len(nodes))
    while len(x):
        up, down = np.maximum(root[x], root[y]), np.minimum(root[x], root[y])
        np.minimum.at(root, up, down)
        while (root[root] != root).any():
            root = root[root]
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], ["node", "root"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node that it reaches.

    Up to ``FEW_EDGES`` edges are closed in one task. More go by rounds, each of which halves the depth
    of the stars at least; its edges are written to the shared folder, so a lost executor costs one round;
    a round's table goes once the next is written, and no round is needed for edges that are stars already.
    Self-links and nulls are left out.
    """
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct()
    edges = written(edges, "edges")
    if edges.count() <= FEW_EDGES:
        found = written(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).repartition(1).mapInArrow(_closed, "node long, root long"), "closed")
        discard(edges)
        return found
    while _unfinished(edges):
        total = edges.count()
        larger = written(_large_star(edges, total).distinct(), "stars")
        discard(edges)
        edges = written(_small_star(larger, larger.count()), "edges")
        discard(larger)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
