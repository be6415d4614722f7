"""Replay of the append-only governance log: known ids, rejections, hashes and skip sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.errors import Invariant
from corpusloom.operators.ingest import rights_allowed
from corpusloom.schemas import DEFAULT_RIGHTS


#: Names of a registry that stand in the plan itself.
FEW = 64


def _by_cases(publishers: list[str]) -> Column:
    none = F.lit(None).cast("string")
    found = none
    for p in sorted(publishers, key=len):
        found = F.when(F.startswith("episode_id", F.lit(f"{p}_")), F.lit(p)).otherwise(found)
    return F.coalesce(F.when(F.col("publisher_id").isin(publishers), F.col("publisher_id")) if publishers else none, found)


def attributed(log: DataFrame, publishers: Sequence[str] | DataFrame) -> DataFrame:
    """The log with ``publisher``: its own publisher_id if registered, else the longest registered
    id that starts the episode id, followed by an underscore; else null.

    ``publishers`` is a list or a table with the column publisher_id, of any size. A list of
    ``FEW`` names stands in the plan. Otherwise each episode id is cut at each of its underscores, at
    lengths that registered ids have, and the cuts meet the registry by equality: the work grows with
    the underscores of an id, not with the registry.
    """
    spark = log.sparkSession
    if not isinstance(publishers, DataFrame) and len(publishers) <= FEW:
        return log.withColumn("publisher", _by_cases(list(publishers)))
    table = publishers if isinstance(publishers, DataFrame) else spark.createDataFrame([(p,) for p in publishers], "publisher_id string")
    known = table.select("publisher_id").where("publisher_id is not null").distinct()
    lengths = F.broadcast(known.agg(F.collect_set(F.length("publisher_id")).alias("_lengths")))  # as many as an id has characters
    own = [c for c in log.columns if c != "publisher"]
    ids = log.select("episode_id", "publisher_id").distinct()
    size = F.coalesce(F.length("episode_id"), F.lit(0))
    cut = lambda i: (F.substring("episode_id", i + 1, F.lit(1)) == "_") & F.array_contains("_lengths", i)
    places = F.filter(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), cut)
    cuts = F.transform(places, lambda i: F.struct((-i).alias("rank"), F.substring("episode_id", F.lit(1), i).alias("cut")))
    first = F.array(F.struct(F.lit(-(1 << 30)).alias("rank"), F.col("publisher_id").alias("cut")))
    tries = ids.crossJoin(lengths).select("episode_id", "publisher_id", F.explode(F.concat(first, cuts)).alias("x")).select("episode_id", "publisher_id", "x.*")
    found = tries.join(known.select(F.col("publisher_id").alias("cut")), "cut").groupBy("episode_id", "publisher_id").agg(F.min_by("cut", "rank").alias("publisher"))
    named = found.select(F.col("episode_id").alias("_e"), F.col("publisher_id").alias("_p"), "publisher")
    return log.select(own).join(named, F.col("episode_id").eqNullSafe(F.col("_e")) & F.col("publisher_id").eqNullSafe(F.col("_p")), "left").drop("_e", "_p")


def still_rejected(log: DataFrame, allow: Sequence[str] = DEFAULT_RIGHTS) -> DataFrame:
    """Deprecated rows whose own code is outside the list as it is now."""
    return log.where(F.coalesce("deprecated", F.lit(False)) & ~rights_allowed(F.col("rights_code"), allow))


def admitted_ids(log: DataFrame) -> DataFrame:
    return log.where("publisher is not null and not coalesce(deprecated, false)").select("publisher", "episode_id").distinct()


def rejected_ids(log: DataFrame, allow: Sequence[str] = DEFAULT_RIGHTS) -> DataFrame:
    return still_rejected(log, allow).where("publisher is not null").select("publisher", "episode_id").distinct()


def known_ids(log: DataFrame, allow: Sequence[str] = DEFAULT_RIGHTS) -> DataFrame:
    return admitted_ids(log).unionByName(rejected_ids(log, allow)).distinct()


def seen_hashes(log: DataFrame) -> DataFrame:
    """Hashes of admitted rows, of unregistered publishers too."""
    return log.where("not coalesce(deprecated, false) and content_hash != ''").select("content_hash").distinct()


def skip_set(log: DataFrame, incremental: bool, allow: Sequence[str] = DEFAULT_RIGHTS) -> DataFrame:
    """Episodes not to fetch: those still rejected, and in incremental runs all that are known."""
    return known_ids(log, allow) if incremental else rejected_ids(log, allow)


def require_subset(part: DataFrame, whole: DataFrame) -> None:
    if bad := part.join(whole, part.columns, "left_anti").head(1):
        raise Invariant(f"{bad[0]} is rejected but not known")


def current_status(log: DataFrame, order: str = "ingestion_date") -> DataFrame:
    return log.groupBy("episode_id").agg(F.max_by("deprecated", order).alias("deprecated"), F.count("*").alias("events"))
