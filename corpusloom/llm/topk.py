"""The first rows of each group, with no task that gets a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16


def first_k(rows: DataFrame, group: list[str], order: list[Column], k: int, place: str, salt: str) -> DataFrame:
    """The first k rows of each group with their ``place`` from 1. Every task cuts its rows down to k
    a group and part, then each part, by ``salt``, does, and k rows of each part meet."""
    part = Window.partitionBy(*group, "_part").orderBy(*order)
    parts = rows.withColumn("_part", F.pmod(F.xxhash64(salt), F.lit(SALTS))).withColumn("_place", F.row_number().over(part)).where(F.col("_place") <= k)
    return parts.drop("_part", "_place").withColumn(place, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(place) <= k)
