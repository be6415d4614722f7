"""Vectors as array<float>: cosine, and the little-endian blob codec."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType

from corpusloom.errors import Invariant


def cosine(a: Column, b: Column) -> Column:
    """In doubles; 0 where either norm is 0."""
    d = lambda x: x.cast("double")
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, y: s + y)
    dot = total(F.zip_with(a, b, lambda x, y: d(x) * d(y)))
    norm = F.sqrt(total(F.transform(a, lambda x: d(x) * d(x)))) * F.sqrt(total(F.transform(b, lambda x: d(x) * d(x))))
    return F.when(norm == 0, F.lit(0.0)).otherwise(dot / norm)


def encode_f32(values: list[float]) -> bytes:
    return np.asarray(values, "<f4").tobytes()


def decode_f32(blob: bytes) -> list[float]:
    if len(blob) % 4:
        raise Invariant(f"a vector of {len(blob)} bytes")
    return np.frombuffer(blob, "<f4").tolist()


@F.pandas_udf(ArrayType(FloatType()))
def decode_blobs(blobs: pd.Series) -> pd.Series:
    return blobs.map(lambda b: None if b is None else np.array(decode_f32(b), np.float32))


@F.pandas_udf(BinaryType())
def encode_blobs(vectors: pd.Series) -> pd.Series:
    return vectors.map(lambda v: None if v is None else encode_f32(v))
