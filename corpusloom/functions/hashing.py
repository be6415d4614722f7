"""BLAKE3-256, which Spark has no function for, over whole batches at once, and strict hex."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.errors import InvalidArgument

#: Fixed values of the hash: initial words, order of message words, flags, sizes.
IV = (0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19)
PERMUTATION = (2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8)
CHUNK_START, CHUNK_END, PARENT, ROOT = 1, 2, 4, 8
BLOCK_BYTES, CHUNK_BYTES = 64, 1024
#: Chunks hashed at once.
LANES = 8192
_U = np.uint32


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return x >> _U(by) | x << _U(32 - by)


def _compress(cv: np.ndarray, m: np.ndarray, counter: np.ndarray, length: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """One compression for each column of ``cv`` (8 words) and ``m`` (16 words)."""
    n = cv.shape[1]
    v = np.empty((16, n), _U)
    v[:8] = cv
    v[8:12] = np.array(IV[:4], _U)[:, None]
    v[12], v[13] = counter & 0xFFFFFFFF, counter >> 32
    v[14], v[15] = length, flags
    order = np.arange(16)
    columns, diagonals = [np.arange(4) + 4 * k for k in range(4)], [np.roll(np.arange(4), -k) + 4 * k for k in range(4)]
    for _ in range(7):
        for half, (a, b, c, d) in enumerate((columns, diagonals)):
            for part, (r1, r2) in enumerate(((16, 12), (8, 7))):
                word = m[order[8 * half + part : 8 * half + 8 : 2]]
                va, vb, vc, vd = v[a], v[b], v[c], v[d]
                va += vb
                va += word
                vd = _turned(vd ^ va, r1)
                vc += vd
                v[a], v[d], v[c], v[b] = va, vd, vc, _turned(vb ^ vc, r2)
        order = order[list(PERMUTATION)]
    return v[:8] ^ v[8:]


def _chunk_values(data: bytes, sizes: np.ndarray, counters: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Chaining values of chunks that stand in ``data`` one after the other; ``alone``: the chunk is
    a whole text."""
    n = len(sizes)
    held = np.zeros((n, CHUNK_BYTES), np.uint8)
    held[np.arange(CHUNK_BYTES)[None, :] < sizes[:, None]] = np.frombuffer(data, np.uint8)
    words = held.view("<u4").reshape(n, 16, 16)
    blocks = np.maximum(1, -(-sizes // BLOCK_BYTES))
    cv = np.repeat(np.array(IV, _U)[:, None], n, axis=1)
    for k in range(int(blocks.max())):
        live = np.flatnonzero(blocks > k)
        last = blocks[live] == k + 1
        length = np.where(last, sizes[live] - BLOCK_BYTES * k, BLOCK_BYTES)
        flags = CHUNK_START * (k == 0) + CHUNK_END * last + ROOT * (last & alone[live])
        cv[:, live] = _compress(cv[:, live], words[live, k].T.astype(_U), counters[live], length, flags)
    return cv


def blake3_many(texts: list[bytes]) -> list[str]:
    """The hashes of all texts, in hex. All chunks are hashed side by side, then the trees above
    them level by level: neighbours pair up, an odd last one waits for the next level."""
    if not texts:
        return []
    chunks = np.maximum(1, -(-np.array([len(t) for t in texts]) // CHUNK_BYTES))
    owner = np.repeat(np.arange(len(texts)), chunks)
    counters = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    sizes = np.minimum(CHUNK_BYTES, np.array([len(t) for t in texts])[owner] - CHUNK_BYTES * counters)
    alone, data = chunks[owner] == 1, b"".join(texts)
    ends = np.cumsum(sizes)
    values = [
        _chunk_values(data[int(ends[k] - sizes[k]) : int(ends[min(k + LANES, len(owner)) - 1])], sizes[k : k + LANES], counters[k : k + LANES], alone[k : k + LANES])
        for k in range(0, len(owner), LANES)
    ]
    cv = np.concatenate(values, axis=1)
    while len(owner) > len(texts):
        first = np.concatenate([[True], owner[1:] != owner[:-1]])
        starts = np.flatnonzero(first)
        place = np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))
        left = np.flatnonzero((place % 2 == 0) & np.append(~first[1:], False))
        count = np.bincount(owner, minlength=len(texts))[owner[left]]
        zero = np.zeros(len(left), np.int64)
        merged = _compress(np.repeat(np.array(IV, _U)[:, None], len(left), axis=1), np.concatenate([cv[:, left], cv[:, left + 1]]), zero, zero + BLOCK_BYTES, PARENT + ROOT * (count == 2))
        cv[:, left] = merged
        stays = place % 2 == 0
        cv, owner = cv[:, stays], owner[stays]
    return [row.tobytes().hex() for row in np.ascontiguousarray(cv.T.astype("<u4"))]


def blake3_hex(data: bytes) -> str:
    return blake3_many([data])[0]


@F.pandas_udf(StringType())
def _blake3(texts: pd.Series) -> pd.Series:
    held = texts.notna()
    out = pd.Series([None] * len(texts), dtype=object)
    out[held.to_numpy()] = blake3_many([t.encode() for t in texts[held]])
    return out


def content_hash(text: Column | str) -> Column:
    """BLAKE3-256 of the UTF-8 text, in hex. For joins and deduplication use ``dedup_key``."""
    return _blake3(text)


def dedup_key(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def decode_hex(text: str) -> bytes:
    if len(text) % 2 or any(c not in "0123456789abcdefABCDEF" for c in text):
        raise InvalidArgument(f"not hex: {text[:40]!r}")
    return bytes.fromhex(text)
