"""Vectorised hashing of the words of Arrow text columns.

Words are hashed straight from the UTF-8 buffer of a record batch: each byte goes through a
table of random 64-bit values (0 marks a separator), the values are weighted by powers of an
odd constant modulo 2**64, and each word's sum is divided by the power of its first byte.
Equal words so get equal hashes wherever they stand, and no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
SLICE_BYTES = 1 << 20


def fmix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


@lru_cache(maxsize=4)
def byte_table(kind: str) -> np.ndarray:
    """``space``: words are runs without ASCII white space; ``alnum``: runs of ASCII letters,
    digits and bytes above 127. A-Z count as a-z in both."""
    table = fmix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
    table[65:91] = table[97:123]
    table[[9, 10, 11, 12, 13, 32]] = 0
    if kind == "alnum":
        table[[b for b in range(128) if not chr(b).isalnum()]] = 0
    return table


_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        size = max(n, SLICE_BYTES)
        held = np.full(size, base, dtype=U64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        _powers[base] = held
    return held[:n]


def hash_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and byte starts of all words of the texts ``data[offsets[i]:offsets[i + 1]]``, and
    for each text the index of its first word (one entry more than there are texts)."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    values = table[data[lo:hi]]
    inside = values != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = offsets[(offsets > lo) & (offsets < hi)] - lo
    begins[cut] = inside[cut]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets - lo)
    if not len(starts):
        return np.empty(0, U64), starts, first
    values *= powers(len(values), _BASE)
    sums = np.add.reduceat(values, starts) * powers(len(values), _INVERSE)[starts]
    return fmix(sums), starts + lo, first


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the offsets of a text column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None and held.size else np.empty(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        j = min(j, n)
        yield i, j
        i = j


def words_of(column: pa.Array, kind: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, end, hashes, byte starts, first word of each text, bytes) slice by slice."""
    data, offsets = text_buffers(column)
    table = byte_table(kind)
    for i, j in slices(offsets):
        hashes, starts, first = hash_words(data, offsets[i : j + 1], table)
        yield i, j, hashes, starts, first, data


class SlotCounts:
    """Counts by hash slot over a partition, shipped as blocks so that they add up by key."""

    BLOCK = 1 << 14

    def __init__(self, sizes: dict[str, int]):
        self.counts = {name: np.zeros(size, np.int64) for name, size in sizes.items()}

    def add(self, name: str, hashes: np.ndarray) -> None:
        held = self.counts[name]
        held += np.bincount((hashes & U64(len(held) - 1)).astype(np.int64), minlength=len(held))

    def blocks(self) -> Iterator[tuple[str, bytes]]:
        for name, held in self.counts.items():
            for k in range(0, len(held), self.BLOCK):
                if (part := held[k : k + self.BLOCK]).any():
                    yield f"{name}/{k}", part.tobytes()


def summed_blocks(df, sizes: dict[str, int]) -> dict[str, np.ndarray]:
    """Adds up the blocks (columns ``block`` and ``counts``) of all partitions. What comes to the
    driver has the fixed size of the slots, however large the input is."""

    def add(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(counts.as_buffer(), np.int64)
                held[name] = held[name] + part if name in held else part.copy()
        yield pa.RecordBatch.from_pydict({"block": pa.array(held.keys(), pa.string()), "counts": pa.array([x.tobytes() for x in held.values()], pa.binary())})

    totals = {name: np.zeros(size, np.int64) for name, size in sizes.items()}
    rows = df.select("block", "counts").repartition("block").mapInArrow(add, "block string, counts binary").collect()
    for block, counts in rows:
        name, at = block.rsplit("/", 1)
        part = np.frombuffer(bytes(counts), np.int64)
        totals[name][int(at) : int(at) + len(part)] = part
    return totals


class IdBitmap:
    """A set of 64-bit ids with false positives and no false negatives, of a fixed size."""

    BITS, BLOCK = 1 << 26, 1 << 17

    def __init__(self, packed: np.ndarray):
        self.packed = packed

    @classmethod
    def places(cls, ids: np.ndarray) -> np.ndarray:
        return (fmix(ids.astype(np.int64).view(U64)) & U64(cls.BITS - 1)).astype(np.int64)

    def holds(self, ids: np.ndarray) -> np.ndarray:
        at = self.places(ids)
        return (self.packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    @classmethod
    def of(cls, df, column: str) -> IdBitmap:
        """Of all ids of a column. Partitions send the blocks of bits that they set, which are
        or-ed by key before they come to the driver: 8 MB together at most."""

        def pack(held: dict[int, np.ndarray]):
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["block", "bits"])

        def mark(batches):
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                at = np.sort(cls.places(batch.column(0).drop_null().to_numpy()))
                for block in np.unique(at // cls.BLOCK).tolist():
                    mine = at[np.searchsorted(at, block * cls.BLOCK) : np.searchsorted(at, (block + 1) * cls.BLOCK)] - block * cls.BLOCK
                    bits = held.setdefault(block, np.zeros(cls.BLOCK // 8, np.uint8))
                    np.bitwise_or.at(bits, mine >> 3, (1 << (mine & 7)).astype(np.uint8))
            yield pack(held)

        def merge(batches):
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for block, bits in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    part = np.frombuffer(bits.as_buffer(), np.uint8)
                    held[block] = held[block] | part if block in held else part
            yield pack(held)

        packed = np.zeros(cls.BITS // 8, np.uint8)
        schema = "block int, bits binary"
        for block, bits in df.select(column).mapInArrow(mark, schema).repartition("block").mapInArrow(merge, schema).collect():
            packed[block * cls.BLOCK // 8 : (block + 1) * cls.BLOCK // 8] = np.frombuffer(bytes(bits), np.uint8)
        return cls(packed)
