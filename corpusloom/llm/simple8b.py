"""Simple-8b coding of unsigned integers in 64-bit words, encoded and decoded with numpy.

The top four bits of a word select how many values of which width the other sixty hold; the last
selector is an escape: the next word holds one value of more than sixty bits. Values are coded in
blocks of ``BLOCK``; a table gives each block's first word, so any block is decoded alone.
"""

from __future__ import annotations

import struct

import numpy as np

#: Fixed values of the code: selector by place, (values in a word, bits of each).
SELECTORS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
BLOCK = 1 << 14
MAGIC = b"CLS8"

_COUNT = np.zeros(16, np.int64)
_COUNT[: len(SELECTORS)] = [c for c, _ in SELECTORS]
_COUNT[ESCAPE] = 1


def encode_words(values: np.ndarray) -> np.ndarray:
    """The words of one run of values, each taking as many values as fit."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64)
    padded = np.concatenate([values, np.full(60, 2**64 - 1, np.uint64)])
    best = np.full(n, ESCAPE, np.uint8)
    most, width = padded if values.max() >= 1 << 32 else np.minimum(padded, 2**32 - 1).astype(np.uint32), 1
    for selector in range(len(SELECTORS) - 1, -1, -1):
        count, bits = SELECTORS[selector]
        while width < count:
            step = min(width, count - width)
            most = np.maximum(most[: len(most) - step], most[step:])
            width += step
        fits = most[:n] < most.dtype.type(min(1 << bits, np.iinfo(most.dtype).max))
        if not fits.any():  # nor do more values in fewer bits
            break
        best[: len(fits)][fits] = selector
    jump, at, i = _COUNT[best].astype(np.uint8).tobytes(), [], 0
    while i < n:
        at.append(i)
        i += jump[i]
    at = np.array(at)
    chosen = best[at]
    place = np.arange(len(at)) + np.concatenate([[0], np.cumsum(chosen == ESCAPE)[:-1]])
    out = np.zeros(len(at) + int((chosen == ESCAPE).sum()), np.uint64)
    for selector in np.unique(chosen):
        mine = chosen == selector
        if selector == ESCAPE:
            out[place[mine]] = np.uint64(ESCAPE << 60)
            out[place[mine] + 1] = values[at[mine]]
            continue
        count, bits = SELECTORS[selector]
        word = np.full(int(mine.sum()), int(selector) << 60, np.uint64)
        for j in range(count):
            word |= padded[at[mine] + j] << np.uint64(j * bits)
        out[place[mine]] = word
    return out


def decode_words(words: np.ndarray) -> np.ndarray:
    chosen = (words >> np.uint64(60)).astype(np.int64)
    escapes = np.flatnonzero(chosen == ESCAPE)
    raw = np.zeros(len(words), bool)
    last = -1
    for e in escapes:
        if e > last:
            raw[e + 1] = True
            last = e + 1
    count = _COUNT[chosen]
    count[raw] = 0
    chosen[raw] = -1
    starts = np.cumsum(count) - count
    out = np.empty(int(count.sum()), np.uint64)
    for selector in np.unique(chosen[chosen >= 0]):
        mine = np.flatnonzero(chosen == selector)
        if selector == ESCAPE:
            out[starts[mine]] = words[mine + 1]
            continue
        count_, bits = SELECTORS[selector]
        mask = np.uint64((1 << bits) - 1)
        for j in range(count_):
            out[starts[mine] + j] = (words[mine] >> np.uint64(j * bits)) & mask
    return out


def encode(values: np.ndarray) -> bytes:
    """magic, number of values, number of blocks, first word of each block, words; little-endian."""
    values = np.asarray(values, np.uint64)
    blocks = [encode_words(values[k : k + BLOCK]) for k in range(0, len(values), BLOCK)]
    firsts = np.cumsum([0, *map(len, blocks)]).astype("<u4")
    return b"".join([MAGIC, struct.pack("<QI", len(values), len(blocks)), firsts.tobytes(), *(x.astype("<u8").tobytes() for x in blocks)])


def decode(payload: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Values ``start`` to ``stop``; reads only the blocks that hold them."""
    if payload[:4] != MAGIC:
        raise ValueError("not a Simple-8b payload")
    n, blocks = struct.unpack_from("<QI", payload, 4)
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.empty(0, np.uint64)
    firsts = np.frombuffer(payload, "<u4", blocks + 1, 16)
    words = np.frombuffer(payload, "<u8", int(firsts[-1]), 16 + 4 * (blocks + 1))
    lo, hi = start // BLOCK, -(-stop // BLOCK)
    return decode_words(words[firsts[lo] : firsts[hi]])[start - lo * BLOCK : stop - lo * BLOCK]
