"""Phrase collocation mining with merged count-min sketches and an exact second pass.

The first pass adds every word, pair and triple of words of a language to a sketch of two rows of
saturating counters, one sketch a task; the sketches are merged block by block, and what comes of them
is a bit a counter: whether it reaches the least count. Counters only overestimate, so no phrase that
is frequent has a bit unset. The second pass counts only phrases whose bits, and those of their parts,
are all set: first within a task, then exactly by phrase. Scores and containment follow by joins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.storage import discard, written
from corpusloom.llm.topk import first_k
from corpusloom.llm.wordhash import U64, byte_table, fmix, hash_words, slices, text_buffers

LEAST, TOP, INSIDE_PERCENT = 10, 2000, 50
LONGEST = 3
#: Counters of a row of the sketch: a power of two from the bytes of all texts, between these.
LEAST_BITS, MOST_BITS, BYTES_A_COUNTER = 16, 27, 16
BLOCK = 1 << 18
#: Words that are counted together in a task.
BUFFER_WORDS = 1 << 19
#: Bytes of text for a task, where that makes more tasks than there are cores.
TASK_BYTES = 1 << 31
#: What ends a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
SALT = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)]
COUNT = "lang string, size int, phrase string, f long"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    words, ends = byte_table("space").copy(), np.zeros(256, bool)
    ends[list(PIECE_ENDS)] = True
    words[ends] = 0
    return words, ends


class Words:
    """The words of some texts: hash, bytes from start to end, piece and language of each."""

    def __init__(self, parts: list[tuple], langs: list[str]):
        joined = [np.concatenate([p[k] for p in parts]) for k in range(6)]
        self.data, self.hashes, self.starts, self.ends, self.pieces, self.lang = joined
        self.langs = langs

    def grams(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For 1, 2 and 3 words: the first word of each phrase and its hash, language included."""
        codes = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs], U64)
        at, held = np.arange(len(self.hashes)), fmix(self.hashes + codes[self.lang] * SALT[0])
        out = [(at, held)]
        for size in range(2, LONGEST + 1):
            # a phrase goes on where its next word is in the same piece
            goes = at[at + size - 1 < len(self.hashes)]
            held = held[: len(goes)]
            on = self.pieces[goes] == self.pieces[goes + size - 1]
            at, held = goes[on], held[on]
            held = fmix(held * SALT[1] + self.hashes[at + size - 1] * SALT[2] + U64(size))
            out.append((at, held))
        return out

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        """The phrases of ``size`` words from the words ``at`` on, in lower case, joined by spaces."""
        lengths = [self.ends[at + k] - self.starts[at + k] for k in range(size)]
        total = sum(lengths) + size - 1
        offsets = np.r_[0, np.cumsum(total)]
        out, here = np.full(offsets[-1], 32, np.uint8), offsets[:-1].copy()
        for k, n in enumerate(lengths):
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(here, n) + within] = _LOWER[self.data[np.repeat(self.starts[at + k], n) + within]]
            here += n + 1
        return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)]).cast(pa.string())


def _buffered(batches, most: int) -> Iterator[Words]:
    """The words of all texts (columns lang, text), about ``most`` together."""
    table, piece_end = _tables()
    parts, held, langs, base, size = [], {}, [], 0, 0
    for batch in batches:
        codes = np.empty(len(batch), np.int64)
        for k, lang in enumerate(batch.column("lang").to_pylist()):
            if lang not in held:
                held[lang] = len(langs)
                langs.append(lang)
            codes[k] = held[lang]
        data, offsets = text_buffers(batch.column("text"))
        for i, j in slices(offsets):
            mine = offsets[i : j + 1]
            hashes, starts, first = hash_words(data, mine, table)
            lo, hi = int(mine[0]), int(mine[-1])
            if not len(hashes):
                continue
            own = data[lo:hi]
            inside = table[own] != 0
            last = inside.copy()
            last[:-1] &= ~inside[1:]
            cut = mine[(mine > lo) & (mine < hi)] - lo
            last[cut - 1] = inside[cut - 1]
            doc = np.repeat(np.arange(j - i), np.diff(first))
            # the number of piece ends before a word and of texts: equal only within one piece
            pieces = np.cumsum(piece_end[own])[starts - lo] + doc + base
            base = int(pieces[-1]) + 1
            done = sum(len(p[0]) for p in parts)
            parts.append((own, hashes, starts - lo + done, np.flatnonzero(last) + 1 + done, pieces, codes[i:j][doc]))
            size += len(hashes)
            if size >= most:
                yield Words(parts, langs)
                parts, size = [], 0
    if parts:
        yield Words(parts, langs)


def _slots(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (hashes >> U64(32 * row)).astype(np.uint32) & np.uint32((1 << bits) - 1)


def _sketch(batches, bits: int):
    """One sketch of all that the task has, block by block, as compressed bytes."""
    rows = [np.zeros(1 << bits, np.uint8) for _ in range(2)]
    for words in _buffered(batches, BUFFER_WORDS):
        for _, hashes in words.grams():
            for row, counters in enumerate(rows):
                slots = np.sort(_slots(hashes, row, bits))
                starts = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]]) if len(slots) else np.empty(0, np.int64)
                at = slots[starts]
                counters[at] = np.minimum(counters[at] + np.diff(np.r_[starts, len(slots)]), 255)
    for row, counters in enumerate(rows):
        for k in range(0, len(counters), BLOCK):
            if (part := counters[k : k + BLOCK]).any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([(row << MOST_BITS + 1) + k], pa.int64()), "counts": pa.array([pa.compress(part.tobytes(), "lz4", asbytes=True)], pa.binary())})


def _merged(batches, size: int, least: int):
    """The sum of each block's counters, as a bit for each that reaches ``least``."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts"), strict=True):
            part = np.frombuffer(pa.decompress(counts.as_buffer(), size, "lz4"), np.uint8)
            held[block] = np.minimum(held[block] + part.astype(np.uint16), 255) if block in held else part.astype(np.uint16)
    yield pa.RecordBatch.from_pydict({"block": pa.array(held, pa.int64()), "bits": pa.array([np.packbits(x >= least).tobytes() for x in held.values()], pa.binary())})


class Sketch:
    """Which counters of the merged sketch reach the least count: two rows of bits, 32 MB at most."""

    def __init__(self, docs: DataFrame, bits: int, least: int):
        size = min(BLOCK, 1 << bits)
        parts = docs.mapInArrow(lambda batches: _sketch(batches, bits), "block long, counts binary")
        merged = parts.repartition("block").mapInArrow(lambda batches: _merged(batches, size, least), "block long, bits binary").collect()
        self.bits, self.rows = bits, [np.zeros((1 << bits) // 8, np.uint8) for _ in range(2)]
        for block, part in merged:
            row, at = block >> MOST_BITS + 1, block & ((1 << MOST_BITS + 1) - 1)
            self.rows[row][at // 8 : (at + size) // 8] = np.frombuffer(bytes(part), np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for row, packed in enumerate(self.rows):
            slots = _slots(hashes, row, self.bits)
            found &= (packed[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 1
        return found


def _survivors(batches, sketch: Sketch):
    """Counts of the phrases whose counters, and those of their parts, reach the least count; size 0
    has the number of words of a language."""
    for words in _buffered(batches, BUFFER_WORDS):
        n = np.bincount(words.lang, minlength=len(words.langs))
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"lang": [words.langs[k] for k in seen], "size": pa.array([0] * len(seen), pa.int32()), "phrase": [""] * len(seen), "f": pa.array(n[seen], pa.int64())})
        before = np.ones(len(words.hashes) + 1, bool)
        for size, (at, hashes) in enumerate(words.grams(), 1):
            good = before[at] & (before[at + 1] if size > 1 else True)
            good[good] = sketch.holds(hashes[good])
            before = np.zeros(len(words.hashes) + 1, bool)
            before[at[good]] = True
            _, first, counts = np.unique(hashes[good], return_index=True, return_counts=True)
            starts = at[good][first]
            lang = pa.array(words.langs, pa.string()).take(pa.array(words.lang[starts]))
            yield pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(starts), size), pa.int32()), words.phrases(starts, size), pa.array(counts, pa.int64())], ["lang", "size", "phrase", "f"])


def phrase_counts(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text", bits: int | None = None) -> DataFrame:
    """(lang, size, phrase, f): all phrases of 1 to 3 words with ``least`` occurrences or more, exactly
    counted, and at size 0 all words of each language. A row of the sketch has 2**``bits`` counters, by
    default as the size of all texts asks for."""
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # few tasks: each has one sketch, and sums up its own counts before they are shuffled
    docs = docs.coalesce(max(1, docs.sparkSession.sparkContext.defaultParallelism, total // TASK_BYTES))
    bits = bits or min(MOST_BITS, max(LEAST_BITS, (total // BYTES_A_COUNTER).bit_length()))
    sketch = Sketch(docs, bits, least)
    found = docs.mapInArrow(lambda batches: _survivors(batches, sketch), COUNT)
    return found.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("size") == 0))


def _score(a: Column, left: Column, right: Column) -> Column:
    """Exact for counts below 10**16: products have 38 digits at most, the quotient 7."""
    big = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (big(a) * big(a)), big(left) * big(right))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, lang_col: str = "lang", text_col: str = "text", bits: int | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 or 3 words.

    Null languages are ``und``; null, empty and wordless texts have no phrases, and languages without a
    frequent phrase no rows. Repeated rows count each; other columns are ignored. Texts are read
    whole. Equal scores go by count, then by phrase in the order of UTF-8 bytes. Phrases are told apart
    by 64-bit hashes within 524,288 words of a task, by their letters beyond.
    """
    counts = written(phrase_counts(docs, least, lang_col, text_col, bits), "counts")
    part = lambda size, name, f: counts.where(F.col("size") == size).select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    word = lambda k: F.substring_index("phrase", " ", k)

    two = part(2, "phrase", "a").withColumns({"w1": word(1), "w2": word(-1)})
    two = two.join(part(1, "w1", "l"), ["lang", "w1"]).join(part(1, "w2", "r"), ["lang", "w2"])
    two = two.select("lang", "phrase", "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))

    three = part(3, "phrase", "a").withColumns({"w1": word(1), "p12": word(2), "w3": word(-1)}).withColumn("p23", F.expr("substring(phrase, length(w1) + 2)"))
    inside = three.select("lang", F.explode(F.array("p12", "p23")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("over"))
    for size, name in ((1, "w1"), (2, "p23"), (2, "p12"), (1, "w3")):
        three = three.join(part(size, name, f"f_{name}"), ["lang", name])
    first, second = _score(F.col("a"), F.col("f_w1"), F.col("f_p23")), _score(F.col("a"), F.col("f_p12"), F.col("f_w3"))
    three = three.withColumns({"s1": first, "s2": second}).withColumn("cut", F.col("s1") <= F.col("s2"))
    three = three.select("lang", "phrase", "a", F.when(F.col("cut"), F.col("f_w1")).otherwise(F.col("f_p12")).alias("l"), F.when(F.col("cut"), F.col("f_p23")).otherwise(F.col("f_w3")).alias("r"), F.least("s1", "s2").alias("score"))

    two = two.join(inside, ["lang", "phrase"], "left").where(F.col("over").isNull() | (100 * F.col("over") < INSIDE_PERCENT * F.col("a"))).drop("over")
    best = first_k(two.unionByName(three), ["lang"], [F.desc("score"), F.desc("a"), F.col("phrase")], top, "rank", "phrase")
    best = best.join(part(0, "none", "n").drop("none"), "lang")
    best = written(best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "collocations")
    discard(counts)
    return best
