"""Benchmark decontamination by latent semantic retrieval.

1. The number of documents that hold each word (hashed) gives TF-IDF weights; no word's weight is 0.
2. Two randomised SVDs, their products summed over partitions, give a latent space over the
   benchmark's words: it keeps the directions of the benchmark's TF-IDF passages and damps the
   ``COMMON`` strongest ones of all passages of the documents, which tell languages and subjects
   rather than items. Words outside it count in a passage's norm only.
3. Every document is cut into passages of two blocks of ``BLOCK`` words that overlap by one, each is
   folded into the space, and the items with a cosine of ``LEAST_COSINE`` are candidates, less for
   items of which the space keeps a part only.
4. Beside it an exact lookup makes candidates: ``VERBATIM`` of an item's words in order within its
   length and a quarter (and ``BLOCK`` words at least) hold a known number of its rarest words, and
   all places with so many of them are taken.
5. A candidate counts if the longest common subsequence of item and passage is long enough: at once
   from ``VERBATIM`` of the item's words; from ``PARAPHRASE`` on, if the item's answer is there too:
   all words of its answer column, or else half of its distinct words of median weight or more. An
   item of fewer than ``SHORT_WORDS`` words must stand there as one unbroken run, and near it all words
   of its answer column, if there is one.

Items are taken in groups of ``GROUP_WORDS`` words and ``GROUP_SLOTS`` distinct ones, so that what goes
to every task is bounded: 70 MB of the basis (twice as much, in parts, through the driver) and the
items' own words and vectors. The documents are read once for the counts, once for their directions
and once for each group.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.storage import discard, written
from corpusloom.llm.wordhash import U64, SlotCounts, byte_table, fmix, hash_words, slices, summed_blocks, text_buffers, words_of

SLOTS = 1 << 17
BLOCK = 16
PART = 4 * BLOCK
#: The rank follows the items: as many dimensions as keep ``ENERGY`` of their vectors.
MOST_RANK, ENERGY, EXTRA, TURNS = 512, 0.95, 16, 2
#: Directions of the documents' passages to damp, found by a sketch of ``COMMON + EXTRA``. They are
#: not left out, since a passage that a third of all documents share is one of them.
COMMON, DAMPED = 32, 0.3
LEAST_COSINE, LEAST_SHARE = 0.25, 0.1
VERBATIM, PARAPHRASE = 0.8, 0.55
SHORT_WORDS = 5
#: Parts of items compared with passages at once, and blocks of passages folded in at once.
ITEM_BATCH, FOLD_BATCH = 1024, 2048
#: Words of items sent to the tasks at once, and distinct ones among them.
GROUP_WORDS, GROUP_SLOTS = 1_000_000, 1 << 15


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many documents the words of each slot stand, and the number of documents."""

    def run(batches):
        counts, n = SlotCounts({"words": SLOTS}), 0
        for batch in batches:
            n += batch.num_rows
            for i, j, hashes, _, first, _ in words_of(batch.column(0), "alnum"):
                of = np.repeat(np.arange(j - i, dtype=np.int64), np.diff(first))
                counts.add("words", np.unique(of * SLOTS + (hashes & U64(SLOTS - 1)).astype(np.int64)).view(U64))
        rows = [*counts.blocks(), ("n/0", np.array([n], np.int64).tobytes())]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["block", "counts"])

    blocks = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(run, "block string, counts binary")
    totals = summed_blocks(blocks, {"words": SLOTS, "n": 1})
    return totals["words"], int(totals["n"][0])


def idf_weights(df: np.ndarray, n: int) -> np.ndarray:
    """ln(N / df), smoothed so that a word of all documents keeps a weight above 0."""
    return np.log((n + 1) / (df + 0.5)).astype(np.float32)


def _tfidf(hashes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    slots, times = np.unique((hashes & U64(SLOTS - 1)).astype(np.int64), return_counts=True)
    weights = times * idf[slots]
    norm = float(np.sqrt((weights**2).sum()))
    return slots, weights / norm if norm else weights


def parts(hashes: np.ndarray) -> list[np.ndarray]:
    """An item's words in parts of ``PART`` words that overlap by half, so that a long item is
    retrieved by passages of a size with those of the documents."""
    return [hashes[k : k + PART] for k in range(0, max(len(hashes) - PART // 2, 1), PART // 2)]


def blocks_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the blocks of ``BLOCK`` words of all texts, and whether the next block is of
    the same text."""
    blocks = -(-np.diff(first) // BLOCK)
    owner = np.repeat(np.arange(len(blocks)), blocks)
    begins = np.repeat(first[:-1], blocks) + BLOCK * (np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    pair = np.zeros(len(owner), bool)
    pair[:-1] = owner[1:] == owner[:-1]
    return begins, pair


def folded(rows: np.ndarray, place: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of the rows at the places of each block's words; the last row is empty and stands for
    words outside."""
    ends = np.append(begins[1:], len(place))
    sums = np.empty((len(begins), rows.shape[1]), np.float32)
    none = len(rows) - 1
    for k in range(0, len(begins), FOLD_BATCH):
        lo, hi = begins[k : k + FOLD_BATCH], ends[k : k + FOLD_BATCH]
        at = lo[:, None] + np.arange(BLOCK)
        held = np.where(at < hi[:, None], place[np.minimum(at, len(place) - 1)], none)
        held.sort(axis=1)  # words outside come last
        total = rows[held[:, 0]]
        for j in range(1, BLOCK):
            if not (live := np.flatnonzero(held[:, j] != none)).size:
                break
            if len(live) == len(held):
                total += rows[held[:, j]]
            else:
                total[live] += rows[held[live, j]]
        sums[k : k + FOLD_BATCH] = total
    return sums


def random_rows(slots: np.ndarray, width: int) -> np.ndarray:
    """``width`` numbers in -1..1 for each slot, the same in all tasks."""
    grid = fmix((slots.astype(U64)[:, None] << U64(12)) + np.arange(width, dtype=U64)[None, :])
    return (grid >> U64(11)).astype(np.float64) / 2**52 - 1


def latent_space(items: DataFrame, idf: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots, basis): right singular vectors of the TF-IDF matrix of the items' ``count`` parts by subspace iteration on
    a random start. Each turn sums A^T (A Q) over partitions; the vocabulary's slots bound what
    comes to the driver."""
    spark = items.sparkSession
    width = min(count, MOST_RANK) + EXTRA
    shared_idf = spark.sparkContext.broadcast(idf)

    def product(basis) -> tuple[np.ndarray, np.ndarray]:
        def run(batches):
            held: dict[int, np.ndarray] = {}
            table = basis.value if basis is not None else None
            for batch in batches:
                for i, j, hashes, _, first, _ in words_of(batch.column(0), "alnum"):
                    for k in range(j - i):
                        for part in parts(hashes[first[k] : first[k + 1]]):
                            slots, weights = _tfidf(part, shared_idf.value)
                            rows = random_rows(slots, width) if table is None else table[1][np.searchsorted(table[0], slots)]
                            y = weights @ rows
                            for s, w in zip(slots.tolist(), weights, strict=True):
                                held[s] = held[s] + w * y if s in held else w * y
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["slot", "row"])

        def add(batches):
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for s, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    x = np.frombuffer(row.as_buffer(), np.float64)
                    held[s] = held[s] + x if s in held else x
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["slot", "row"])

        schema = "slot int, row binary"
        got = items.select("text").mapInArrow(run, schema).repartition("slot").mapInArrow(add, schema).toArrow()
        slots = got.column("slot").to_numpy().astype(np.int64)
        order = np.argsort(slots)
        rows = got.column("row").to_pylist()
        matrix = np.array([np.frombuffer(rows[k], np.float64) for k in order]).reshape(len(slots), width)
        return slots[order], matrix

    slots, matrix = product(None)
    if not len(slots):
        return slots, np.empty((0, 1), np.float32)
    for turn in range(TURNS):
        q = np.linalg.qr(matrix)[0]
        if q.shape[1] < width:
            q = np.hstack([q, np.zeros((len(q), width - q.shape[1]))])
        _, matrix = product(spark.sparkContext.broadcast((slots, q)))
    u, values, _ = np.linalg.svd(q.T @ matrix)
    keep = values > 1e-9 * max(values.max(), 1e-30)
    rank = min(int(np.searchsorted(np.cumsum(values), ENERGY * count)) + 1, MOST_RANK)
    return slots, (q @ u[:, : len(values)][:, keep])[:, :rank].astype(np.float32)


def item_slots(items: DataFrame) -> np.ndarray:
    """The slots of the words of all items: ``SLOTS`` at most come to the driver."""

    def run(batches):
        for batch in batches:
            for _, _, hashes, _, _, _ in words_of(batch.column(0), "alnum"):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique((hashes & U64(SLOTS - 1)).astype(np.int64)), pa.int64())], ["slot"])

    return np.sort(items.select("text").mapInArrow(run, "slot long").distinct().toArrow().column("slot").to_numpy())


def common_directions(docs: DataFrame, idf: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The ``COMMON`` first right singular vectors of the TF-IDF matrix A of all passages of the
    documents, over the words of ``slots``, from one pass.

    Tasks sum Y = A^T (A R) for a random R in fixed-point numbers, so that the order of sums does
    not matter; the singular vectors are those of A^T A ~ Y (R^T Y)^-1 Y^T.
    """
    width = COMMON + EXTRA
    start = np.linalg.qr(random_rows(slots, width))[0] if len(slots) >= width else None
    if start is None:
        return np.zeros((len(slots), 0))
    shared = docs.sparkSession.sparkContext.broadcast((slots, idf, start.astype(np.float32)))
    name, size, unit = "y", len(slots) * width, 1 << 24

    def run(batches):
        slots, idf, start = shared.value
        place = np.full(SLOTS, len(slots))
        place[slots] = np.arange(len(slots))
        rows = np.vstack([start * idf[slots, None], np.zeros((1, width), np.float32)]).astype(np.float32)
        total = np.zeros((len(slots) + 1, width))
        for batch in batches:
            for _, _, hashes, _, first, _ in words_of(batch.column(0), "alnum"):
                held = (hashes & U64(SLOTS - 1)).astype(np.int64)
                begins, pair = blocks_of(first)
                if not len(begins):
                    continue
                weight = idf[held]
                norms = np.add.reduceat(weight * weight, begins)
                sums = folded(rows, place[held], begins)
                after = np.minimum(np.arange(len(begins)) + 1, len(begins) - 1)
                z = (sums + sums[after] * pair[:, None]) / (norms + norms[after] * pair + 1e-30)[:, None]
                z[1:] += z[:-1] * pair[:-1, None]
                inside = np.flatnonzero(place[held] < len(slots))
                inside = inside[np.argsort(place[held[inside]], kind="stable")]
                if len(inside):
                    of = np.searchsorted(begins, inside, side="right") - 1
                    mine = place[held[inside]]
                    heads = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
                    total[mine[heads]] += np.add.reduceat(z[of] * weight[inside, None], heads, axis=0)
        counts = SlotCounts({})
        counts.counts[name] = np.round(total[:-1].ravel() * unit).astype(np.int64)
        blocks = list(counts.blocks())
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in blocks], pa.string()), pa.array([r[1] for r in blocks], pa.binary())], ["block", "counts"])

    y = summed_blocks(docs.select("text").mapInArrow(run, "block string, counts binary"), {name: size})[name].reshape(len(slots), width) / unit
    core = start.T @ y
    weights, vectors = np.linalg.eigh((core + core.T) / 2)
    held = weights > 1e-4 * max(weights[-1], 1e-30)
    u = np.linalg.svd(y @ (vectors[:, held] / np.sqrt(weights[held])), full_matrices=False)[0]
    return u[:, :COMMON]


def item_groups(rows, most: int = GROUP_WORDS, most_slots: int = GROUP_SLOTS, least_words: int = 1):
    """The items that have ``least_words`` words, as lists of (id, text, word hashes, answer) of ``most``
    words and ``most_slots`` distinct ones together; one larger item stands alone."""
    held, size, slots = [], 0, set()
    for item_id, text, answer in rows:
        hashes = hash_words(*text_buffers(pa.array([text or ""], pa.large_string())), byte_table("alnum"))[0]
        if len(hashes) < max(1, least_words):
            continue
        mine = set((hashes & U64(SLOTS - 1)).tolist())
        if held and (size + len(hashes) > most or len(slots | mine) > most_slots):
            yield held
            held, size, slots = [], 0, set()
        held.append((item_id, text, hashes, answer))
        size += len(hashes)
        slots |= mine
    if held:
        yield held


class Items:
    """The benchmark's items: latent vectors, word hashes, answers, rarest words."""

    def __init__(self, rows: list[tuple[int, str, np.ndarray, str | None]], idf: np.ndarray, slots: np.ndarray, basis: np.ndarray):
        self.ids, self.words, self.answers, vectors = [], [], [], []
        rare: list[np.ndarray] = []
        needed, reach, raw = [], [], []
        of: list[int] = []
        for item_id, _, hashes, answer in rows:
            for part in parts(hashes):
                held, weights = _tfidf(part, idf)
                vectors.append(weights @ basis[np.searchsorted(slots, held)])
                raw.append(np.linalg.norm(np.unique((part & U64(SLOTS - 1)).astype(np.int64), return_counts=True)[1] * idf[held]))
                of.append(len(self.ids))
            weight = idf[(hashes & U64(SLOTS - 1)).astype(np.int64)]
            key = hash_words(*text_buffers(pa.array([answer], pa.large_string())), byte_table("alnum"))[0] if answer else hashes[weight >= np.median(weight)]
            self.ids.append(item_id)
            self.words.append(hashes)
            self.answers.append((set(key.tolist()), 1.0 if answer else 0.5))
            # At most ``spare`` words are missing, so of spare + k words k are there at least.
            spare, k = len(hashes) - math.ceil(VERBATIM * len(hashes) - 1e-9), max(1, len(hashes) // 6)
            rarest = np.argsort(-weight, kind="stable")[: spare + k]
            rare.append(np.unique(hashes[rarest]))
            needed.append(k)
            reach.append(len(hashes) + max(BLOCK, len(hashes) // 4))
        #: The item of each vector.
        self.of = np.array(of, np.int64)
        self.needed, self.reach = np.array(needed, np.int64), np.array(reach, np.int64)
        words = np.concatenate([*rare, np.empty(0, U64)])
        order = np.argsort(words, kind="stable")
        self.rare_items = np.repeat(np.arange(len(rare)), [len(x) for x in rare])[order]
        self.rare_words, self.rare_first, self.rare_count = np.unique(words[order], return_index=True, return_counts=True)
        self.rare_slots = np.zeros(SLOTS, bool)
        self.rare_slots[(words & U64(SLOTS - 1)).astype(np.int64)] = True
        self.vectors = np.array(vectors, np.float32).reshape(len(vectors), basis.shape[1])
        norms = np.linalg.norm(self.vectors, axis=1, keepdims=True)
        self.vectors = np.divide(self.vectors, norms, out=np.zeros_like(self.vectors), where=norms > 0)
        #: An exact copy has the cosine ``norms`` with its item: what the space keeps of it.
        self.least = np.where(norms > 0, LEAST_COSINE * np.minimum(norms, 1), np.inf)[:, 0].astype(np.float32)
        self.share = (LEAST_SHARE * np.array(raw, np.float32) * norms[:, 0]).astype(np.float32)
        self.place = np.full(SLOTS, -1, np.int32)
        self.place[slots] = np.arange(len(slots))
        self.idf = idf
        #: Rows of the basis with their words' weights, and an empty one for words outside.
        self.rows = np.vstack([basis * idf[slots, None], np.zeros((1, basis.shape[1]), np.float32)]).astype(np.float32)
        self._masks: dict[int, dict[int, int]] = {}

    def masks(self, item: int) -> dict[int, int]:
        """For each word of the item, a number with a bit for each of its places."""
        if (held := self._masks.get(item)) is None:
            held = self._masks[item] = places(self.words[item])
        return held


def places(item: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for k, h in enumerate(item.tolist()):
        masks[h] = masks.get(h, 0) | 1 << k
    return masks


def common_subsequence(size: int, masks: list[int]) -> int:
    """Length of the longest common subsequence of an item of ``size`` words and a passage, given
    by the item's places of each of the passage's words; a machine word of places at a time."""
    row = full = (1 << size) - 1
    for m in masks:
        row = ((row + (row & m)) | (row & ~m)) & full
    return size - row.bit_count()


def _passage_hits(items: Items, hashes: np.ndarray, first: np.ndarray):
    """(text, item, cosine, first word) of all candidate passages of a slice."""
    slots = (hashes & U64(SLOTS - 1)).astype(np.int64)
    begins, pair = blocks_of(first)
    if not len(begins):
        return
    place = items.place[slots]
    weight = np.where(place < 0, 0, items.idf[slots])
    norms = np.add.reduceat(weight * weight, begins)
    sums = folded(items.rows, np.where(place < 0, len(items.rows) - 1, place), begins)
    nxt = np.minimum(np.arange(len(begins)) + 1, len(begins) - 1)
    total = sums + sums[nxt] * pair[:, None]
    norm = np.sqrt(norms + norms[nxt] * pair)
    live = np.flatnonzero(norm > 0)
    total = total[live] / norm[live, None]
    for k in range(0, len(items.of), ITEM_BATCH):
        cosines = total @ items.vectors[k : k + ITEM_BATCH].T
        held = cosines >= items.least[k : k + ITEM_BATCH]
        held &= cosines * norm[live, None] >= items.share[k : k + ITEM_BATCH]
        for p, item in zip(*np.nonzero(held), strict=True):
            begin = int(begins[live[p]])
            yield int(np.searchsorted(first, begin, side="right")) - 1, int(items.of[k + item]), float(cosines[p, item]), begin


def _rare_hits(items: Items, hashes: np.ndarray, first: np.ndarray):
    """(text, item, first word) of all blocks near which enough of an item's rarest words stand."""
    at = np.flatnonzero(items.rare_slots[(hashes & U64(SLOTS - 1)).astype(np.int64)])
    if not len(at):
        return
    row = np.minimum(np.searchsorted(items.rare_words, hashes[at]), len(items.rare_words) - 1)
    same = items.rare_words[row] == hashes[at]
    at, row = at[same], row[same]
    times = items.rare_count[row]
    item = items.rare_items[np.repeat(items.rare_first[row] - (np.cumsum(times) - times), times) + np.arange(times.sum())]
    at = np.repeat(at, times)
    order = np.argsort(item, kind="stable")
    item, at = item[order], at[order]
    text = np.searchsorted(first, at, side="right") - 1
    last = np.arange(len(at)) + items.needed[item] - 1
    inside = last < len(at)
    last = np.minimum(last, len(at) - 1)
    inside &= (item[last] == item) & (text[last] == text) & (at[last] - at < items.reach[item])
    text, item, at = text[inside], item[inside], at[inside]
    begin = first[text] + (at - first[text]) // BLOCK * BLOCK
    for t, i, b in np.unique(np.stack([text, item, begin], axis=1), axis=0).tolist():
        yield t, i, b


def _hits(items: Items, hashes: np.ndarray, first: np.ndarray):
    """(text, item, cosine, first word, first word and end of the passage to compare): by latent
    vectors, then by rare words, with the cosine 0 where the space did not find the place."""
    cosines: dict[tuple[int, int], float] = {}
    for text, item, cosine, begin in _passage_hits(items, hashes, first):
        size = len(items.words[item])
        cosines[text, item] = max(cosine, cosines.get((text, item), 0.0))
        yield text, item, cosine, begin, max(int(first[text]), begin - size), min(int(first[text + 1]), begin + 2 * BLOCK + size)
    for text, item, begin in _rare_hits(items, hashes, first):
        reach = int(items.reach[item])
        yield text, item, cosines.get((text, item), 0.0), begin, max(int(first[text]), begin - reach), min(int(first[text + 1]), begin + BLOCK + reach)


FOUND = "doc_id long, item_id long, cosine double, lcs double, kind string, first_word long"


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", answer_col: str | None = None, least_words: int = 1) -> DataFrame:
    """One row for each document and item that it holds, verbatim or in paraphrase: doc_id,
    item_id, cosine, lcs (share of the item's words in common order), kind, first_word.

    All documents are searched for all items, whole texts of any length. Null, empty and wordless
    texts and items match nothing, and neither do items of fewer than ``least_words`` words; items of
    fewer than ``SHORT_WORDS`` count where they stand as an unbroken run, so an item that is one common
    word is held by each text with that word unless ``least_words`` is raised. Repeated rows of one id
    give one row, the best; an empty table gives no rows. Other columns are ignored. The items, not the
    documents, are sent to every task, in groups of a bounded size.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"), answer.alias("answer"))
    df, n = document_frequencies(docs)
    idf = idf_weights(df, n)
    slots = item_slots(items)
    common = common_directions(docs, idf, slots)
    parts_found = []
    for group in item_groups(items.orderBy("item_id", "text").toLocalIterator(), least_words=least_words):
        parts_found.append(written(_found(docs, group, idf, slots, common), "found"))
    if not parts_found:
        return spark.createDataFrame([], FOUND)
    best = F.max(F.struct("lcs", "cosine", "kind", (-F.col("first_word")).alias("w")))
    rows = reduce(DataFrame.unionByName, parts_found).groupBy("doc_id", "item_id").agg(best.alias("x"))
    out = written(rows.select("doc_id", "item_id", "x.cosine", "x.lcs", "x.kind", (-F.col("x.w")).alias("first_word")), "contaminated")
    discard(*parts_found)
    return out


def _judged(items: Items, item: int, passage: np.ndarray) -> tuple[float, str] | None:
    """(share of the item's words in common order, kind) if the passage holds the item."""
    size, find = len(items.words[item]), items.masks(item).get
    if size < SHORT_WORDS:
        run = np.ones(max(len(passage) - size + 1, 0), bool)
        for k, word in enumerate(items.words[item]):
            run &= passage[k : k + len(run)] == word
        key, asked = items.answers[item]
        return (1.0, "verbatim") if run.any() and (asked < 1 or key.issubset(passage.tolist())) else None
    held = [m for h in passage.tolist() if (m := find(h))]
    if len(held) < PARAPHRASE * size:
        return None
    share = common_subsequence(size, held) / size
    if share >= VERBATIM:
        return share, "verbatim"
    key, least = items.answers[item]
    if share < PARAPHRASE or len(key.intersection(passage.tolist())) < least * len(key):
        return None
    return share, "paraphrase"


def _found(docs: DataFrame, group: list[tuple[int, str, np.ndarray, str | None]], idf: np.ndarray, all_slots: np.ndarray, directions: np.ndarray) -> DataFrame:
    """The rows of ``FOUND`` of one group of items; several rows of one id may name one item.
    ``directions`` are those of the documents' passages over ``all_slots``."""
    spark = docs.sparkSession
    texts = spark.createDataFrame([(text,) for _, text, _, _ in group], "text string")
    slots, basis = latent_space(texts, idf, sum(len(parts(hashes)) for _, _, hashes, _ in group))
    common = directions[np.searchsorted(all_slots, slots)]
    basis = (basis - (1 - DAMPED) * common @ (common.T @ basis)).astype(np.float32)
    shared = spark.sparkContext.broadcast(Items(group, idf, slots, basis))

    def run(batches):
        held = shared.value
        for batch in batches:
            best: dict[tuple[int, int], tuple] = {}
            data, offsets = text_buffers(batch.column(1))
            for i, j in slices(offsets, 1 << 19):
                hashes, _, first = hash_words(data, offsets[i : j + 1], byte_table("alnum"))
                for text, item, cosine, begin, lo, hi in _hits(held, hashes, first):
                    if (judged := _judged(held, item, hashes[lo:hi])) is None:
                        continue
                    spot, value = (i + text, item), (judged[0], cosine)
                    if spot not in best or value > best[spot][:2]:
                        best[spot] = (*value, judged[1], begin - int(first[text]))
            rows = [(batch.column(0)[t].as_py(), held.ids[item], c, s, kind, w) for (t, item), (s, c, kind, w) in best.items()]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.int64())
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "cosine", "lcs", "kind", "first_word"])

    return docs.mapInArrow(run, FOUND)


def clean(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents that hold no item; null ids stay."""
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)
