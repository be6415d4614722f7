"""N-gram Jaccard join with adaptive multi-match prefixes.

The sets are distinct word n-grams, hashed to 64 bits. One pass over the texts gives each set's
size and identity, so that equal sets are one class from there on, and two count sketches of a
fixed size: of words and of n-grams. They order the n-grams from rare to common: first those that
no sketch shows to be frequent, by the product of their words' frequencies. A set of n of which an
overlap of o = ceil(t n) is needed has a prefix of n - o + l n-grams in this order; two sets of
similarity t share l of them at least. l grows with the estimated number of candidates: with the
prefix itself and with how frequent its n-grams are, and a candidate needs as many shared n-grams
as the smaller l of the two.

N-grams with up to ``LIGHT`` sets give candidate pairs; those that share enough n-grams are verified
one by one, with the sets of a small component of pairs brought together, so that each is sent once,
and in large components each set beside its partners. N-grams with more sets, as large groups of near copies
have, only tie their sets together, since their pairs are too many to write down. Ties form blocks
of sets that may be similar; a block is compared inside Python tasks in parts of bounded size, each
of which returns a spanning forest of the links it finds, so a group of m near copies gives m - 1
rows and not m * m. Where the number of links isn't asked for, each part of a block is compared with
one part first, and then only those sets that this left outside the block's largest class, so a group of
near copies costs a multiple of m.

In a large corpus ties also chain sets that have a few common n-grams each and are not alike. So blocks
of many parts are split before they are compared: a set's n-grams are dealt to as many bins that similar
sets, which differ in d n-grams at most, have equal ones among those that every set gives as signatures,
and sets with an equal signature form the new blocks.

The sketch also shows the n-grams that very many sets may hold. Their rows are dealt to parts of a
bounded size by set, each part ties its sets to its first one, and the firsts are tied to each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import connected_components, join_hot
from corpusloom.llm.storage import discard, release, written
from corpusloom.llm.wordhash import U64, IdBitmap, SlotCounts, fmix, summed_blocks, words_of

LIGHT = 32
WORD_SLOTS, GRAM_SLOTS = 1 << 18, 1 << 20
MOST_MATCHES = 32
#: Of a part of a block: sets and n-grams at most, from each side.
PART_SETS, PART_GRAMS = 1024, 1_500_000
#: Blocks of more parts are split by signatures; of how many bins more than it gives a set leaves out the
#: smallest, as a share of those it gives.
WHOLE_PARTS, SPARE = 2, 0.25
#: Sets of a component of candidate pairs that are brought together to verify its pairs.
GROUP_SETS = 64
#: Of an n-gram whose slot stands out by more octaves than this, 2**17 sets, the rows are split by set.
HOT_OCTAVE = 14
#: Kinds of units in the place of a part's second side.
BESIDE, TOGETHER = -1, -2

_MULTIPLIERS = fmix(np.arange(11, 75, dtype=U64)) | U64(1)


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    return -(-n * percent // 100)


def matches_by_size(n: int, percent: int) -> int:
    """l of a set of n by its size alone: longer prefixes meet more sets by chance. Grows with n."""
    least = needed(n, percent)
    return int(min(least, MOST_MATCHES, 1 + (n > 4) + (n - least + 1) // 16))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of a text's word n-grams in order; of fewer words, of the whole sequence."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(k, n)
    total = np.zeros(n - width + 1, U64)
    for j in range(width):
        total += hashes[j : n - width + 1 + j] * _MULTIPLIERS[j]
    return fmix(total + U64(width))


def set_id(distinct: np.ndarray) -> int:
    """A 64-bit identity of a set of n-grams."""
    with np.errstate(over="ignore"):
        return int(fmix(np.array([fmix(distinct ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64) + U64(len(distinct))], U64)).view(np.int64)[0])


def _sets_of(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, word hashes, distinct n-grams in ascending order, place of each) of every text."""
    for i, j, hashes, _, first, _ in words_of(column, "space"):
        for row in range(i, j):
            words = hashes[first[row - i] : first[row - i + 1]]
            distinct, place = np.unique(grams(words, k), return_index=True)
            yield row, words, distinct, place


def _profile(k: int):
    """First pass: size and identity of every set, and the slot counts."""

    def run(batches):
        counts = SlotCounts({"word": WORD_SLOTS, "gram": GRAM_SLOTS})
        for batch in batches:
            ids, sizes, all_words, all_grams = [], [], [], []
            held = 0
            for _, words, distinct, _ in _sets_of(batch.column(1), k):
                ids.append(set_id(distinct))
                sizes.append(len(distinct))
                all_words.append(words)
                all_grams.append(distinct)
                if (held := held + len(words)) > 1_000_000:
                    counts.add("word", np.concatenate(all_words))
                    counts.add("gram", np.concatenate(all_grams))
                    all_words, all_grams, held = [], [], 0
            if all_words:
                counts.add("word", np.concatenate(all_words))
                counts.add("gram", np.concatenate(all_grams))
            none = pa.nulls(len(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), none.cast(pa.string()), none.cast(pa.binary())], ["doc_id", "sid", "n", "block", "counts"])
        if rows := list(counts.blocks()):
            none = pa.nulls(len(rows)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array([x for x, _ in rows], pa.string()), pa.array([x for _, x in rows], pa.binary())], ["doc_id", "sid", "n", "block", "counts"])

    return run


def _rarity(totals: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Small tables that rank words and n-grams: tenths of bits of a word's frequency, and for an
    n-gram the octaves by which its slot stands out of the slots' common level."""
    gram = totals["gram"]
    level = gram.mean()
    excess = np.maximum(0, gram - level - 4 * np.sqrt(level) - 8)
    return {
        "word": np.round(10 * np.log2(1 + totals["word"])).astype(np.uint16),
        "gram": np.ceil(np.log2(1 + excess / 8)).astype(np.uint8),
    }


def _prefixes(k: int, percent: int, shared):
    """Second pass: (gram, part, sid, n, l, low) for the prefix of every set; equal sets of a task once.
    part: 0, or from 1 on the part of a hot n-gram that the set is in. low: no set similar to this one
    asks for fewer shared n-grams."""

    def run(batches):
        rank = shared.value
        seen: set[int] = set()
        for batch in batches:
            tokens, parts, owners, sizes, matches, lows, widths = [], [], [], [], [], [], []
            for _, words, distinct, place in _sets_of(batch.column(1), k):
                n = len(distinct)
                if not n or (sid := set_id(distinct)) in seen:
                    continue
                if len(seen) < 500_000:
                    seen.add(sid)
                bits = rank["word"][(words & U64(WORD_SLOTS - 1)).astype(np.int64)].astype(np.uint64)
                width = min(k, len(words))
                chance = np.zeros(len(words) - width + 1, U64)
                for j in range(width):
                    chance += bits[j : len(words) - width + 1 + j]
                octave = rank["gram"][(distinct & U64(GRAM_SLOTS - 1)).astype(np.int64)].astype(np.uint64)
                order = np.argsort((octave << U64(16)) + np.minimum(chance[place], U64(65535)), kind="stable")
                least = needed(n, percent)
                cost = (np.left_shift(1, octave[order[: n - least + 1]].astype(np.int64)) - 1).sum()
                ell = min(least, matches_by_size(n, percent) + int(cost > 64) + int(cost > 4096))
                prefix = distinct[order[: n - least + ell]]
                over = octave[order[: n - least + ell]].astype(np.int64) - HOT_OCTAVE
                tokens.append(prefix)
                parts.append(np.where(over > 0, 1 + ((sid >> 24) & (np.left_shift(1, np.maximum(over, 0)) - 1)), 0))
                owners.append(sid)
                sizes.append(n)
                matches.append(ell)
                lows.append(min(ell, matches_by_size(needed(n, percent), percent)))
                widths.append(len(prefix))
            if tokens:
                each = lambda x, kind: pa.array(np.repeat(np.array(x, kind), widths))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(parts).astype(np.int32)), each(owners, np.int64), each(sizes, np.int32), each(matches, np.int8), each(lows, np.int8)], ["gram", "part", "sid", "n", "ell", "low"])

    return run


def _runs(batches, keys: int) -> Iterator[pa.Table]:
    """The rows of sorted batches, cut so that no run of equal keys is split unless it is long."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(c)[-1] for c in range(keys)]
        same = np.ones(batch.num_rows, bool)
        for c, x in enumerate(last):
            same &= batch.column(c).to_numpy(zero_copy_only=False) == x.as_py()
        cut = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _candidates(percent: int):
    """Pairs (kind 0) from grams with few sets, ties (1) to the first set from those with more and from
    parts of hot ones, each of which also gives its gram and first set (2)."""

    def emit(a, b, ell, kind):
        if kind == 0:
            a, b = np.minimum(a, b), np.maximum(a, b)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(ell.astype(np.int8)), pa.array(np.full(len(a), kind, np.int8))], ["a", "b", "ell", "kind"])

    def run(batches):
        for table in _runs(batches, 2):
            gram, part, sid, n, ell, low = (table.column(c).to_numpy() for c in range(6))
            begins = np.ones(len(gram), bool)
            begins[1:] = (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])
            fresh = begins.copy()
            fresh[1:] |= sid[1:] != sid[:-1]
            starts = np.flatnonzero(begins[fresh])
            gram, part, sid, n, ell, low = gram[fresh], part[fresh], sid[fresh], n[fresh], ell[fresh], low[fresh]
            lengths = np.diff(np.append(starts, len(gram)))
            hot = part[starts] > 0
            heavy = hot | (lengths > LIGHT)
            if hot.any():
                yield emit(gram[starts[hot]], sid[starts[hot]], np.zeros(hot.sum()), 2)
            if heavy.any():
                at = np.repeat(starts[heavy], lengths[heavy])
                inner = np.arange(len(at)) - np.repeat(np.cumsum(lengths[heavy]) - lengths[heavy], lengths[heavy])
                yield emit(sid[at], sid[at + inner], low[at + inner], 1)
            for length in np.unique(lengths[(lengths > 1) & ~heavy]):
                x, y = np.triu_indices(length, 1)
                mine = starts[lengths == length]
                step = max(1, 200_000 // len(x))
                for k in range(0, len(mine), step):
                    p, q = (mine[k : k + step, None] + x).ravel(), (mine[k : k + step, None] + y).ravel()
                    near = 100 * np.minimum(n[p], n[q]).astype(np.int64) >= percent * np.maximum(n[p], n[q]).astype(np.int64)
                    yield emit(sid[p[near]], sid[q[near]], np.minimum(ell[p[near]], ell[q[near]]), 0)

    return run


def _held(batches, bitmap: IdBitmap) -> Iterator[pa.Array]:
    """Texts of the ids that the bitmap holds and of rows without an id, 512 at most at once."""
    for batch in batches:
        ids = batch.column(0)
        batch = batch.filter(pa.array(bitmap.holds(ids.fill_null(0).to_numpy(zero_copy_only=False)) | ids.is_null().to_numpy(zero_copy_only=False)))
        for i in range(0, batch.num_rows, 512):
            yield batch.column(1).slice(i, 512)


def _members(k: int, wanted):
    """Identities of sets and texts of the wanted rows. Texts travel, since they pack to a third of
    their n-grams' hashes."""

    def run(batches):
        for texts in _held(batches, wanted.value):
            yield pa.RecordBatch.from_arrays([pa.array([set_id(x) for _, _, x, _ in _sets_of(texts, k)], pa.int64()), texts], ["sid", "text"])

    return run


def size_classes(n: int, percent: int) -> tuple[int, int]:
    """The largest sizes of the class of sizes that n is in and of the next one. A size links with none
    beyond the class next to its own."""
    high = 1
    while high < n:
        high = max(high + 1, (high + 1) * 100 // percent)
    return high, max(high + 1, (high + 1) * 100 // percent)


def signatures(distinct: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of which two similar sets have one in common at least.

    Similar sets of ``high`` n-grams at most differ in d at most. Dealt to d + 1 + e bins by hash, they have
    e + 1 equal bins or more. Each leaves out its e smallest bins, equally large ones by number: the
    last of the equal bins in this order is left out by neither, since the e others would be before it.
    This is done for the size class of the set and the next one, where larger partners are."""
    mixed = fmix(distinct ^ U64(0x2545F4914F6CDD1D))
    out = []
    for high in size_classes(len(distinct), percent):
        apart = 2 * high * (100 - percent) // (100 + percent)
        spare = int(SPARE * (apart + 1))
        bins = apart + 1 + spare
        at = ((mixed >> U64(32)) % U64(bins)).astype(np.int64)
        sums = np.zeros(bins, U64)
        np.add.at(sums, at, mixed)
        given = np.argsort(np.bincount(at, minlength=bins), kind="stable")[spare:]
        out.append(fmix(sums[given] + fmix(given.astype(U64) + (U64(high) << U64(32)))))
    return np.concatenate(out)


def _signed(k: int, percent: int, wanted):
    """(signature, sid) of the wanted rows."""

    def run(batches):
        for texts in _held(batches, wanted.value):
            sids, found = [], []
            for _, _, distinct, _ in _sets_of(texts, k):
                if len(distinct):
                    sids.append(set_id(distinct))
                    found.append(signatures(distinct, percent))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(np.array(sids, np.int64), [len(x) for x in found]))], ["signature", "sid"])

    return run


class _Forest:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return int(x)

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def similar(left: int | np.ndarray, right: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (left + right - common)


def links_within(sets: list[np.ndarray], sides: np.ndarray, copies: np.ndarray, percent: int) -> list[tuple[int, int, int]]:
    """A spanning forest of the similar pairs, with the linked rows counted per set: (x, root, rows
    linked with x). ``sides``: pairs of two sets of one side are skipped where both sides are present, since
    another part of the block has them."""
    m = len(sets)
    sizes = np.array([len(x) for x in sets])
    forest, degree = _Forest(m), np.zeros(m, np.int64)
    across = sides.min() != sides.max()
    owner = np.repeat(np.arange(m), sizes)
    _, token, freq = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = freq[token] > 1
    owner, token = owner[common], token[common]
    by_token = np.argsort(token, kind="stable")
    posted, ends = owner[by_token], np.cumsum(np.bincount(token, minlength=len(freq)))
    begins = ends - np.bincount(token, minlength=len(freq))
    edge = np.searchsorted(owner, np.arange(m + 1))
    for x in range(m):
        mine = token[edge[x] : edge[x + 1]]
        if not len(mine) or across and sides[x]:
            continue
        spans = ends[mine] - begins[mine]
        at = np.repeat(begins[mine] - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
        shared = np.bincount(posted[at], minlength=m)
        found = similar(sizes[x], sizes, shared, percent) & (shared > 0)
        found[: x + 1] &= across
        if across:
            found &= sides == 1
        hits = np.flatnonzero(found)
        degree[x] += copies[hits].sum()
        degree[hits] += copies[x]
        for y in hits:
            forest.union(x, int(y))
    return [(x, forest.find(x), int(degree[x])) for x in range(m) if degree[x]]


LINKS = "a long, b long, links long"


def _links(a: list[int], b: list[int], links: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, links)], ["a", "b", "links"])


def _common(x: np.ndarray, y: np.ndarray) -> int:
    small, large = (x, y) if len(x) < len(y) else (y, x)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int((large[at] == small).sum())


class _Pairs:
    """Links among candidate pairs, each from either end with the rows at the other one. A unit is a
    set (side 0) that stands before its partners, or the sets of a component, each with the ids of
    its partners."""

    def __init__(self, k: int, percent: int):
        self.k, self.percent, self.unit, self.mine, self.own = k, percent, None, None, 0
        self.group: dict[int, tuple[np.ndarray, int, list[int]]] = {}
        self.of = None

    def _check(self, out: tuple, x: int, y: int, a: tuple, b: tuple) -> None:
        if similar(len(a[0]), len(b[0]), _common(a[0], b[0]), self.percent):
            for column, pair in zip(out, ((x, y), (y, x), (b[1], a[1])), strict=True):
                column += pair

    def _finish(self, out: tuple) -> None:
        for x, held in self.group.items():
            for y in held[2]:
                self._check(out, x, y, held, self.group[y])
        self.group = {}

    def links(self, batch: pa.RecordBatch | None) -> pa.RecordBatch:
        """Those that a batch completes; of None: the rest."""
        out: tuple = ([], [], [])
        if batch is None:
            self._finish(out)
            return _links(*out)
        columns = (batch.column(c).to_pylist() for c in ("unit", "j", "sid", "side", "copies", "partners"))
        for unit, j, sid, side, copies, partners, (_, _, held, _) in zip(*columns, _sets_of(batch.column("text"), self.k), strict=True):
            if j == TOGETHER:
                if unit != self.of:
                    self._finish(out)
                    self.of = unit
                self.group[sid] = (held, copies, partners or [])
            elif not side:
                self.unit, self.mine = unit, (held, copies)
            elif unit == self.unit:
                self._check(out, unit, sid, self.mine, (held, copies))
        return _links(*out)


def _compare(k: int, percent: int):
    """Links of the units: those of candidate pairs (j below 0), and parts of blocks."""

    def run(batches):
        pairs, ready = _Pairs(k, percent), []

        def parts():
            for batch in batches:
                single = batch.column("j").to_numpy() < 0
                if single.any():
                    ready.append(pairs.links(batch.filter(pa.array(single))))
                yield batch.filter(pa.array(~single))

        for table in _runs(parts(), 3):
            keys = [table.column(c).to_numpy() for c in range(3)]
            breaks = np.ones(table.num_rows, bool)
            breaks[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
            starts = [*np.flatnonzero(breaks), table.num_rows]
            sid, side, copies, text = table.column("sid").to_numpy(), table.column("side").to_numpy(), table.column("copies").to_numpy(), table.column("text").combine_chunks()
            a, b, d = [], [], []
            for s, e in zip(starts, starts[1:], strict=False):
                for x, root, links in links_within([x for _, _, x, _ in _sets_of(text.slice(s, e - s), k)], side[s:e], copies[s:e], percent) if e - s > 1 else ():
                    a.append(sid[s + x])
                    b.append(sid[s + root])
                    d.append(links)
            ready.append(_links(a, b, d))
            yield from ready
            ready.clear()
        yield from ready
        yield pairs.links(None)

    return run


def _unit(rows: DataFrame, kind: int, side: int) -> DataFrame:
    return rows.select("unit", F.lit(0).alias("i"), F.lit(kind).alias("j"), F.lit(side).cast("byte").alias("side"), "sid", "partners")


def _parts() -> Column:
    """The number of parts of a group of sets."""
    return F.ceil(F.greatest(F.count("*") / PART_SETS, F.sum("n") / PART_GRAMS)).cast("int")


def _part_of(parts: str, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64("sid", F.lit(seed)), F.col(parts)).cast("int")


def _split(large: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Blocks (sid, blk, n) of the sets of ``large`` that have a signature in common, directly or by way of
    others; sets that share none with another are similar to none of them."""
    spark = large.sparkSession
    large = written(large.join(classes.select("sid", "rep"), "sid").select("sid", "n", "rep"), "large")
    wanted = spark.sparkContext.broadcast(IdBitmap.of(large, "rep"))
    signed = written(docs.select("doc_id", "text").mapInArrow(_signed(k, percent, wanted), "signature long, sid long"), "signed")
    wanted.destroy()
    least = signed.groupBy("signature").agg(F.min("sid").alias("least"), F.count("*").alias("rows")).where("rows > 1")
    ties = join_hot(signed, least, "signature", "rows", signed.count()).select("sid", F.col("least"))
    found = connected_components(ties, "sid", "least").toDF("sid", "blk")
    out = written(found.join(large.select("sid", "n"), "sid").select("sid", "blk", "n"), "blocks")
    discard(large, signed)
    release(spark)
    return out


def _crossed(placed: DataFrame) -> DataFrame:
    """Units of two parts each. ``placed`` has blk, sid, its part p, and the range (low, high) of the
    parts that it is compared with."""
    each = placed.where("low < high").select("blk", "p", "sid", F.explode(F.sequence(F.col("low"), F.col("high") - 1)).alias("q"))
    return each.select(
        F.col("blk").alias("unit"), F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), F.when(F.col("p") > F.col("q"), 1).otherwise(0).cast("byte").alias("side"), "sid",
        F.lit(None).cast("array<bigint>").alias("partners"),
    )


def _beside_first(placed: DataFrame) -> DataFrame:
    """Units of the first part and one other, with all pairs of both; of a block of one part that part."""
    each = placed.select("blk", "sid", F.explode(F.when(F.col("p") > 0, F.array("p")).otherwise(F.sequence(F.least(F.lit(1), F.col("parts") - 1), F.col("parts") - 1))).alias("j"))
    return each.select(F.col("blk").alias("unit"), F.lit(0).alias("i"), "j", F.lit(0).cast("byte").alias("side"), "sid", F.lit(None).cast("array<bigint>").alias("partners"))


def _rest_of_blocks(placed: DataFrame, classed: DataFrame) -> DataFrame:
    """Units for what ``_beside_first`` leaves in blocks of more than two parts: the sets outside the
    block's largest class, against each other and against all but the first part, which has met all."""
    rows = placed.where("parts > 2 and p > 0").select("blk", "sid", "n").join(classed.toDF("sid", "root"), "sid", "left")
    rows = written(rows.withColumn("root", F.coalesce("root", "sid")), "rest")
    largest = rows.groupBy("blk", "root").agg(F.count("*").alias("rows")).groupBy("blk").agg(F.max_by("root", F.struct("rows", "root")).alias("main"), F.sum("rows").alias("rows"))
    total = rows.count()
    marked = join_hot(rows, largest, "blk", "rows", total).withColumn("rest", F.col("root") != F.col("main"))
    sizes = marked.groupBy("blk", "rest").agg(_parts().alias("parts"), F.count("*").alias("rows")).groupBy("blk").agg(
        F.coalesce(F.max(F.when(F.col("rest"), F.col("parts"))), F.lit(0)).alias("few"), F.coalesce(F.max(F.when(~F.col("rest"), F.col("parts"))), F.lit(0)).alias("many"), F.sum("rows").alias("rows")
    )
    dealt = join_hot(marked, sizes.where("few > 0"), "blk", "rows", total)
    out = written(_crossed(dealt.select(
        "blk", "sid", F.when(F.col("rest"), _part_of("few", 1)).otherwise(F.col("few") + _part_of("many", 1)).alias("p"),
        F.lit(0).alias("low"), F.when(F.col("rest"), F.col("few") + F.col("many")).otherwise(F.col("few")).alias("high"),
    )), "units")
    discard(rows)
    return out


def ngram_jaccard_classes(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", links: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, n_links if ``links``, component_id.

    Two rows link when their sets of distinct word ``n``-grams (ASCII lower case, ASCII white
    space between words) have a Jaccard similarity of ``percent`` hundredths or more;
    component_id is the smallest id that links reach. n_links counts the other rows that a row is
    linked with; a group of m near copies costs m * m comparisons for it, and a multiple of m without.
    A text of fewer words is one gram; a null, empty or blank text has no gram,
    links with nothing and is its own component. Repeated rows count as rows of their own with
    one id. A row without an id links like any other but lends no id: its component_id is the
    smallest id that its links reach, null if none. Other columns are ignored.

    Sets are told apart by a 64-bit identity: among 10**9 distinct texts, a false match of two is
    expected with a chance of 3 %.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    first = written(docs.mapInArrow(_profile(n), "doc_id long, sid long, n long, block string, counts binary"), "profile")
    sizes = {"word": WORD_SLOTS, "gram": GRAM_SLOTS}
    rank = spark.sparkContext.broadcast(_rarity(summed_blocks(first.where("block is not null"), sizes)))
    rows = first.where("block is null").select("doc_id", "sid", "n")
    classes = rows.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.count("*").alias("copies"))

    index = docs.select("doc_id", "text").mapInArrow(_prefixes(n, percent, rank), "gram long, part int, sid long, n int, ell byte, low byte")
    found = written(
        index.repartition("gram", "part").sortWithinPartitions("gram", "part", "sid").mapInArrow(_candidates(percent), "a long, b long, ell byte, kind byte")
        .groupBy("a", "b", "kind").agg(F.count("*").alias("shared"), F.max("ell").alias("ell")), "candidates"
    )
    rank.destroy()
    release(spark)
    ties = found.where("kind = 1")
    heavy = written(ties.groupBy(F.col("b").alias("sid")).agg(F.sum("shared").alias("heavy"), F.min("ell").alias("low")), "heavy")
    ties = ties.join(heavy.where("heavy >= low").select(F.col("sid").alias("b")), "b", "left_semi")
    pairs = found.where("kind = 0")
    few = (
        pairs.where("shared < ell").join(heavy.select(F.col("sid").alias("a"), F.col("heavy").alias("ha")), "a")
        .join(heavy.select(F.col("sid").alias("b"), F.col("heavy").alias("hb")), "b").where("shared + least(ha, hb) >= ell")
    )
    hubs = found.where("kind = 2").select(F.col("a").alias("gram"), "b")
    hubs = hubs.join(hubs.groupBy("gram").agg(F.min("b").alias("a")), "gram").select("a", "b")
    blocks = written(connected_components(ties.select("a", "b").unionByName(hubs)).join(classes, F.col("node") == F.col("sid")).select("sid", F.col("root").alias("blk"), "n"), "blocks")
    parts = blocks.groupBy("blk").agg(_parts().alias("parts"), F.count("*").alias("rows"))
    block_of, whole = blocks.select("sid", "blk"), None
    if (first_large := parts.where(F.col("parts") > WHOLE_PARTS).agg(F.min("blk")).first()[0]) is not None:
        marked = join_hot(blocks, parts, "blk", "rows", blocks.count()).withColumn("large", F.col("parts") > WHOLE_PARTS)
        # similar sets of large blocks stay in one block, so no pair of two of them is verified by itself
        block_of = marked.select("sid", F.when(F.col("large"), F.lit(first_large)).otherwise(F.col("blk")).alias("blk"))
        whole, split = blocks, _split(marked.where("large").select("sid", "n"), docs, classes, n, percent)
        blocks = written(marked.where("not large").select("sid", "blk", "n").unionByName(split), "blocks")
        discard(split)
        parts = blocks.groupBy("blk").agg(_parts().alias("parts"), F.count("*").alias("rows"))
    pairs = pairs.where("shared >= ell").select("a", "b").unionByName(few.select("a", "b"))
    pairs = pairs.join(block_of.toDF("a", "ba"), "a", "left").join(block_of.toDF("b", "bb"), "b", "left")
    pairs = written(pairs.where("ba is null or bb is null or ba <> bb").select("a", "b"), "pairs")
    none = F.lit(None).cast("array<bigint>")
    placed = join_hot(blocks, parts, "blk", "rows", blocks.count()).withColumn("p", _part_of("parts"))
    tied = _crossed(placed.withColumns({"low": F.lit(0), "high": F.col("parts")})) if links else _beside_first(placed)
    everyone = written(connected_components(pairs), "members")
    sizes = everyone.groupBy("root").agg(F.count("*").alias("sets"), F.count("*").alias("rows"))
    members = join_hot(everyone, sizes, "root", "rows", everyone.count())
    small, large = members.where(F.col("sets") <= GROUP_SETS), members.where(F.col("sets") > GROUP_SETS)
    partners = pairs.join(small.select(F.col("node").alias("a")), "a", "left_semi").groupBy("a").agg(F.collect_list("b").alias("partners"))
    together = small.select(F.col("root").alias("unit"), F.col("node").alias("sid")).join(partners.withColumnRenamed("a", "sid"), "sid", "left")
    far = pairs.join(large.select(F.col("node").alias("a")), "a", "left_semi").withColumn("partners", none)
    beside = _unit(far.select(F.col("a").alias("unit"), F.col("b").alias("sid"), "partners"), BESIDE, 1).unionByName(
        _unit(far.select(F.col("a").alias("unit"), F.col("a").alias("sid"), "partners"), BESIDE, 0).dropDuplicates(["unit"])
    )

    def compared(units: DataFrame) -> DataFrame:
        units = written(units, "units")
        wanted_sets = written(units.select("sid").distinct().join(classes, "sid").select("sid", "rep", "copies"), "wanted")
        wanted = spark.sparkContext.broadcast(IdBitmap.of(wanted_sets, "rep"))
        sets = docs.select("doc_id", "text").mapInArrow(_members(n, wanted), "sid long, text string")
        sets = sets.join(wanted_sets.select("sid", "copies"), "sid").dropDuplicates(["sid"])
        rows = units.join(sets, "sid").select("unit", "i", "j", "side", "sid", "copies", "text", "partners").repartition("unit", "i", "j")
        out = written(rows.sortWithinPartitions("unit", "i", "j", "side", "sid").mapInArrow(_compare(n, percent), LINKS), "links")
        discard(units, wanted_sets)
        wanted.destroy()
        release(spark)
        return out

    linked = compared(tied.unionByName(_unit(together, TOGETHER, 0)).unionByName(beside))
    classed = connected_components(linked.select("a", "b"))
    if not links and parts.where("parts > 2").head(1):
        rest = _rest_of_blocks(placed, classed)
        if rest.head(1):
            more = compared(rest)
            classed = connected_components(classed.toDF("a", "b").unionByName(more.select("a", "b")))
            discard(more)
        discard(rest)
    degree = linked.groupBy(F.col("a").alias("sid")).agg(F.sum("links").alias("partners"))
    labels = classes.join(classed.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    labels = written(labels.join(degree, "sid", "left").select("sid", "root", "rep", "copies", F.coalesce("partners", F.lit(0)).alias("partners")), "labels")
    least = labels.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("rows"))
    discard(found, heavy, blocks, pairs, everyone, linked, *([whole] if whole else []))
    counts = labels.agg(F.count("*"), F.sum("copies")).first()
    labels = join_hot(labels, least, "root", "rows", counts[0]).select("sid", "component_id", "copies", F.col("copies").alias("rows"), "partners")
    out = join_hot(rows, labels, "sid", "rows", counts[1] or 0, "left")
    found = [F.coalesce(F.col("partners") + F.col("copies") - 1, F.lit(0)).alias("n_links")] if links else []
    return out.select("doc_id", F.col("n").alias("n_shingles"), *found, F.coalesce("component_id", "doc_id").alias("component_id"))
