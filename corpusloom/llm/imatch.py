"""I-Match fingerprints with randomised lexicon subsets, in DataFrame operations only.

The lexicon is the set of terms whose inverse document frequency, counted over distinct texts, lies
within a band. Terms are counted in ``SLOTS`` hash slots, so the lexicon has a fixed size and
reaches the tasks as a literal of one byte a slot, however many terms there are. A fingerprint has
one part for each of a number of random subsets of the lexicon: the hash of the document's distinct
lexicon terms in the subset, sorted; a part without terms is empty. Dense subsets suit short texts,
sparse ones still agree after edits of long ones. A last part, over all terms, is never empty, so
texts that the lexicon cannot tell apart have fingerprints of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 1 << 20
SLOT_BITS = 20
#: The subsets, level by level: terms of the level above that go on, as 1 of 2**bits, and then
#: 2**bits subsets of these. The shares of the lexicon are 1/4, 1/16, 1/64, ... 1/4096.
LEVELS = ((0, 2), (1, 3), (1, 4), (2, 4), (2, 4), (2, 4))
PARTS = sum(1 << split for _, split in LEVELS) + 1
MIN_IDF = 1.0
MIN_DOCS = 2
#: What Spark's xxhash64 makes of no value: the mark of an empty part.
EMPTY = 42
GRID = 64
#: Rows of a range of ids, about.
RANGE_ROWS = 50_000
NULL_BITS = 12


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once a row."""
    return F.get(F.transform(F.array(value), body), 0)


def term_keys(text: Column) -> Column:
    """Hashes of the distinct terms, runs of letters and digits in lower case."""
    keys = F.transform(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: F.xxhash64(t))
    return F.array_remove(F.array_distinct(keys), F.xxhash64(F.lit("")))


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def lexicon(docs: DataFrame, text_col: str = "text", min_idf: float = MIN_IDF, min_docs: int = MIN_DOCS) -> bytearray:
    """One byte a slot: 1 where the slot's terms are in the band ``min_idf <= ln(N / df)`` and
    ``df >= min_docs``, N and df counted over distinct texts, so that no group of copies moves a
    term. What comes to the driver is bounded by the number of slots."""
    slots = F.array_distinct(F.transform(term_keys(_text(text_col)), lambda h: h.bitwiseAND(F.lit(SLOTS - 1)).cast("int")))
    texts = docs.select(F.xxhash64(_text(text_col)).alias("h"), slots.alias("slots")).groupBy("h").agg(F.any_value("slots").alias("slots"))
    df = texts.select(F.explode("slots").alias("slot")).groupBy("slot").agg(F.count("*").alias("df"))
    total = docs.select(F.xxhash64(_text(text_col)).alias("h")).distinct().count()
    band = bytearray(SLOTS)
    inside = df.where((F.col("df") >= min_docs) & (F.log(F.lit(float(max(total, 1))) / F.col("df")) >= min_idf)).select("slot").toArrow()
    for part in inside.column("slot").chunks:
        for slot in part.to_numpy():
            band[slot] = 1
    return band


def fingerprint_parts(text: Column, band: bytearray) -> Column:
    """The fingerprint's parts as 64-bit numbers, ``EMPTY`` for a subset without terms; the last one
    is over all terms, or over the text itself where it has none."""
    held, one = F.lit(bytes(band)), F.lit(b"\x01")

    def subset(keys: Column, at: int, size: int, value: int) -> Column:
        """The keys with ``value`` in ``size`` bits from ``at`` on."""
        mask, wanted = F.lit(((1 << size) - 1) << at), F.lit(value << at)
        return F.filter(keys, lambda h: h.bitwiseAND(mask) == wanted)

    def levels(keys: Column, at: int, left: tuple) -> Column:
        """Parts of this level and, from the terms that go on, of those after it."""
        if not left:
            return F.array().cast("array<bigint>")
        down, split = left[0]
        mine = subset(keys, at, down, 0) if down else keys

        def parts(keys: Column) -> Column:
            one_level = F.array(*(F.xxhash64(subset(keys, at + down, split, j)) for j in range(1 << split)))
            return F.concat(one_level, levels(keys, at + down + split, left[1:]))

        return _bound(mine, parts)

    def of(keys: Column) -> Column:
        inside = F.filter(keys, lambda h: F.substring(held, h.bitwiseAND(F.lit(SLOTS - 1)).cast("int") + 1, F.lit(1)) == one)
        every = F.when(F.size(keys) > 0, F.xxhash64(keys)).otherwise(F.xxhash64(text, F.lit("text")))
        return F.concat(levels(inside, SLOT_BITS, LEVELS), F.array(every))

    return _bound(F.sort_array(term_keys(text)), of)


def fingerprint_text(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: F.when(p == EMPTY, F.lit("")).otherwise(F.lower(F.lpad(F.hex(p), 16, "0")))), ".")


def likeness(a: Column, b: Column) -> Column:
    """Equal parts by parts that either text has; 1 for equal fingerprints."""
    pairs = F.zip_with(a, b, lambda x, y: F.when((x == EMPTY) & (y == EMPTY), F.lit(None).cast("int")).otherwise((x == y).cast("int")))
    return _bound(F.array_compact(pairs), lambda p: F.size(F.array_remove(p, F.lit(0))) / F.size(p)).cast("double")


def imatch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **band) -> DataFrame:
    """(doc_id, fingerprint) of every row; all null and empty texts have one fingerprint. Repeated
    rows get equal ones; other columns are ignored."""
    held = lexicon(docs, text_col, **band)
    return docs.select(F.col(id_col).alias("doc_id"), fingerprint_text(fingerprint_parts(_text(text_col), held)).alias("fingerprint"))


def _ranges(docs: DataFrame) -> Column:
    """The range of each row: ids go to cells of equal numbers of rows, each cell is cut evenly
    into ranges of about ``RANGE_ROWS``, and rows without an id go to ranges by their text's hash."""
    steps = [k / (GRID * GRID) for k in range(1, GRID * GRID)]
    found = docs.agg(F.percentile_approx("doc_id", steps, 20_000), F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    low, high = (0, 0) if found[1] is None else (found[1], found[2])
    bounds = found[0] or [high] * len(steps)
    cuts = max(1, -(-found[3] // (GRID * GRID * RANGE_ROWS)))
    starts = [low, *bounds]
    ends = [*bounds, high + 1]
    outer = F.lit(bounds[GRID - 1 :: GRID])
    inner = F.lit([bounds[k * GRID : k * GRID + GRID - 1] for k in range(GRID)])
    below = lambda held: F.size(F.filter(held, lambda b: b <= F.col("doc_id")))
    cell = _bound(below(outer), lambda hi: hi * GRID + below(F.element_at(inner, hi + 1)))
    if cuts > 1:
        start, width = F.lit(starts), F.lit([max(1, e - s) for s, e in zip(starts, ends, strict=True)])
        within = lambda c: F.least(F.lit(cuts - 1), F.floor((F.col("doc_id") - F.element_at(start, c + 1)) / F.element_at(width, c + 1) * cuts)).cast("long")
        cell = _bound(cell, lambda c: c.cast("long") * cuts + F.greatest(F.lit(0), within(c)))
    return F.when(F.col("doc_id").isNull(), F.shiftright("h", 64 - NULL_BITS) - (1 << (NULL_BITS - 1))).otherwise(cell.cast("long"))


def with_next(docs: DataFrame, derived: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, text, next_text): each text and the next one in ascending order of id (null ids
    first; rows of one id or none by their text's hash, then text); after the last, the first. Each
    column of ``derived``, made of a row's own text, comes with its next_ column too.

    Rows go to ranges of ids, as many as the number of rows asks for, so each range is sorted by
    itself; the first row of each range is added to the range before it.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text("text").alias("text")).withColumn("h", F.xxhash64("text"))
    docs = docs.withColumn("range", _ranges(docs))
    firsts = docs.groupBy("range").agg(F.min(F.struct("doc_id", "h", "text")).alias("row"))
    order = firsts.select("range")
    before = order.select("range", F.lag("range").over(Window.orderBy("range")).alias("to"))
    last = docs.agg(F.max("range")).first()[0] or 0
    before = before.select("range", F.coalesce("to", F.lit(last)).alias("to"))
    extra = firsts.join(before, "range").select("row.doc_id", "row.text", "row.h", F.col("to").alias("range"), F.lit(1).alias("extra"))
    derived = derived or {}
    both = docs.withColumn("extra", F.lit(0)).withColumns(derived).unionByName(extra.withColumns(derived))
    ahead = Window.partitionBy("range").orderBy("extra", F.col("doc_id").asc_nulls_first(), "h", "text")
    held = ["text", *derived]
    both = both.withColumns({f"next_{c}": F.lead(c).over(ahead) for c in held})
    return both.where("extra = 0").select("doc_id", *held, *(f"next_{c}" for c in held))


def edited_text(text: str = "text", following: str = "next_text") -> Column:
    """The text with its last half, rounded down, replaced by as much of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def imatch_edits(docs: DataFrame, **band) -> DataFrame:
    """Fingerprints of each text, of its edited text (the last half, rounded down, replaced by as
    much of the next text) and how like they and the next text are.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; one
    row per row of ``docs``. Null texts count as empty; a single row is its own next; of repeated
    ids the texts' hashes decide the order. Other columns are ignored.
    """
    held = lexicon(docs, "text", **band)
    rows = with_next(docs, {"parts": fingerprint_parts(F.col("text"), held)}).withColumn("edited", edited_text())
    rows = rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        F.col("parts").alias("a"), fingerprint_parts(F.col("edited"), held).alias("b"), F.col("next_parts").alias("c"),
    )
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint_text(F.col("a")).alias("fingerprint"), fingerprint_text(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("c")).alias("near_next"),
    )
