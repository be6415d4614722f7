"""Set-based ingest: rights gate, keyed insert-or-ignore, content deduplication, governance rows.

An ingest is a few anti-joins against the store's keys and one first-wins pick per key, so a second
run of the same input inserts nothing and the order of files does not matter beyond ``seq``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.errors import Invariant, RightsGateRefused
from corpusloom.functions.hashing import content_hash, dedup_key
from corpusloom.functions.text import canonicalise
from corpusloom.schemas import ARRAYS, DEFAULT_OVERLAP_TOKENS, DEFAULT_RIGHTS, DEFAULT_TARGET_TOKENS, EPISODE, TEXT_DEFAULTS
from corpusloom.storage import discard, written

#: Rows that are taken one by one in a task: some 50 MB of keys and contents.
ORDERED_ROWS = 200_000
#: Rows of keys that are sent to all tasks: some 10 MB.
SENT_ROWS = 50_000
STATS = ("seen", "inserted", "existing", "rejected", "chunks_seen", "chunks_inserted", "chunks_deduped", "chunks_rights_skipped")


def rights_allowed(code: Column, allow: Sequence[str] = DEFAULT_RIGHTS) -> Column:
    """Whether the code is in the list, in either case; null is not."""
    return F.coalesce(F.lower(code).isin([a.lower() for a in allow]), F.lit(False))


def effective_rights(own: Column, configured: Column) -> Column:
    return F.coalesce(F.nullif(own, F.lit("")), configured)


def check_rights(code: str | None, allow: Sequence[str] = DEFAULT_RIGHTS) -> None:
    if code is None or code.lower() not in {a.lower() for a in allow}:
        raise RightsGateRefused(f"rights code {code!r} is not allowed")


def with_defaults(episodes: DataFrame) -> DataFrame:
    """Missing lists are empty, missing optional texts ''; the chunking policy gets its default."""
    policy = F.struct(F.coalesce("chunking_policy.target_tokens", F.lit(DEFAULT_TARGET_TOKENS)).alias("target_tokens"), F.coalesce("chunking_policy.overlap_tokens", F.lit(DEFAULT_OVERLAP_TOKENS)).alias("overlap_tokens"))
    fills = {c: F.coalesce(c, F.array().cast("array<string>")) for c in ARRAYS} | {c: F.coalesce(c, F.lit("")) for c in TEXT_DEFAULTS}
    return episodes.withColumns(fills).withColumn("effective_policy", policy)


def metadata_json(episodes: DataFrame) -> Column:
    return F.to_json(F.struct(*(F.col(f.name) for f in EPISODE.fields)), {"ignoreNullFields": "false"})


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the order given. Keys of high multiplicity are cut down before
    the shuffle: the pick is an aggregate with partial results in every task."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by(F.struct(*rest), F.struct(*order)).alias("row")
    return df.groupBy(*keys).agg(pick).select(*keys, *(F.col(f"row.{c}").alias(c) for c in rest)).select(df.columns)


def insert_or_ignore(new: DataFrame, held: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows of ``new`` to append: the first of each key that is not held."""
    return first_by(new, [key], order).join(held.select(key), key, "left_anti").select(new.columns)


def connected(rows: DataFrame, key: str, content: str) -> DataFrame:
    """``rows`` with ``group``: rows that share a key or a content, directly or over others, have one
    group. Alternating stars halve the distance to a group's least node, so the rounds grow with the
    logarithm of the longest chain."""
    node = lambda tag, c: F.xxhash64(F.lit(tag), c)
    both = rows.select(node("key", key).alias("u"), node("content", content).alias("v"))
    edges, before = written(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"), None
    while True:
        either = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = either.join(either.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u > v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        after = written(small.where("u > v").distinct(), "edges")
        discard(edges, large)
        edges, sign = after, after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if sign == before:
            break
        before = sign
    named = edges.select(F.col("u").alias("_node"), F.col("v").alias("group"))
    out = rows.withColumn("_node", node("key", F.col(key))).join(named, "_node", "left").withColumn("group", F.coalesce("group", "_node")).drop("_node")
    out = written(out, "groups")
    discard(edges)
    return out


def _one_by_one(rows: DataFrame, key: str, content: str, order: Sequence[str]) -> DataFrame:
    """The rows of each ``group`` that go in if they come in order; a group is in one task."""
    columns = [c for c in rows.columns if c != "group"]

    def admit(batches):
        group, keys, contents = None, set(), set()
        for batch in batches:
            keep = []
            for g, k, c in zip(*(batch.column(n).to_pylist() for n in ("group", key, content)), strict=True):
                if g != group:
                    group, keys, contents = g, set(), set()
                keep.append(k not in keys and c not in contents)
                if keep[-1]:
                    keys.add(k)
                    contents.add(c)
            yield batch.filter(pa.array(keep, pa.bool_())).select(columns)

    return rows.repartition("group").sortWithinPartitions("group", *order, key, content).mapInArrow(admit, rows.select(columns).schema)


def _first_of_both(left: DataFrame, key: str, content: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that are the first of both their key and their content, rows that share neither with
    these)."""
    firsts = [left.groupBy(k).agg(F.min_by(F.struct(key, content), F.struct(*order, key, content)).alias("x")).select("x.*") for k in (key, content)]
    taken = written(left.join(firsts[0].intersect(firsts[1]), [key, content], "left_semi").select(left.columns), "taken")
    rest = left.join(taken.select(key), key, "left_anti").join(taken.select(content), content, "left_anti").select(left.columns)
    return taken, written(rest, "left")


def admitted_in_order(rows: DataFrame, held: DataFrame, key: str, content: str, order: Sequence[str], barred: DataFrame | None = None) -> DataFrame:
    """Rows to append as if they came one by one in the order given: each whose content is not there
    yet, and then whose key is not; a row that goes in bars later ones of its content or key. Rows that
    hold a value of ``barred``, a column of the same name, are left out.

    Held keys and contents go first; then a row that is the first left of both its content and its
    key goes in and takes the others of either away. What is left then has keys and contents crossed:
    up to ``ORDERED_ROWS`` rows are taken one by one in a task, more are split into connected groups,
    each taken one by one in a task, but for groups of more than ``ORDERED_ROWS``, which go round by
    round. Keys and contents are not null. All this sees keys, contents and the order only; the rows
    themselves are read once more at the end, and sent on at most once, unsorted.
    """
    out = list(dict.fromkeys((*(barred.columns if barred is not None else ()), *order)))
    narrow = rows.select(key, content, *(c for c in out if c not in (key, content)))
    if barred is not None:
        narrow = narrow.join(barred, barred.columns, "left_anti").select(narrow.columns)
    if set(rows.columns) <= set(narrow.columns):
        return _admitted(first_by(narrow, [key, content], order), held, key, content, order).select(rows.columns)
    times = narrow.groupBy(key, content).agg(F.min_by(F.struct(*narrow.columns), F.struct(*order)).alias("x"), F.count("*").alias("_times")).select("x.*", "_times")
    admitted = written(_admitted(times, held, key, content, order), "admitted")
    same = [key, content, *(barred.columns if barred is not None else ())]
    found = meeting(rows, admitted.where("_times = 1").select(*same), same).select(rows.columns)
    if admitted.where("_times > 1").head(1):  # of rows that share both, the first
        found = found.unionByName(first_by(meeting(rows, admitted.where("_times > 1").select(*same), same).select(rows.columns), [key, content], order))
    return found


def meeting(rows: DataFrame, keys: DataFrame, on: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Wide rows joined with narrow keys: few keys go to the rows, else both are dealt out by key and the
    keys hashed, so that the rows are not sorted. ``keys`` is stored, so counting it is cheap. A semi-join
    takes nulls as equal, also because Spark would test its keys for null in a second run of their
    expressions."""
    keys = keys.hint("broadcast" if keys.count() <= SENT_ROWS else "shuffle_hash")
    if how != "left_semi":
        return rows.join(keys, list(on), how)
    named = keys.withColumnsRenamed({c: f"_{c}" for c in on})
    return rows.join(named, reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on)), how)


def _admitted(rows: DataFrame, held: DataFrame, key: str, content: str, order: Sequence[str]) -> DataFrame:
    """``admitted_in_order`` of narrow rows, one for each key and content."""
    left = rows.join(held.select(content), content, "left_anti").join(held.select(key), key, "left_anti").select(rows.columns)
    left = written(left, "left")
    taken, rest = _first_of_both(left, key, content, order)
    discard(left)
    found, n = [taken], rest.count()
    if 0 < n <= ORDERED_ROWS:
        found.append(written(_one_by_one(rest.withColumn("group", F.lit(0)), key, content, order), "taken"))
    elif n:
        groups = connected(rest, key, content)
        large = groups.groupBy("group").count().where(F.col("count") > ORDERED_ROWS).select("group")
        found.append(written(_one_by_one(groups.join(large, "group", "left_anti").select(groups.columns), key, content, order), "taken"))
        many = written(groups.join(large, "group", "left_semi").select(rows.columns), "left")
        while many.head(1):
            taken, after = _first_of_both(many, key, content, order)
            found.append(taken)
            discard(many)
            many = after
        discard(groups, many)
    discard(rest)
    return reduce(DataFrame.unionByName, found)


def new_chunks(chunks: DataFrame, held: DataFrame, barred: DataFrame | None = None) -> DataFrame:
    """Chunks to append in the order of (seq, chunk_id), each new by content and by id; those of the
    episodes in ``barred`` are left out. ``held`` needs chunk_id and content_key."""
    keyed = chunks.withColumn("chunk_text", canonicalise("chunk_text")).withColumn("content_key", dedup_key(F.col("chunk_text")))
    fresh = admitted_in_order(keyed, held, "chunk_id", "content_key", ["seq"], barred)
    return fresh.withColumn("content_hash", content_hash(F.col("chunk_text")))


def orphans(chunks: DataFrame, episodes: DataFrame) -> DataFrame:
    return chunks.join(episodes.select("episode_id"), "episode_id", "left_anti")


def require_no_orphans(chunks: DataFrame, episodes: DataFrame) -> None:
    if bad := orphans(chunks, episodes).select("chunk_id").head(1):
        raise Invariant(f"chunk {bad[0][0]} belongs to no episode")


def disagreeing(rows: DataFrame, expected: str) -> DataFrame:
    """Rows whose publisher is not the one in ``expected``."""
    return rows.where(~F.col("publisher").eqNullSafe(F.col(expected)))


def require_publishers(rows: DataFrame, expected: str) -> None:
    """Each row's publisher must be the one its file is named after."""
    if bad := disagreeing(rows, expected).select("publisher", expected).head(1):
        raise Invariant(f"publisher {bad[0][0]} in the file of {bad[0][1]}")


def governance_rows(episodes: DataFrame, now: int, allow: Sequence[str] = DEFAULT_RIGHTS) -> DataFrame:
    """One row an episode: the hash of its metadata if admitted, of its id if rejected."""
    ok = rights_allowed(F.col("rights_code"), allow)
    return episodes.select(
        F.col("publisher").alias("publisher_id"), "episode_id", "rights_code", F.lit(now).cast("long").alias("ingestion_date"),
        content_hash(F.when(ok, metadata_json(episodes)).otherwise(F.col("episode_id"))).alias("content_hash"), (~ok).alias("deprecated"),
    )


def ingest(episodes: DataFrame, chunks: DataFrame, held_episodes: DataFrame, held_chunks: DataFrame, allow: Sequence[str] = DEFAULT_RIGHTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(episodes to append, chunks to append, stats by publisher). Both inputs need ``seq``; chunks
    of rejected episodes are skipped."""
    ok = rights_allowed(F.col("rights_code"), allow)
    more = insert_or_ignore(episodes.where(ok), held_episodes, "episode_id", ["seq"])
    barred = episodes.where(~ok).select("episode_id").distinct()
    fresh = written(new_chunks(chunks, held_chunks, barred), "fresh")
    marks = ("episode", "ok", "new", "chunk", "usable", "chunk_new")
    row = lambda **of: [F.lit(1 if of.get(m) is True else 0).alias(m) if isinstance(of.get(m, False), bool) else of[m].cast("int").alias(m) for m in marks]
    of = episodes.groupBy("episode_id", "publisher").agg(F.max(~ok).alias("barred"))
    events = (
        episodes.select("publisher", *row(episode=True, ok=ok))
        .unionByName(more.select("publisher", *row(new=True)))
        .unionByName(chunks.select("episode_id").join(of, "episode_id").select("publisher", *row(chunk=True, usable=~F.col("barred"))))
        .unionByName(fresh.select("episode_id").join(of, "episode_id").select("publisher", *row(chunk_new=True)))
    )
    n = events.groupBy("publisher").agg(*(F.sum(m).alias(m) for m in marks))
    stats = n.select(
        "publisher", F.col("episode").alias("seen"), F.col("new").alias("inserted"), (F.col("ok") - F.col("new")).alias("existing"), (F.col("episode") - F.col("ok")).alias("rejected"),
        F.col("chunk").alias("chunks_seen"), F.col("chunk_new").alias("chunks_inserted"), (F.col("usable") - F.col("chunk_new")).alias("chunks_deduped"), (F.col("chunk") - F.col("usable")).alias("chunks_rights_skipped"),
    )
    return more, fresh, stats


def totals(stats: DataFrame) -> DataFrame:
    return stats.agg(*(F.sum(c).alias(c) for c in stats.columns if c != "publisher"))


def publisher_manifest(episodes: DataFrame, chunks: DataFrame) -> DataFrame:
    """Episodes and chunks by publisher; chunks are counted per episode before the join."""
    per = chunks.groupBy("episode_id").agg(F.count("chunk_id").alias("chunks"))
    return episodes.select("publisher", "episode_id").distinct().join(per, "episode_id", "left").groupBy("publisher").agg(
        F.count("episode_id").alias("episode_count"), F.coalesce(F.sum("chunks"), F.lit(0)).alias("chunk_count")
    )


def merge_slugs(seeds: Column, discovered: Column, cap: int | None = None) -> Column:
    """Seeds, then discovered slugs, each once; ``cap`` bounds the discovered ones."""
    found = F.array_distinct(discovered)
    return F.array_distinct(F.concat(seeds, F.slice(found, 1, cap) if cap else found))
