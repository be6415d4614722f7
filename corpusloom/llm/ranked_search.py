"""Ranked lexical search by TPUT, the three-phase uniform threshold, over term-partitioned postings.

The postings of the queries' terms are one table of (term, impact, row), dealt out by ranges of it and
sorted within each, so the head of a term's list stands together and a long list spans many tasks.
For each query of m lists:

1. Heads: the first ``HEAD`` entries of each list, summed by document; the k best have their scores
   looked up, and the least of these is a lower bound.
2. Uniform threshold: every list is fetched down to the bound over m, and over ``SHARE``; a document
   that no list is fetched for is below the bound. Of the others, those stay whose sum, with the most that each list
   not seen can add, reaches the bound, and then the k-th best sum of this phase.
3. Look-up: the entries of those that stay are fetched from all lists and summed exactly.

Impacts are whole numbers, so sums and comparisons are exact and ties are kept to the end.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.storage import discard, written
from corpusloom.llm.topk import first_k
from corpusloom.llm.wordhash import IdBitmap, words_of

TOP = 10
#: Entries of a list's head.
HEAD = 256
#: For each of the k places, documents whose scores are looked up for the first bound.
SEEDS = 10
#: The threshold is the bound over m, and over this: lower than it need be, since an entry more costs
#: less than a look-up more. On 0.1 GB, 1 leaves 3.1 million pairs to look up, 3 leaves 23,000.
SHARE = 3
#: Lines of postings, and pairs of documents and queries, that a task handles at once.
LINES, CELLS = 1 << 19, 1 << 21
#: Rows of a table that may be sent to all tasks, at 24 to 40 bytes a row; larger ones are shuffled.
BROADCAST_ROWS = 200_000
POSTING = "term long, row long, doc_id long, tf long, n long"


def _counted(batches, held: IdBitmap | None = None):
    """A row for each distinct term of each text that ``held`` may hold (all without it): tf, and n,
    the text's terms with repeats. Rows without a term sum up a slice: in tf the texts with terms, in
    n all their terms. Terms are 64-bit hashes of runs of letters, digits and bytes above 127."""
    for batch in batches:
        ids, rows = batch.column("doc_id"), batch.column("row").to_numpy()
        for i, j, hashes, _, first, _ in words_of(batch.column("text"), "alnum"):
            n = np.diff(first)
            doc, terms = np.repeat(np.arange(j - i), n), hashes.view(np.int64)
            if held is not None:
                keep = held.holds(terms)
                doc, terms = doc[keep], terms[keep]
            order = np.lexsort((terms, doc))
            doc, terms = doc[order], terms[order]
            starts = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (doc[1:] != doc[:-1])]) if len(terms) else np.empty(0, np.int64)
            tf, at = np.diff(np.r_[starts, len(terms)]), doc[starts]
            null = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(terms[starts], pa.int64()), null]), pa.concat_arrays([pa.array(rows[i:j][at], pa.int64()), null]),
                    pa.concat_arrays([ids.slice(i, j - i).take(pa.array(at)), null]), pa.array(np.r_[tf, (n > 0).sum()], pa.int64()), pa.array(np.r_[n[at], n.sum()], pa.int64()),
                ],
                ["term", "row", "doc_id", "tf", "n"],
            )


def _terms(texts: DataFrame, held: IdBitmap | None = None) -> DataFrame:
    """``texts`` has doc_id, row and text."""
    return texts.mapInArrow(lambda batches: _counted(batches, held), POSTING)


def _sized(df: DataFrame) -> DataFrame:
    """For all tasks if it has ``BROADCAST_ROWS`` rows at most, by a count."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class _Asked:
    """The lists that a group of queries asks for, by term and by query, as arrays."""

    def __init__(self, q, term, least, unseen, bound):
        self.ids, q = np.unique(q, return_inverse=True)
        self.terms, t = np.unique(term, return_inverse=True)
        by_term, by_query = np.argsort(t, kind="stable"), np.argsort(q, kind="stable")
        self.of_term, self.q = np.searchsorted(t[by_term], np.arange(len(self.terms) + 1)), q[by_term]
        self.least, self.unseen = least[by_term], unseen[by_term]
        self.of_query, self.t = np.searchsorted(q[by_query], np.arange(len(self.ids) + 1)), t[by_query]
        self.all = np.bincount(q, weights=unseen, minlength=len(self.ids))
        self.bound = np.zeros(len(self.ids))
        self.bound[q] = bound

    @classmethod
    def of(cls, lists: DataFrame) -> _Asked:
        """``lists`` has (q, term, least, unseen, bound), or the first two only."""
        names = ["q", "term", "least", "unseen", "bound"]
        found = lists.select("q", "term", *(c if c in lists.columns else F.lit(0).cast("long").alias(c) for c in names[2:])).toArrow()
        return cls(*(found.column(n).to_numpy() for n in names))

    def known(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each term, and whether it is asked for."""
        at = np.minimum(np.searchsorted(self.terms, terms), max(len(self.terms) - 1, 0))
        return at, self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)


def _expanded(first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``at`` the places first[at] .. first[at + 1] - 1, and which of ``at`` each is of."""
    n = first[at + 1] - first[at]
    of = np.repeat(np.arange(len(at)), n)
    return np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum()), of


def _whole_rows(batches, most: int):
    """Tables of about ``most`` lines each, cut between documents; ``batches`` are in order of row."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= most:
            table = pa.Table.from_batches(held).combine_chunks()
            rows = table.column("row").to_numpy()
            cut = int(np.searchsorted(rows, rows[-1]))
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            size = len(table) - cut
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def _fetched(batches, asked: _Asked):
    """Phase 2 for the documents of a task: (q, row, sum, most) where the most that the score can be
    reaches the bound. Sums are whole numbers below 2**53, so doubles hold them exactly."""
    width = len(asked.ids)
    for table in _whole_rows(batches, LINES):
        at, known = asked.known(table.column("term").to_numpy())
        impact, rows = table.column("impact").to_numpy()[known], table.column("row").to_numpy()[known]
        own, local = np.unique(rows, return_inverse=True)
        for lo in range(0, len(own), step := max(1, CELLS // max(width, 1))):
            part = slice(np.searchsorted(local, lo), np.searchsorted(local, lo + step))
            place, of = _expanded(asked.of_term, at[known][part])
            taken = impact[part][of] >= asked.least[place]
            place, of = place[taken], of[taken]
            cells, n = (local[part][of] - lo) * width + asked.q[place], min(step, len(own) - lo)
            total = np.bincount(cells, weights=impact[part][of], minlength=n * width)
            most = total + np.tile(asked.all, n) - np.bincount(cells, weights=asked.unseen[place], minlength=n * width)
            live = np.flatnonzero((total > 0) & (most >= np.tile(asked.bound, n)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked.ids[live % width]), pa.array(own[lo + live // width]), pa.array(total[live].astype(np.int64)), pa.array(most[live].astype(np.int64))], ["q", "row", "sum", "most"]
            )


def _looked_up(batches, asked: _Asked):
    """Phase 3 for the documents of a task: the exact scores of pairs, which come as lines with q
    among the documents' postings, lines with a term."""
    for table in _whole_rows(batches, LINES):
        pair = table.column("term").is_null().to_numpy() if table.column("term").null_count else np.zeros(len(table), bool)
        if not pair.any():
            continue
        posts, pairs = table.filter(pa.array(~pair)), table.filter(pa.array(pair))
        at, known = asked.known(posts.column("term").to_numpy())
        rows = posts.column("row").to_numpy()
        own, local = np.unique(rows, return_inverse=True)
        key = local * len(asked.terms) + at
        order = np.argsort(key[known], kind="stable")
        keys, impacts = key[known][order], posts.column("impact").to_numpy()[known][order]
        q, row = np.searchsorted(asked.ids, pairs.column("q").to_numpy()), np.searchsorted(own, pairs.column("row").to_numpy())
        place, of = _expanded(asked.of_query, q)
        wanted = row[of] * len(asked.terms) + asked.t[place]
        spot = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        score = np.bincount(of, weights=np.where(keys[spot] == wanted, impacts[spot], 0) if len(keys) else None, minlength=len(q)) if len(of) else np.zeros(len(q))
        first = np.searchsorted(local, np.arange(len(own)))
        yield pa.RecordBatch.from_arrays(
            [pairs.column("q").combine_chunks(), pairs.column("row").combine_chunks(), posts.column("doc_id").combine_chunks().take(pa.array(first[row])), pa.array(score.astype(np.int64))], ["q", "row", "doc_id", "score"]
        )


def _exact(index: DataFrame, asked: _Asked, pairs: DataFrame) -> DataFrame:
    """(q, row, doc_id, score) of pairs (q, row), each of a document with postings."""
    n = pairs.count()
    posts = index.join(F.broadcast(pairs.select("row").distinct()), "row", "left_semi") if n <= BROADCAST_ROWS else index
    lines = posts.select("row", "term", "impact", "doc_id", F.lit(None).cast("long").alias("q"))
    none = F.lit(None).cast("long")
    lines = lines.unionByName(pairs.select("row", none.alias("term"), none.alias("impact"), none.alias("doc_id"), "q"))
    return lines.repartition("row").sortWithinPartitions("row").mapInArrow(lambda b: _looked_up(b, asked), "q long, row long, doc_id long, score long")


def _thresholds(lists: DataFrame) -> DataFrame:
    """``lists`` (q, term, top, bound) with ``least``, the threshold of all lists of a query: a document
    below it in each of the m lists is below the bound; and ``unseen``, the most that a list adds to a
    document that it was not fetched for."""
    least = lists.groupBy("q").agg(F.greatest(F.lit(1), F.expr(f"max(bound) div ({SHARE} * count(*))")).alias("least"))
    return lists.join(least, "q").withColumn("unseen", F.least(F.col("least") - 1, F.col("top")))


def _postings(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(term, impact, row, doc_id) of the terms asked for, by term and falling impact."""
    raw = written(_terms(docs, IdBitmap.of(asked.select("term"), "term")), "raw")
    docs_n, all_n = (int(x or 0) for x in raw.where("term is null").agg(F.sum("tf"), F.sum("n")).first())
    counts = raw.where("term is not null").groupBy("term").agg(F.count("*").alias("df")).join(asked.select("term").distinct(), "term", "left_semi")
    weights = written(counts.select("term", F.floor(1000 * F.log((2.0 * F.lit(docs_n) + 2) / (2.0 * F.col("df") + 1))).cast("long").alias("w")).where("w > 0"), "weights")
    found = raw.where("term is not null").join(_sized(weights), "term")
    m = F.expr(f"100 - 90 + ((90 * n * {docs_n}L) div {max(all_n, 1)}L)")
    impact = found.withColumn("m", m).withColumn("impact", F.expr("w * ((1000000000 * tf) div (1000 * tf + 8 * m))")).where("impact > 0")
    order = [F.col("term"), F.desc("impact"), F.col("row")]
    index = written(impact.select("term", "impact", "row", "doc_id").repartitionByRange(*order).sortWithinPartitions(*order), "postings")
    discard(raw, weights)
    return index


def _best(index: DataFrame, lists: DataFrame, heads: DataFrame, k: int) -> DataFrame:
    """(q, row, doc_id, score, rank) of the k best documents of each query in ``lists``."""
    asked, half = _Asked.of(lists), [F.desc("sum")]
    one = heads.join(_sized(lists.select("q", "term")), "term").groupBy("q", "row").agg(F.sum("impact").alias("sum"))
    first = written(first_k(one, ["q"], half, SEEDS * k, "place", "row").select("q", "row"), "first")
    sure = first_k(_exact(index, asked, first), ["q"], [F.desc("score")], k, "place", "row").where(F.col("place") == k)
    limits = _thresholds(lists.join(sure.select("q", F.col("score").alias("bound")), "q", "left").withColumn("bound", F.coalesce("bound", F.lit(0))))
    limits = written(limits.select("q", "term", "top", "bound", "least", "unseen"), "limits")
    asked = _Asked.of(limits)

    cut = written(limits.where("top >= least").groupBy("term").agg(F.min("least").alias("cut")), "cut")
    entries = index.select("term", "impact", "row").join(_sized(cut), "term").where("impact >= cut").drop("cut")
    two = entries.repartition("row").sortWithinPartitions("row").mapInArrow(lambda b: _fetched(b, asked), "q long, row long, sum long, most long")
    two = written(two, "two")
    second = first_k(two.select("q", "row", "sum"), ["q"], half, k, "place", "row").where(F.col("place") == k).select("q", F.col("sum").alias("second"))
    left = written(two.join(_sized(second), "q", "left").where(F.col("most") >= F.coalesce("second", F.lit(0))).select("q", "row"), "left")

    best = first_k(_exact(index, asked, left), ["q"], [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("row")], k, "rank", "row")
    best = written(best, "best")
    discard(first, limits, cut, two, left)
    return best


def ranked(docs: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", query_id_col: str = "item_id", query_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each query's k best documents of a score above 0, fewer where
    there are fewer; equal scores by ascending id.

    Rows are documents: a null text has no terms, repeated rows count and rank each, a row without an
    id ranks behind equal scores. Repeated query rows count once; queries of one id and different
    texts have a list each. Queries without terms, and empty tables, give no rows. Other columns are
    ignored. Terms are told apart by 64-bit hashes; texts are read whole, a slice at a time. Queries go
    to the tasks in groups of about ``BROADCAST_ROWS`` terms together; the postings are built once.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"))
    asked = queries.select(F.col(query_id_col).cast("long").alias("doc_id"), F.col(query_text_col).cast("string").alias("text")).distinct()
    asked = _terms(asked.withColumn("row", F.monotonically_increasing_id())).where("term is not null")
    asked = written(asked.select(F.col("row").alias("q"), F.col("doc_id").alias("item_id"), "term"), "asked")
    index = _postings(texts, asked)
    heads = written(first_k(index.select("term", "impact", "row"), ["term"], [F.desc("impact"), F.col("row")], max(k, HEAD), "place", "row"), "heads")
    lists = written(asked.join(heads.where("place = 1").select("term", F.col("impact").alias("top")), "term"), "lists")
    groups = -(-lists.count() // BROADCAST_ROWS)
    found = [_best(index, lists.where(F.pmod(F.xxhash64("q"), F.lit(groups)) == g).select("q", "term", "top"), heads, k) for g in range(groups)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = reduce(DataFrame.unionByName, found).join(_sized(lists.select("q", "item_id").distinct()), "q")
    best = written(best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "ranked")
    discard(asked, index, heads, lists, *found)
    return best
