"""Line deduplication over levelled sorted runs of line hashes, in DataFrame operations only.

Documents come in batches of descending ids. The distinct line keys of a batch, as 128-bit hashes with
the number of rows that hold them and the largest id among these, are merge-anti-joined with the runs
of all batches before; what is new becomes a run of its own, what is there already is a hit. Runs are
bucketed and sorted by hash, so the joins move no run; whenever a level holds ``FAN`` runs, they are
merged into one of the next level. Since batches descend, the id in a run is the largest that holds the
key, and the rows of a key are those of its run and of its hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.storage import bucketed, discard, discard_bucketed, written, written_by

#: What is stripped at both ends of a line, and the letters that are lowered.
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS, LEAST_DOCS = 20, 3
BATCHES, FAN = 4, 2
KEY = ["h", "g"]


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(BLANK))
    # lower() is the faster way to the same where all is ASCII
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is made once a row."""
    return F.get(F.transform(F.array(value), body), 0)


def keyed_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """(doc_id, th, pos, h, g, first): lines with a key of ``least_chars`` code points at least. th
    tells rows of one id apart; ``first`` marks one line for each key of a row."""

    def hashed(line: Column, pos: Column) -> Column:
        return _bound(line_key(line), lambda k: F.struct(F.xxhash64(k).alias("h"), F.xxhash64(F.lit(1), k).alias("g"), pos.alias("pos"), F.length(k).alias("n")))

    def flagged(held: Column) -> Column:
        """In order of key, each with whether the one before has another key."""
        before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,g:bigint,pos:int,n:int>")), F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0))))
        new = lambda x, y: y["h"].isNull() | (x["h"] != y["h"]) | (x["g"] != y["g"])
        return F.zip_with(held, before, lambda x, y: F.when(x.isNotNull(), F.struct(x["h"].alias("h"), x["g"].alias("g"), x["pos"].alias("pos"), new(x, y).alias("first"))))

    long = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.when(F.length(x) >= least_chars, hashed(x, i))), lambda x: x["n"] >= least_chars)
    rows = docs.select("doc_id", F.hash("text").alias("th"), F.explode(F.filter(flagged(F.array_sort(long)), lambda x: x.isNotNull())).alias("x"))
    return rows.select("doc_id", "th", "x.*")


class LineRuns:
    """Levelled sorted runs of line keys: (h, g, n, owner), each key in one run."""

    def __init__(self, fan: int = FAN):
        self.levels: list[list[DataFrame]] = [[]]
        self.hits: list[DataFrame] = []
        self.fan = fan

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _compact(self) -> None:
        """Merges the runs of each full level into one of the next."""
        for k, level in enumerate(self.levels):
            if len(level) >= self.fan:
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(bucketed(reduce(DataFrame.unionByName, level), KEY))
                discard_bucketed(*level)
                self.levels[k] = []

    def add(self, lines: DataFrame) -> None:
        """Takes in the lines (doc_id, h, g, first) of a batch of ids below those of all before."""
        self._compact()
        batch = bucketed(lines.where("first").groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("owner")), KEY)
        held = self.runs
        if not held:
            self.levels[0].append(batch)
            return
        new = bucketed(reduce(lambda left, run: left.join(run.select(*KEY), KEY, "left_anti"), held, batch), KEY)
        self.hits.append(written(batch.join(new.select(*KEY), KEY, "left_anti").select(*KEY, "n"), "hits"))
        discard_bucketed(batch)
        self.levels[0].append(new)

    def repeated(self, least_docs: int) -> DataFrame:
        """(h, g, owner) of keys with ``least_docs`` rows at least."""
        if not self.hits:
            return reduce(DataFrame.unionByName, [run.where(F.col("n") >= least_docs).select(*KEY, "owner") for run in self.runs])
        more = reduce(DataFrame.unionByName, self.hits).groupBy(*KEY).agg(F.sum("n").alias("more"))
        found = [run.join(more, KEY, "left").where(F.col("n") + F.coalesce("more", F.lit(0)) >= least_docs).select(*KEY, "owner") for run in self.runs]
        return reduce(DataFrame.unionByName, found)

    def discard(self) -> None:
        discard_bucketed(*self.runs)
        discard(*self.hits)


def _batch(docs: DataFrame, batches: int) -> Column:
    """The batch of a row: 0 for the largest ids, rows without an id in the last."""
    steps = [k / batches for k in range(1, batches)]
    bounds = docs.agg(F.percentile_approx("doc_id", steps, 10_000)).first()[0] or []
    above = reduce(Column.__add__, [(F.col("doc_id") <= b).cast("int") for b in bounds], F.lit(0))
    return F.coalesce(above, F.lit(batches - 1))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): each text without the lines whose key, stripped and with A-Z
    lowered, has ``least_chars`` code points and is held by ``least_docs`` rows, but for those in the
    largest id that holds it.

    One row per row of ``docs``; other columns are ignored. A null or empty text is one empty line.
    Each row counts as a document of its own, so repeated rows count each; all rows of the largest id
    keep their lines. A row without an id comes below all ids; where only such rows hold a key, its
    lines stay. An empty table gives none. Long texts are handled line by line within their row.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    lines = written_by(keyed_lines(docs, least_chars).withColumn("batch", _batch(docs, batches)), "lines", "batch")
    runs = LineRuns()
    for k in range(batches):
        runs.add(lines.where(F.col("batch") == k))
    doomed = written(runs.repeated(least_docs).where("owner is not null"), "repeated")
    runs.discard()
    below = F.col("doc_id").isNull() | (F.col("doc_id") < F.col("owner"))
    gone = lines.join(doomed, KEY).where(below).groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(F.collect_set("pos").alias("_gone"))
    gone = written(gone, "gone")
    discard(lines, doomed)
    held, n = F.split("text", "\n"), F.size(F.split("text", "\n"))
    left = _bound(held, lambda x: F.transform(F.array_except(F.sequence(F.lit(0), n - 1), F.col("_gone")), lambda i: F.get(x, i)))
    # always by a shuffle, so that the plan does not change with the number of lines that go
    both = docs.withColumn("th", F.hash("text")).join(gone.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    return both.select(
        "doc_id", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text"),
        n.cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def dedup_lines_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped, kept_sha256."""
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
