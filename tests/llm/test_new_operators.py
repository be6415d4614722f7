"""Ranked search, line deduplication and collocations against brute force on hard cases."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from corpusloom.llm import collocations, line_dedup, ranked_search

DOC = "doc_id long, text string, lang string, row long, term string, score long, pos int"
EMPTY = [(None, None)]


def table(spark, rows, lang="en"):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, 1, "x", 2, 3) for i, t in rows], DOC)


# -- ranked search -------------------------------------------------------------------------------


def by_scoring_all(docs, items, k):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    held = [(i, Counter(words(t))) for i, t in docs]
    n_docs, n_all = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in held:
            n = sum(c.values())
            m = 10 + (90 * n * n_docs) // n_all if n_all else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in set(words(text)) if c[w])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


def ranked(spark, docs, items, k=10):
    q = spark.createDataFrame(items, "item_id long, text string")
    return Counter(map(tuple, ranked_search.ranked(table(spark, docs).repartition(3), q, k).collect()))


def test_ranked_equals_scoring_all(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(60)] + ["Élan", "élan", "it's", "日本", "a_b"]
    prose = lambda n: " ".join(words[int(len(words) * rng.random() ** 2)] for _ in range(n))
    docs = [(k, prose(rng.randrange(0, 60))) for k in range(150)]
    docs += [(200 + k, docs[3][1]) for k in range(40)] + [(3, docs[3][1])] * 2 + [(300, None), (301, ""), (302, " .,\n"), (None, docs[4][1]), (303, "w1 " * 5000)]
    items = [(k, prose(rng.randrange(1, 20))) for k in range(12)] + [(1, docs[3][1]), (2, None), (None, "w1 w2"), (4, "nowhere"), (5, "w0")] * 2
    assert ranked(spark, docs, items) == by_scoring_all(docs, items, 10)
    assert ranked(spark, docs, items, 3) == by_scoring_all(docs, items, 3)
    # groups of queries, no table sent to all tasks, lines cut within a document
    monkeypatch.setattr(ranked_search, "BROADCAST_ROWS", 40)
    monkeypatch.setattr(ranked_search, "LINES", 50)
    monkeypatch.setattr(ranked_search, "CELLS", 30)
    assert ranked(spark, docs, items) == by_scoring_all(docs, items, 10)


def test_ranked_empty(spark):
    assert not ranked(spark, [], [(1, "a")]) and not ranked(spark, [(1, "a b")], []) and not ranked(spark, EMPTY, EMPTY)


# -- line deduplication --------------------------------------------------------------------------


def lines_one_by_one(docs, least_chars=20, least_docs=3):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    rows, owner = Counter(), {}
    for i, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            rows[k] += 1
            owner[k] = max((x for x in (owner.get(k), i) if x is not None), default=None)
    out = []
    for i, t in docs:
        gone = lambda k, i=i: len(k) >= least_chars and rows[k] >= least_docs and owner[k] is not None and (i is None or i < owner[k])
        kept = [x for x in (t or "").split("\n") if not gone(key(x))]
        out.append((i, "\n".join(kept), len((t or "").split("\n")), len((t or "").split("\n")) - len(kept)))
    return Counter(out)


def deduped(spark, docs):
    return Counter(map(tuple, line_dedup.dedup_lines(table(spark, docs).repartition(3)).collect()))


def test_lines_equal_one_by_one(spark):
    rng = random.Random(12)
    pool = [f"Line number {k} that is long enough" for k in range(30)] + ["short", "", "É" * 19 + "a", "É" * 20, "  \t", "exactly twenty chars"]
    dress = lambda x: rng.choice(["", " ", "\t\r", "\x0b"]) + rng.choice([x, x.upper() if x.isascii() else x]) + rng.choice(["", "  ", "\x0c"])
    docs = [(k, "\n".join(dress(rng.choice(pool)) for _ in range(rng.randrange(0, 12)))) for k in range(80)]
    docs += [(90, None), (91, ""), (92, "\n\n"), (7, docs[7][1]), (7, pool[0]), (None, pool[1]), (None, "\n".join([pool[2]] * 3)), (93, "\n".join(pool[3:6] * 400))]
    docs += [(None, "A line that only rows without an id hold")] * 4
    assert deduped(spark, docs) == lines_one_by_one(docs)
    hot = [(k, f"A very common line of all\nown line of number {k:06}") for k in range(300)]
    assert deduped(spark, hot) == lines_one_by_one(hot)


def test_lines_empty(spark):
    assert not deduped(spark, [])
    assert deduped(spark, EMPTY) == Counter([(None, "", 1, 0)])


def test_runs_are_merged_by_levels(spark):
    runs = line_dedup.LineRuns(fan=2)
    for k in range(5):
        lines = spark.createDataFrame([(100 - 10 * k - j, h, h, True) for j in range(3) for h in (k, 1000)], "doc_id long, h long, g long, first boolean")
        runs.add(lines)
    assert [len(level) for level in runs.levels] == [1, 0, 1] and len(runs.hits) == 4
    found = {(r.h, r.owner) for r in runs.repeated(3).collect()}
    assert found == {(k, 100 - 10 * k) for k in range(5)} | {(1000, 100)}
    runs.discard()


# -- collocations --------------------------------------------------------------------------------


def phrases_by_counting(docs, lang, least, top):
    f, n = Counter(), 0
    for _, t in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n += len(w)
            for size in (1, 2, 3):
                f.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    inside = defaultdict(int)
    for p, a in f.items():
        if len(p) == 3 and a >= least:
            for q in (p[:2], p[1:]):
                inside[q] = max(inside[q], a)
    rows = []
    for p, a in f.items():
        if len(p) > 1 and a >= least and not 100 * inside[p] >= 50 * a:
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
    return [(lang, rank, x[2].decode(), -x[1], x[3], x[4], n, -x[0]) for rank, x in enumerate(sorted(rows)[:top], 1)]


def mined(spark, docs, lang="en", **more):
    return sorted(map(tuple, collocations.collocations(table(spark, docs, lang).repartition(3), **more).collect()))


@pytest.mark.parametrize("bits", [16, 3])
def test_collocations_equal_counting(spark, bits):
    """With a sketch of eight counters everything survives, and the counts are the same."""
    rng = random.Random(13)
    words = [f"w{k}" for k in range(25)] + ["Née", "it's", "日本", "NBSP in"]
    ends = [" ", "  ", "\t", ". ", ",", "!", "\n", "\x0b", " ; "]
    text = lambda n: "".join(words[int(len(words) * rng.random() ** 2)].upper() + rng.choices(ends, [60, 5, 5, 6, 6, 2, 6, 2, 2])[0] for _ in range(n))
    docs = [(k, text(rng.randrange(0, 50))) for k in range(120)] + [(1, "aa aa aa aa " * 9), (2, None), (3, ""), (4, " . "), (None, "new york city " * 12), (5, "new york city, " * 12)] * 2
    assert mined(spark, docs, bits=bits) == sorted(phrases_by_counting(docs, "en", 10, 2000))
    assert mined(spark, docs, top=7, least=4) == sorted(phrases_by_counting(docs, "en", 4, 7))


def test_collocations_by_language(spark):
    docs = spark.createDataFrame([("red wine " * 10, None), ("red wine " * 9, "fr"), ("red wine", "fr"), ("red wine " * 9, "de")], "text string, lang string")
    got = {r.lang: (r.phrase, r.a) for r in collocations.collocations(docs).where("rank = 1").collect()}
    assert got == {"und": ("red wine", 10), "fr": ("red wine", 10)}


def test_collocations_empty(spark):
    assert not mined(spark, []) and not mined(spark, EMPTY)


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**12 + 7, 3 * 10**12 + 1, 10**12 + 9)], "a long, l long, r long")
    a, left, right = 10**12 + 7, 3 * 10**12 + 1, 10**12 + 9
    assert row.select(collocations._score(row.a, row.l, row.r)).first()[0] == 10**6 * a * a // (left * right)
