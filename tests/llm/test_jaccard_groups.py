"""Large groups of near copies, and hot n-grams, against all pairs."""

import random

import numpy as np
import pytest

from corpusloom.llm import jaccard_join


def templates(rng: random.Random, sizes: tuple[int, ...]) -> list[tuple[int, str]]:
    """Texts of several templates that share their first half; each text differs in up to six places."""
    half = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    rows = []
    for size in sizes:
        base = half + [f"w{rng.randrange(10**6)}" for _ in range(100)]
        places = rng.sample(range(0, 200, 8), 6)
        for _ in range(size):
            words = list(base)
            for at in places[: rng.randrange(7)]:
                words[at] = f"x{at}y{rng.randrange(12)}"
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows


def by_all_pairs(rows: list[tuple[int, str]], k: int, percent: int) -> dict[int, tuple[int, int, int]]:
    """(number of shingles, links, component) of each id, from the matrix of all intersections."""
    sets = [{tuple(w[i : i + k]) for i in range(len(w) - k + 1)} for w in (t.split() for _, t in rows)]
    place = {g: i for i, g in enumerate(sorted(set().union(*sets)))}
    held = np.zeros((len(rows), len(place)), np.float32)
    for i, s in enumerate(sets):
        held[i, [place[g] for g in s]] = 1
    sizes = held.sum(1)
    least = np.array([doc for doc, _ in rows])
    common = held @ held.T
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    while True:
        lower = np.array([least[x].min() for x in linked])
        if (lower == least).all():
            break
        least = lower
    return {doc: (int(sizes[i]), int(linked[i].sum()) - 1, int(least[i])) for i, (doc, _) in enumerate(rows)}


@pytest.mark.parametrize("sizes, part_sets, hot", [((3200, 1500, 300), 1024, 14), ((150, 60, 40, 1, 1), 32, 14), ((150, 60, 40, 1, 1), 32, 0)])
def test_groups_of_near_copies(spark, monkeypatch, sizes, part_sets, hot):
    monkeypatch.setattr(jaccard_join, "PART_SETS", part_sets)
    monkeypatch.setattr(jaccard_join, "HOT_OCTAVE", hot)
    rows = templates(random.Random(sum(sizes) + hot), sizes)
    wanted = by_all_pairs(rows, 4, 85)
    assert len({x[2] for x in wanted.values()}) >= 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.n_links, r.component_id) for r in jaccard_join.ngram_jaccard_classes(df, 4, 85).collect()}
    assert got == wanted
    classes = jaccard_join.ngram_jaccard_classes(df, 4, 85, links=False)
    assert classes.columns == ["doc_id", "n_shingles", "component_id"]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in classes.collect()} == {doc: (x[0], x[2]) for doc, x in wanted.items()}


def test_a_part_of_a_hot_gram_gives_its_first(monkeypatch):
    """Both parts of a gram tie to their own first set; a gram that is not hot gives its pairs."""
    import pyarrow as pa

    rows = [(5, 1, 10), (5, 1, 10), (5, 1, 12), (5, 2, 11), (7, 0, 20), (7, 0, 21)]
    gram, part, sid = zip(*rows, strict=True)
    same = np.full(len(rows), 9)
    batch = pa.RecordBatch.from_arrays([pa.array(gram), pa.array(part, pa.int32()), pa.array(sid), pa.array(same, pa.int32()), pa.array(same, pa.int8()), pa.array(same, pa.int8())], ["gram", "part", "sid", "n", "ell", "low"])
    got = sorted((r["kind"], r["a"], r["b"]) for out in jaccard_join._candidates(80)([batch]) for r in out.to_pylist())
    assert got == [(0, 20, 21), (1, 10, 10), (1, 10, 12), (1, 11, 11), (2, 5, 10), (2, 5, 11)]
