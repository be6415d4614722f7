"""Recall of the decontamination on many, on hot and on long benchmark items."""

from __future__ import annotations

import random
import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import decontam
from corpusloom.llm.wordhash import byte_table, hash_words, text_buffers


def found(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = decontam.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    return {(r.doc_id, r.item_id) for r in got}


def hashed(text):
    return hash_words(*text_buffers(pa.array([text], pa.large_string())), byte_table("alnum"))[0]


def prose(rng, n, size=6000):
    return " ".join(f"w{int(size ** rng.random())}" for _ in range(n))


def test_two_thousand_items(spark):
    rng = random.Random(3)
    items = [(k, prose(rng, rng.randrange(15, 60))) for k in range(2000)]
    docs = [(k, f"{prose(rng, 60)} {t} {prose(rng, 60)}") for k, t in items] + [(5000 + k, prose(rng, 150)) for k in range(500)]
    got = found(spark, docs, items)
    missed = [k for k, _ in items if (k, k) not in got]
    assert not missed, len(missed)
    assert len({d for d, _ in got if d >= 5000}) <= 5  # chance matches by the paraphrase rule


def test_item_several_times_in_a_third_of_the_documents(spark):
    rng = random.Random(4)
    item = " ".join(f"common{k}" for k in range(20))
    docs = [(k, " ".join(f"rare{k}x{j} {item if k % 3 == 0 and j % 20 == 0 else ''}" for j in range(60))) for k in range(90)]
    assert found(spark, docs, [(1, item), (2, prose(rng, 30))]) == {(k, 1) for k in range(0, 90, 3)}


def test_items_of_a_thousand_words(spark):
    rng = random.Random(5)
    items = [(k, prose(rng, 1000)) for k in range(30)]
    docs = [(k, f"{prose(rng, 200)} {t} {prose(rng, 200)}") for k, t in items] + [(100 + k, prose(rng, 1400)) for k in range(60)]
    got = found(spark, docs, items)
    assert got == {(k, k) for k in range(30)}, len([k for k in range(30) if (k, k) not in got])


def test_items_of_words_more_frequent_than_documents(spark):
    rng = random.Random(6)
    item = " ".join(f"often{k}" for k in range(40))
    swapped = " ".join(w if k % 3 else "z" for k, w in enumerate(item.split()))
    words = item.split()
    docs = [(k, " ".join(rng.choice(words) for _ in range(300))) for k in range(60)] + [(100, f"{prose(rng, 80)} {swapped} {prose(rng, 80)}")]
    assert (100, 1) in found(spark, docs, [(1, item), (2, prose(rng, 30))])


def test_paraphrased_items_of_a_thousand_words(spark):
    rng = random.Random(7)
    items = [(k, prose(rng, 1000)) for k in range(10)]
    docs = [(k, f"{prose(rng, 200)} {' '.join(w if j % 4 else f'z{j}' for j, w in enumerate(t.split()))} {prose(rng, 200)}") for k, t in items]
    assert found(spark, docs, items) == {(k, k) for k in range(10)}


@pytest.mark.parametrize("many, size", [(100, 40), (1000, 40), (3000, 30), (60, 500)])
def test_paraphrases_against_brute_force(spark, many, size):
    """Three words in ten replaced and words put in: of the items that the definition of a
    paraphrase takes in, nine in ten are found."""
    rng = random.Random(many)
    items = [(k, prose(rng, size)) for k in range(many)]
    docs, wanted = [], set()
    for k, text in items[:: max(1, many // 150)]:
        words = [w if rng.random() > 0.3 else f"w{int(6000 ** rng.random())}" for w in text.split() for _ in range(1 + (rng.random() < 0.03))]
        docs.append((k, f"{prose(rng, 80)} {' '.join(words)} {prose(rng, 80)}"))
        held = hashed(text)
        masks = decontam.places(held)
        if decontam.common_subsequence(size, [masks.get(h, 0) for h in hashed(" ".join(words)).tolist()]) >= decontam.PARAPHRASE * size:
            wanted.add((k, k))
    docs += [(10_000 + k, prose(rng, 200)) for k in range(400)]
    got = found(spark, docs, items)
    assert len(got & wanted) >= 0.9 * len(wanted), (len(got & wanted), len(wanted))


@pytest.mark.parametrize("many, size", [(1200, 30), (60, 500)])
def test_verbatim_by_latent_vectors_alone(spark, many, size):
    rng = random.Random(many)
    items = [(k, prose(rng, size)) for k in range(many)]
    docs = [(k, f"{prose(rng, 70)} {t} {prose(rng, 70)}") for k, t in items[::4]] + [(10_000 + k, prose(rng, 200)) for k in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    latent = decontam.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).where("cosine > 0").collect()
    wanted = {(k, k) for k, _ in items[::4]}
    got = {(r.doc_id, r.item_id) for r in latent} & wanted
    assert len(got) >= 0.99 * len(wanted), (len(got), len(wanted))


def test_groups_of_items_and_short_ones(spark, monkeypatch):
    rng = random.Random(8)
    items = [(k, prose(rng, 40)) for k in range(20)]
    docs = [(k, f"{prose(rng, 60)} {t} {prose(rng, 60)}") for k, t in items] + [(100, "yes"), (101, "well yes then"), (102, "yes, indeed"), (103, None), (104, "")]
    short = [(50, "Yes!"), (51, "yes indeed"), (52, None), (53, " .. ")]
    # an item of few words is held wherever it stands as a run
    wanted = {(k, k) for k in range(20)} | {(100, 50), (101, 50), (102, 50), (102, 51)}
    assert found(spark, docs, items + short) == wanted
    assert len(list(decontam.item_groups([(k, t, None) for k, t in items], 130))) == 7
    whole = decontam.item_groups
    monkeypatch.setattr(decontam, "item_groups", lambda rows, **more: whole(rows, 300, **more))
    assert found(spark, docs, items + short) == wanted


def test_short_items(spark):
    rng = np.random.default_rng(5)
    common = [f"common{k}" for k in range(50)]
    items = [(k, " ".join(f"rare{k}x{j}" for j in range(1 + k % 4))) for k in range(40)]
    docs = [(k, " ".join(rng.choice(common, 60)) + " " + text + " " + " ".join(rng.choice(common, 30))) for k, text in items]
    docs += [(100 + k, " ".join(reversed(text.split())) + " " + " ".join(rng.choice(common, 40))) for k, text in items if k % 4 == 3]  # not as a run
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontam.contaminated(d, i).collect()) == [(k, k) for k, _ in items]
    assert sorted(r.item_id for r in decontam.contaminated(d, i, least_words=3).collect()) == [k for k, _ in items if k % 4 >= 2]
    answered = spark.createDataFrame([(k, t, f"common{k}" if k % 2 else "nowhere") for k, t in items], "item_id long, text string, answer string")
    text = dict(docs)
    near = [k for k, _ in items if k % 2 and f"common{k}" in text[k].split()]
    found = [r.item_id for r in decontam.contaminated(d, answered, answer_col="answer").collect()]
    assert set(found) <= set(near) and found


def test_twenty_thousand_items_in_one_group(spark):
    rng = np.random.default_rng(6)
    words = np.array([f"w{k}" for k in range(20_000)])
    texts = [" ".join(rng.choice(words, 15)) for _ in range(20_000)]
    assert len(list(decontam.item_groups([(k, t, None) for k, t in enumerate(texts)]))) == 1
