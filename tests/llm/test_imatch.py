"""I-Match against a plain Python version, with production parameters and a hot third of copies."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest
import xxhash

from corpusloom.llm import imatch


def h64(data: bytes, seed: int = 42) -> int:
    return xxhash.xxh64(data, seed=seed % 2**64).intdigest()


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def keys_of(text):
    """Hashes of the distinct terms, as signed numbers in ascending order."""
    terms = {t for t in re.findall(r"[^\W_]+", text.lower()) if t}
    return sorted(signed(h64(t.encode())) for t in terms)


def hash_all(keys):
    seed = 42
    for k in keys:
        seed = h64((k % 2**64).to_bytes(8, "little"), seed)
    return seed


def lexicon(texts):
    df, distinct = {}, set(texts)
    for t in distinct:
        for slot in {k % imatch.SLOTS for k in keys_of(t)}:
            df[slot] = df.get(slot, 0) + 1
    return {s for s, n in df.items() if n >= imatch.MIN_DOCS and math.log(len(distinct) / n) >= imatch.MIN_IDF}


def print_of(text, held):
    keys, parts, at = keys_of(text), [], imatch.SLOT_BITS
    mine = [k for k in keys if k % imatch.SLOTS in held]
    for down, split in imatch.LEVELS:
        mine = [k for k in mine if (k >> at) % 2**down == 0]
        at += down
        for j in range(2**split):
            subset = [k for k in mine if (k >> at) % 2**split == j]
            parts.append(f"{hash_all(subset):016x}" if subset else "")
        at += split
    return parts + [f"{hash_all(keys):016x}" if keys else f"{h64(b'text', h64(text.encode())):016x}"]


def near(a, b):
    used = [(x, y) for x, y in zip(a, b, strict=True) if x or y]
    return sum(x == y for x, y in used) / len(used)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    words = [f"w{k}" for k in range(600)] + ["Älter", "straße", "日本", "x²"]
    prose = lambda n: " ".join(words[int(len(words) * rng.random() ** 2)] for _ in range(n))
    hot = prose(150)
    found = [hot if k % 3 == 0 else prose(rng.randrange(1, 400)) for k in range(240)]
    return found + ["", "", None, "!!!", "...", "one", "One!", "sole unknownword", "other rareword"]


def test_against_brute_force(spark, texts):
    df = spark.createDataFrame([(7 * k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, fingerprint string").repartition(5)
    plain = [t or "" for t in texts]
    held = lexicon(plain)
    got = {r.doc_id: r for r in imatch.imatch_edits(df).collect()}
    better = 0
    for k, t in enumerate(plain):
        following, half = plain[(k + 1) % len(plain)], len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        a, b, c = (print_of(x, held) for x in (t, edited, following))
        r = got[7 * k]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (".".join(a), ".".join(b))
        assert r.near_edited == pytest.approx(near(a, b)) and r.near_next == pytest.approx(near(a, c))
        better += r.near_edited > r.near_next
    assert better >= 0.85 * len(plain)
    prints = {}
    for k, t in enumerate(plain):
        prints.setdefault(got[7 * k].fingerprint, set()).add(tuple(keys_of(t)) or t)
    assert all(len(v) == 1 for v in prints.values())
    assert {r.doc_id: r.fingerprint for r in imatch.imatch(df).collect()} == {i: r.fingerprint for i, r in got.items()}


def test_ranges(spark, monkeypatch):
    """The same rows in many small ranges, with repeated and missing ids."""
    monkeypatch.setattr(imatch, "RANGE_ROWS", 0.01)
    monkeypatch.setattr(imatch, "GRID", 4)
    rng = random.Random(3)
    rows = [(rng.choice([None, 5, k, -(k**3), 10**15 + k * 10**9]), f"text {k % 70}") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(h64(r[1].encode())), r[1]))
    wanted = sorted((str(i), t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order))
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in imatch.with_next(df).collect()) == wanted


def test_empty_and_single(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert imatch.imatch_edits(none).collect() == [] and imatch.imatch(none).collect() == []
    one = imatch.imatch_edits(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
