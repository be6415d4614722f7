"""The registered queries by name, on the smallest tables, against the libraries and brute force."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from corpusloom.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    t = pq.read_table(f"{DIR}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] or "" for r in sorted(t, key=lambda r: r["doc_id"])}


def rows(spark, name, key="doc_id"):
    got = QUERIES[name](spark, DIR).collect()
    assert len({r[key] for r in got}) == len(got)
    return {r[key]: r for r in got}


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_op2(spark):
    got = rows(spark, "op2_html_extraction", "page_id")
    assert len(got) == pq.read_table(f"{DIR}/pages.parquet").num_rows and all(r.n_chars == len(r.text) for r in got.values())
    assert not any(re.search(r"<[a-z]+[ >]|&amp;", r.text) for r in got.values()) and sum(r.n_chars > 0 for r in got.values()) == len(got)


def test_op3(spark, texts):
    from tokenizers import Tokenizer

    library, start, got = Tokenizer.from_file(BYTE_BPE), 0, rows(spark, "op3_token_id_files")
    for i, text in texts.items():
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op4(spark, texts):
    import sentencepiece

    library, got = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE), rows(spark, "op4_sentencepiece")
    for i, text in texts.items():
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids).encode()))


def test_op5(spark, texts):
    got = rows(spark, "op5_quality_classifier")
    assert got.keys() == texts.keys() and all(0 <= r.tail_probability <= 1 and r.keep in (True, False) for r in got.values())
    assert sum(r.keep for r in got.values()) > len(got) / 3


def test_op6(spark, texts):
    kinds = (("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32))
    got = rows(spark, "op6_secret_scan")
    for i, text in texts.items():
        spans = sorted((m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, p, group, least) in enumerate(kinds) for m in re.finditer(p, text) if len(m[group]) >= least)
        assert got[i].base_sha256 == sha(",".join(x[2] for x in spans).encode()) and {x[2] for x in spans} <= set(got[i].spans.split(","))
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(x[1] == k for x in spans) for k in range(3))


def test_op7(spark, texts):
    from tokenizers import Tokenizer

    library, got = Tokenizer.from_file(BYTE_BPE), rows(spark, "op7_token_counts")
    assert got.keys() == texts.keys()
    for i, text in list(texts.items()):
        assert got[i].n_tokens == len(library.encode(text, add_special_tokens=False).ids)


def test_op8(spark, texts):
    got, ids = rows(spark, "op8_imatch_fingerprints"), list(texts)
    for k, i in enumerate(ids):
        text, following = texts[i], texts[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), sha((text[: len(text) - half] + following[:half]).encode()))
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    same = {}
    for i, text in texts.items():
        assert same.setdefault(text, got[i].fingerprint) == got[i].fingerprint


def test_op9(spark, texts):
    got = rows(spark, "op9_pii_pseudonyms")
    mail = r"[A-Za-z0-9][A-Za-z0-9.]*@[a-z]+\.[a-z]+"
    assert got.keys() == texts.keys() and not any(set(re.findall(mail, texts[i])) & set(re.findall(mail, r.text)) for i, r in got.items())
    assert all(r.text == texts[i] for i, r in got.items() if not any(r[c] for c in r.__fields__ if c.startswith("n_")))


def test_op10(spark, texts):
    words = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())
    items = pq.read_table(f"{DIR}/benchmark.parquet").to_pylist()
    found = {(r.doc_id, r.item_id) for r in QUERIES["op10_benchmark_decontamination"](spark, DIR).collect()}
    held = {i: f" {' '.join(words(t))} " for i, t in texts.items()}
    verbatim = {(i, x["item_id"]) for x in items for i, t in held.items() if f" {' '.join(words(x['text']))} " in t}
    assert verbatim and verbatim <= found
    for i, item in found - verbatim:
        wanted = set(words(next(x["text"] for x in items if x["item_id"] == item)))
        assert len(wanted & set(words(texts[i]))) >= len(wanted) / 2
