from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.errors import InvalidArgument, Invariant
from corpusloom.functions import hashing, text, vectors


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names)).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("raw, wanted", [
    ("  \r\nHello\r\nworld   \r\n\n\nfoo\tbar  \r\n  ", "Hello\nworld\n\nfoo bar"), ("a\r\n\r\n\r\n\r\nb", "a\n\nb"),
    ("  \r\nHello\tworld   \n\n\n\nfoo\tbar  \r\n  ", "Hello world\n\nfoo bar"), ("first\n   \n\t\n  \nsecond", "first\n\nsecond"), ("", ""),
])
def test_canonicalise(spark, raw, wanted):
    assert one(spark, text.canonicalise("t"), t=raw) == wanted
    text.register(spark)
    assert spark.createDataFrame([(raw,)], "t string").selectExpr("canonicalise(t) AS x").first()[0] == wanted


@pytest.mark.parametrize("raw, wanted", [("Costco's flywheel", "costco-s-flywheel"), ("AcQuired — IKEA / 2022", "acquired-ikea-2022"), ("", "")])
def test_slugify(spark, raw, wanted):
    assert text.slugify_text(raw) == wanted
    assert one(spark, text.slugify("t"), t=raw) == wanted
    assert one(spark, text.slugify_native("t"), t=raw) == wanted


@pytest.mark.parametrize("raw, wanted", [("Hello, world!", 4), ("", 0), ("one two three", 3)])
def test_count_tokens(spark, raw, wanted):
    assert one(spark, text.count_tokens("t"), t=raw) == wanted


@pytest.mark.parametrize("raw, most, wanted", [("hello", 5, "hello"), ("hello world", 5, "hello…"), ("a—bcdef", 3, "a—b…")])
def test_truncate(spark, raw, most, wanted):
    assert one(spark, text.truncate_text("t", most), t=raw) == wanted


def test_small_helpers(spark):
    assert text.parse_csv("fintech, ai , ") == ["fintech", "ai"] and text.parse_csv(",,, ,") == []
    assert one(spark, text.split_names("t"), t="Ann Lee, Bo Ek and  Cy") == ["Ann Lee", "Bo Ek", "Cy"]
    assert one(spark, text.strip_transcript_suffix("t"), t="A talk (Transcript)") == "A talk"
    assert one(spark, text.publication_date("t"), t='<meta property="article:published_time" content="2024-02-03T01:00">') == "2024-02-03"
    assert one(spark, text.page_title("t"), t="<TITLE a=b> A\n b </TITLE>") == "A b"
    assert one(spark, text.meta_content("t", "description"), t='<meta content="x" name="description">') == "x"
    assert one(spark, text.fts_tokens("t"), t="It's a Café_x!") == ["it", "s", "a", "cafe", "x"]
    assert one(spark, text.url_join("a", "b"), a="https://x.org/p/", b="../q") == "https://x.org/q"


def test_blake3_and_hex():
    assert hashing.blake3_hex(b"") == "af1349b9f5f9a1a6a0404dea36dcc9499bcb25c9adc112b7cc9a93cae41f3262"
    assert hashing.blake3_hex(b"abc") == "6437b3ac38465133ffb63b75273a8db548c558465d79db03fd359c6cd5bd9d85"
    assert hashing.blake3_hex(bytes(k % 251 for k in range(2049))) == "5f4d72f40d7a5f82b15ca2b2e44b1de3c2ef86c426c95c1af0b6879522563030"
    assert hashing.decode_hex("0aFF") == b"\x0a\xff"
    for bad in ("abc", "zz"):
        with pytest.raises(InvalidArgument):
            hashing.decode_hex(bad)


def test_vectors(spark):
    rows = spark.createDataFrame([([1.0, 0.0],), ([0.0, 0.0],)], "v array<float>")
    got = [r[0] for r in rows.select(vectors.cosine(F.col("v"), F.array(F.lit(1.0), F.lit(0.0)).cast("array<float>"))).collect()]
    assert got == [1.0, 0.0]
    assert vectors.decode_f32(vectors.encode_f32([0.5, -2.0])) == [0.5, -2.0]
    with pytest.raises(Invariant):
        vectors.decode_f32(b"abc")
