"""Text primitives as column functions. All but the folding of exotic scripts stay in the JVM."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import cache
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.schemas import RESULT_CHARS

TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
FTS_TOKEN = r"[\p{L}\p{N}\p{Co}]+"
HEADING = re.compile(r"^#{1,6}\s+(.+?)\s*$")
SPEAKER = re.compile(r"^\s*([A-Z][A-Z0-9 .\-']{1,40}):\s")
DATE_TAGS = ("property=[\"']article:published_time[\"']", "name=[\"']pubdate[\"']", "name=[\"']date[\"']")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonicalise(c: Column | str) -> Column:
    """Line ends to LF, tabs to a space, no white space at line ends, at most one blank line, none
    at either end."""
    c = F.regexp_replace(_col(c), r"\r\n?", "\n")
    c = F.regexp_replace(F.translate(c, "\t", " "), r"(?m)[\s&&[^\n]]+$", "")
    return F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def count_tokens(c: Column | str) -> Column:
    return F.regexp_count(_col(c), F.lit(TOKEN))


def collapse_whitespace(c: Column | str) -> Column:
    return F.btrim(F.regexp_replace(_col(c), r"\s+", " "))


def collapse_blank_lines(c: Column | str) -> Column:
    """Unlike ``canonicalise``, collapses before it strips line ends, so lines of white space stay
    as blank ones."""
    c = F.regexp_replace(F.regexp_replace(_col(c), r"\r\n?", "\n"), r"\n{3,}", "\n\n")
    return F.regexp_replace(F.regexp_replace(c, r"(?m)[\s&&[^\n]]+$", ""), r"^\s+|\s+$", "")


def _folds() -> tuple[str, str]:
    """Letters of Latin script with their base letters, by decomposition."""
    pairs = [(c, unicodedata.normalize("NFD", c)[0]) for c in map(chr, range(0xC0, 0x250)) if len(unicodedata.normalize("NFD", c)) > 1]
    pairs += [(c, unicodedata.normalize("NFD", c)[0]) for c in map(chr, range(0x1E00, 0x1F00)) if len(unicodedata.normalize("NFD", c)) > 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold_latin(c: Column | str) -> Column:
    """Lower case without diacritics, for Latin script and combining marks."""
    return F.regexp_replace(F.lower(F.translate(_col(c), *_folds())), r"[̀-ͯ]", "")


@F.pandas_udf(StringType())
def fold(texts: pd.Series) -> pd.Series:
    """Lower case without diacritics, for any script."""
    plain = lambda t: "".join(x for x in unicodedata.normalize("NFD", t.lower()) if unicodedata.category(x) != "Mn")
    return texts.map(lambda t: None if t is None else plain(t))


def fts_tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(fold_latin(c), F.lit(FTS_TOKEN), F.lit(0))


def slugify_text(text: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()
    return "-".join(p for p in re.split(r"[^0-9a-z]+" if plain.isascii() else r"[\W_]+", plain) if p)


@F.pandas_udf(StringType())
def slugify(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else slugify_text(t))


@cache
def _combining() -> str:
    """A character class of all code points with a combining class other than 0, as ranges. One range
    around them all is tried first, so that most letters don't meet each of the others."""
    held = [c for c in range(0x300, 0x1F000) if unicodedata.combining(chr(c))]
    ranges: list[list[int]] = []
    for c in held:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return f"[\\x{{300}}-\\x{{1efff}}&&[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]]+"


def slugify_native(c: Column | str) -> Column:
    """``slugify`` in the JVM: compatibility decomposition by the Unicode library that Spark brings,
    combining marks dropped, lower case, runs of other signs to one hyphen, none at the ends."""
    c = _col(c)
    plain = F.regexp_replace(F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), F.coalesce(c, F.lit("")), F.lit(True)), _combining(), "")
    plain = F.when(F.length(c) == F.octet_length(c), c).when(c.isNotNull(), plain)
    return F.btrim(F.regexp_replace(F.lower(plain), r"[^\p{L}\p{N}]+", "-"), F.lit("-"))


def truncate_text(c: Column | str, most: int = RESULT_CHARS) -> Column:
    c = _col(c)
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("…"))).otherwise(c)


def episode_id(publisher: Column, series: Column, slug: Column) -> Column:
    return F.concat_ws("_", publisher, series, slug)


def chunk_id(episode: Column, ordinal: Column) -> Column:
    return F.concat(episode, F.lit("#"), F.format_string("%04d", ordinal))


def citation_anchor(url: Column, heading: Column) -> Column:
    return F.when(heading.isNull() | (heading == ""), url).otherwise(F.concat(url, F.lit("#"), slugify_native(heading)))


def page_title(c: Column | str) -> Column:
    return collapse_whitespace(F.regexp_extract(_col(c), r"(?is)<title[^>]*>(.*?)</title>", 1))


def publication_date(c: Column | str) -> Column:
    tries = [F.nullif(F.regexp_extract(_col(c), rf"(?i){tag}\s+content=[\"']([^\"']+)[\"']", 1), F.lit("")) for tag in DATE_TAGS]
    return F.coalesce(*(F.left(t, F.lit(10)) for t in tries), F.lit(""))


def meta_content(c: Column | str, name: str) -> Column:
    """Content of the meta element with this name or property, in either order of attributes."""
    key = re.escape(name)
    tries = (rf"(?is)<meta[^>]*(?:name|property)=[\"']{key}[\"'][^>]*content=[\"']([^\"']*)[\"']", rf"(?is)<meta[^>]*content=[\"']([^\"']*)[\"'][^>]*(?:name|property)=[\"']{key}[\"']")
    return unescape_html(collapse_whitespace(F.coalesce(*(F.nullif(F.regexp_extract(_col(c), t, 1), F.lit("")) for t in tries), F.lit(""))))


def heading_text(line: Column | str) -> Column:
    return F.regexp_extract(_col(line), r"^#{1,6}\s+(.+?)\s*$", 1)


def speaker_label(line: Column | str) -> Column:
    return F.trim(F.regexp_extract(_col(line), r"^\s*([A-Z][A-Z0-9 .\-']{1,40}):\s", 1))


def strip_transcript_suffix(c: Column | str) -> Column:
    return F.btrim(F.regexp_replace(_col(c), r"(?i)\s*[(\[]?\s*transcript\s*[)\]]?\s*$", ""))


def split_names(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(_col(c), r",| and "), lambda x: F.btrim(x)), lambda x: F.length(x) > 0)


@F.pandas_udf(StringType())
def unescape_html(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else html.unescape(t))


@F.pandas_udf(StringType())
def url_join(base: pd.Series, link: pd.Series) -> pd.Series:
    return pd.Series([None if b is None or x is None else urljoin(b, x) for b, x in zip(base, link, strict=True)])


def parse_csv(text: str) -> list[str]:
    return [x.strip() for x in text.split(",") if x.strip()]


def register(spark: SparkSession) -> None:
    """SQL names for the functions: SQL users get canonicalise(text), count_tokens(text) and so on."""
    from corpusloom.functions.hashing import _blake3

    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION count_tokens(t STRING) RETURNS INT RETURN regexp_count(t, '[\\\\p{L}\\\\p{N}_]+|[^\\\\p{L}\\\\p{N}_\\\\s]')")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION collapse_whitespace(t STRING) RETURNS STRING RETURN btrim(regexp_replace(t, '\\\\s+', ' '))")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION canonicalise(t STRING) RETURNS STRING RETURN regexp_replace(regexp_replace(regexp_replace("
        "translate(regexp_replace(t, '\\\\r\\\\n?', '\\n'), '\\t', ' '), '(?m)[\\\\s&&[^\\\\n]]+$', ''), '\\\\n{3,}', '\\n\\n'), '^\\\\s+|\\\\s+$', '')"
    )
    for name, f in (("slugify", slugify), ("fold_text", fold), ("blake3", _blake3), ("unescape_html", unescape_html)):
        spark.udf.register(name, f)
