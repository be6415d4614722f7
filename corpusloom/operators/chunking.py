"""Chunking by section and speaker turn, and a native path for texts without either."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from corpusloom.functions.text import HEADING, SPEAKER, chunk_id, citation_anchor, count_tokens
from corpusloom.schemas import DEFAULT_OVERLAP_TOKENS, DEFAULT_TARGET_TOKENS

_TOKENS = re.compile(r"\w+|[^\w\s]")
_text = lambda name: StructField(name, StringType())
_int = lambda name: StructField(name, IntegerType())
CHUNKS_TYPE = ArrayType(StructType([_int("chunk_index"), _text("section_heading"), _text("chunk_text"), _int("token_count")]))
TURNS_TYPE = ArrayType(StructType([_text("speaker"), _text("body")]))


def token_count(text: str) -> int:
    return len(_TOKENS.findall(text))


def speaker_turns(text: str) -> list[tuple[str | None, str]]:
    """(speaker, body) in order; a heading line is a turn of its own without a speaker."""
    found: list[tuple[str | None, list[str]]] = [(None, [])]
    for line in text.split("\n"):
        line = line.rstrip()
        if HEADING.match(line):
            found += [(None, [line]), (None, [])]
        elif label := SPEAKER.match(line):
            rest = line[label.end() :]
            found.append((label[1].strip(), [rest] if rest else []))
        else:
            found[-1][1].append(line)
    bodies = [(who, "\n".join(lines).strip()) for who, lines in found]
    return [(who, body) for who, body in bodies if body]


class _Packer:
    """Buffers turns up to the target; each emitted chunk leaves its last words as a seed."""

    def __init__(self, target: int, overlap: int):
        self.target, self.overlap = target, overlap
        self.heading: str | None = None
        self.out: list[tuple[str | None, str, int]] = []
        self.parts: list[str] = []
        self.size = 0

    def seed(self, words: list[str]) -> None:
        self.parts = [" ".join(words[-self.overlap :])] if self.overlap and len(words) > self.overlap else []
        self.size = sum(map(token_count, self.parts))

    def emit(self, text: str) -> None:
        self.out.append((self.heading, text, token_count(text)))

    def flush(self) -> None:
        body = "\n\n".join(self.parts).strip()
        if not body:
            self.parts, self.size = [], 0
            return
        self.emit(body)
        self.seed(body.split())

    def add(self, text: str) -> None:
        size = token_count(text)
        if size > self.target:
            self.flush()
            words, stride, at = text.split(), max(1, self.target - self.overlap), 0
            while True:
                window = words[at : at + self.target]
                self.emit(" ".join(window))
                if at + self.target >= len(words):
                    break
                at += stride
            self.seed(window)
            return
        if self.parts and self.size + size > self.target:
            self.flush()
        self.parts.append(text)
        self.size += size


def chunk_text(text: str, target: int = DEFAULT_TARGET_TOKENS, overlap: int = DEFAULT_OVERLAP_TOKENS) -> list[tuple[str | None, str, int]]:
    """(section heading, text, tokens) of each chunk."""
    if target <= 0 or overlap < 0 or overlap >= target:
        raise ValueError(f"chunking needs 0 <= overlap < target, not {overlap} and {target}")
    packer = _Packer(target, overlap)
    for speaker, body in speaker_turns(text):
        if speaker is None and (heading := HEADING.match(body)) and "\n" not in body:
            packer.flush()
            packer.heading = heading[1]
        else:
            packer.add(f"{speaker}: {body}" if speaker else body)
    packer.flush()
    return packer.out


@F.pandas_udf(TURNS_TYPE)
def turns_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [{"speaker": s, "body": b} for s, b in speaker_turns(t or "")])


@F.pandas_udf(CHUNKS_TYPE)
def chunks_udf(texts: pd.Series, targets: pd.Series, overlaps: pd.Series) -> pd.Series:
    return pd.Series([
        [{"chunk_index": k, "section_heading": h, "chunk_text": c, "token_count": n} for k, (h, c, n) in enumerate(chunk_text(t or "", int(a), int(b)))]
        for t, a, b in zip(texts, targets, overlaps, strict=True)
    ])


def chunk_documents(docs: DataFrame, text_col: str = "text", policy_col: str | None = None) -> DataFrame:
    """Rows of ``docs`` (episode_id, primary_url, text) by chunk, with the columns of CHUNK."""
    part = lambda name, default: F.coalesce(F.col(f"{policy_col}.{name}"), F.lit(default)) if policy_col else F.lit(default)
    target, overlap = part("target_tokens", DEFAULT_TARGET_TOKENS), part("overlap_tokens", DEFAULT_OVERLAP_TOKENS)
    rows = docs.select("episode_id", "primary_url", F.inline(chunks_udf(F.col(text_col), target, overlap)))
    return rows.select(
        chunk_id(F.col("episode_id"), F.col("chunk_index")).alias("chunk_id"), "episode_id", "token_count", "section_heading", "chunk_text",
        citation_anchor(F.col("primary_url"), F.col("section_heading")).alias("citation_anchor"),
    )


def plain_chunks(text: Column, target: int = DEFAULT_TARGET_TOKENS, overlap: int = DEFAULT_OVERLAP_TOKENS) -> Column:
    """Chunk texts of a text without headings and labels, without Python: the text itself up to the
    target, else windows of words, and the tail that seeds the next chunk as one of its own."""
    stripped = F.regexp_replace(text, r"^\s+|\s+$", "")
    stride = target - overlap

    def windows(words: Column) -> Column:
        n = F.size(words)
        count = F.when(n <= target, 1).otherwise(F.ceil((n - target) / F.lit(stride)).cast("int") + 1)
        cut = F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.array_join(F.slice(words, k * stride + 1, target), " "))
        if not overlap:
            return cut
        tail = F.array_join(F.slice(words, n - overlap + 1, overlap), " ")
        return F.when(n - (count - 1) * stride > overlap, F.concat(cut, F.array(tail))).otherwise(cut)

    # the words are bound to a variable of the lambda, so that they are made once a row
    cut = F.element_at(F.transform(F.array(F.filter(F.split(text, r"\s+"), lambda w: w != "")), windows), 1)
    return F.when(stripped == "", F.array().cast("array<string>")).when(count_tokens(stripped) <= target, F.array(stripped)).otherwise(cut)


def register(spark: SparkSession) -> None:
    """The chunker as the SQL table function chunk_text(text, target, overlap)."""

    @F.udtf(returnType="chunk_index int, section_heading string, chunk_text string, token_count int")
    class ChunkText:
        def eval(self, text: str, target: int, overlap: int):
            for k, (heading, body, n) in enumerate(chunk_text(text or "", target, overlap)):
                yield k, heading, body, n

    spark.udtf.register("chunk_text", ChunkText)
    spark.udf.register("speaker_turns", turns_udf)
