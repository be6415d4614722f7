"""The corpus pipeline: rate, deduplicate, decontaminate, pseudonymise and tokenise documents.

Each stage takes what its predecessor kept, written as Parquet and read again. All but the last
return the columns of documents; the last returns one row a document with its token ids' digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontam, jaccard_join, pii, quality, spm_codec
from corpusloom.llm.queries import PIECE_BPE, pii_key
from corpusloom.llm.storage import discard, load, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier rejects go. A null text is rated as an empty one, equal
    texts get equal ratings, rows without an id are rated like any other; without labels all stay."""
    rated = quality.classify(docs, load(spark, sf_dir, "labels"))
    return rated.where("keep").select(docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 0.8 or more over words by five, the one with the smallest id stays.
    Of rows with one id one stays; rows without an id all stay."""
    classes = jaccard_join.ngram_jaccard_classes(docs, n=5, percent=80, links=False)
    kept = classes.where("doc_id = component_id").select("doc_id")
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id is null")).select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or in paraphrase, go, and so do all rows of
    their ids. Null, empty and wordless texts hold nothing; rows without an id stay."""
    return decontam.clean(docs, decontam.contaminated(docs, load(spark, sf_dir, "benchmark")))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets pseudonyms in its own format; n_chars follows the text where present. Null
    texts stay null, empty ones empty; repeated rows get equal texts."""
    out = pii.pseudonymise_pii(docs, pii_key(spark)).select(docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; a null text counts as empty,
    repeated rows stay."""
    return spm_codec.round_trip_digest(docs, PIECE_BPE)


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("pii_pseudonyms", pii_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: A trained model and links closed over groups are beyond SQL; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's table goes once the next one is written."""
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
