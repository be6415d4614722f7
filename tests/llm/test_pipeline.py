from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import sentencepiece

from corpusloom.llm import decontam, jaccard_join

DIR = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, held = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, DIR)
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name != "sentencepiece":
            assert docs.columns == columns
        held[name] = (before, after)
    labels = {r.doc_id: r for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    _, rated = held["quality_classifier"]
    clean = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    toxic = [i for i, r in labels.items() if r.toxic]
    assert sum(i in rated for i in clean) >= 0.95 * len(clean) and sum(i in rated for i in toxic) <= 0.3 * len(toxic)
    before, kept = held["ngram_jaccard_join"]
    classes = jaccard_join.ngram_jaccard_classes(spark.createDataFrame(list(kept.values()), docs.sparkSession.read.parquet(f"{DIR}/documents.parquet").schema), 5, 80)
    assert classes.where("doc_id <> component_id").count() == 0 and len(kept) < len(before)
    _, pure = held["benchmark_decontamination"]
    assert decontam.contaminated(spark.createDataFrame(list(pure.values()), spark.read.parquet(f"{DIR}/documents.parquet").schema), spark.read.parquet(f"{DIR}/benchmark.parquet")).count() == 0
    _, hidden = held["pii_pseudonyms"]
    _, coded = held["sentencepiece"]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert all(coded[i].n_tokens == len(sp.encode(r.text)) + 2 for i, r in hidden.items())


def test_run_and_empty_input(spark, tmp_path):
    assert corpus_pipeline.run(spark, DIR).count() > 0
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR)
        assert docs.count() == 0
