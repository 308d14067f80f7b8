from __future__ import annotations

import brute
import corpus_pipeline
import pytest
from llm_rows import SCHEMA

from quire.llm import pii


@pytest.fixture(scope="module")
def folder(spark, docs, items, labels, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{d}/documents.parquet")
    items.write.parquet(f"{d}/benchmark.parquet")
    labels.write.parquet(f"{d}/labels.parquet")
    return d


def test_stages_keep_columns_and_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "pii", "best_fit_packing"]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    near = stages["ngram_jaccard_join"](spark, docs, folder)
    assert near.columns == docs.columns
    want = brute.near_copies(list(rows.items()), 5, 80, 100)
    assert {r["doc_id"] for r in near.collect()} == {d for d, (n, c) in want.items() if n == 0 or c == d}
    leak = stages["benchmark_decontamination"](spark, docs, folder)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert leak.columns == docs.columns
    assert {r["doc_id"] for r in leak.collect()} == {d for d, w in brute.leaks(list(rows.items()), items).items() if not w[1]}
    safe = stages["pii"](spark, docs, folder)
    assert safe.columns == docs.columns and safe.count() == len(rows)
    assert not any(pii.base_spans(r["text"]) for r in safe.collect())


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    assert got and {"doc_id", "bin", "piece_words"} <= set(got[0].asDict())


def test_run_over_nothing(spark, tmp_path):
    for name, schema in (("documents", SCHEMA), ("benchmark", "item_id bigint, text string"), ("labels", "doc_id bigint, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
