"""The pipeline: each stage does what its operator decides, and hands on documents."""

import os

import pytest

import corpus_pipeline

from .conftest import SF_DIR
from .test_text_operators import near_wanted, pairs

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


def test_stages(spark, documents):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "decontaminate", "sentencepiece"]
    docs, seen = documents, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF_DIR).cache()
        seen.append((name, before.count(), docs.count()))
        if name != "sentencepiece":
            assert docs.dtypes == documents.dtypes
            assert docs.exceptAll(before).count() == 0
        if name == "quality":
            labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
            assert docs.join(labels.where("toxic = 1"), "doc_id").count() == 0
            good = labels.where("toxic = 0 and quality = 1")
            assert docs.join(good, "doc_id").count() >= 0.97 * before.join(good, "doc_id").count()
        if name == "exact_dedup":
            assert docs.count() == before.select("text").distinct().count() == docs.select("text").distinct().count()
        if name == "near_dedup":
            assert {r["doc_id"] for r in docs.collect()} == {i for i, _, c in near_wanted(pairs(before), 5) if i == c}
        if name == "decontaminate":
            items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            assert {r["doc_id"] for r in docs.collect()} == {i for i, t in pairs(before) if not any(x in t for x in items)}
        if name == "sentencepiece":
            assert docs.where("not round_trip").count() == 0 and docs.count() == before.count()


def test_run_on_empty_tables(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
