"""The pipeline's stages one after the other, each judged on its own input."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq

import corpus_pipeline
from tests.llm.common import ODD, SF, write_tables
from tests.llm.test_near_dup import brute_classes
from tests.llm.test_pii import base_spans


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
        if k < 4:
            assert docs.columns == columns
            after = {r.doc_id: r for r in docs.collect()}
        if name == "near_duplicates":
            kept = {i for i, (_, c) in brute_classes([(r.doc_id, r.text) for r in before]).items() if i == c}
            assert after.keys() == kept
        if name == "personal_data":
            assert after.keys() == {r.doc_id for r in before}
            assert not any(base_spans(r.text) for r in after.values())
            assert all(r.n_chars == len(r.text) for r in after.values() if r.text is not None)
    assert sizes[0] >= 195 and 140 < sizes[1] <= sizes[0]
    kept_ids = {r.doc_id for r in docs.collect()}
    assert kept_ids == after.keys()
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == sorted(r.doc_id for r in docs.collect())


def test_quality_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_network(spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    good = [r.doc_id in kept for r in labels if r.quality == 1]
    bad = [r.doc_id in kept for r in labels if r.quality == 0]
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.3


def test_odd_rows(spark, tmp_path):
    ids, texts = zip(*ODD)
    odd = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts), "lang": pa.array(["en"] * len(ids)),
                    "source": pa.array([None] * len(ids), pa.string()), "n_chars": pa.array([None] * len(ids), pa.int64()),
                    "score": pa.array([1.5] * len(ids)), "lang_pred": pa.array(["x"] * len(ids))})
    labels = pq.read_table(f"{SF}/labels.parquet")
    folder = write_tables(str(tmp_path), documents=odd, labels=labels)
    assert corpus_pipeline.run(spark, folder).count() >= 1
    empty = tmp_path / "empty"
    empty.mkdir()
    write_tables(str(empty), documents=odd.slice(0, 0), labels=labels.slice(0, 0))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
