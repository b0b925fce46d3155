"""Language mixture and quality network: held-out accuracy, odd rows, untouched inputs."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import language_mix, quality
from ledgerlake.llm.queries import QUERIES
from tests.llm.common import no_docs, odd_docs

SF = "/root/testdata/sf0.01"


def held_out(doc_id: int, folds: int, which: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % folds == which


def test_languages_of_held_out_documents(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op10_language_mixture"](spark, SF).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == held_out(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in rows)
    judged = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert len(judged) > 200 and np.mean(judged) > 0.98


def test_mixture_finds_both_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_mix.Model.fit(language_mix.training_rows(docs))
    pick = {lang: docs.where((F.col("lang") == lang) & (F.length("text") > 2000)).first().text[:1500] for lang in ("de", "es")}
    main, score, languages, shares = model.mixture(pick["de"] + "\n" + pick["es"][:1000])
    assert main == "de" and set(languages) == {"de", "es"}
    assert 0.45 < shares[0] < 0.75 and abs(sum(shares) - 1) < 1e-6 and score <= 1
    assert model.mixture(pick["es"])[2] == ["es"]


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    wrong = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang"))
    def seen(d):
        return sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in language_mix.identified(d).collect())

    assert seen(docs) == seen(docs.withColumn("lang", wrong))


def test_language_odd_rows(spark):
    rows = language_mix.identified(odd_docs(spark)).collect()
    assert len(rows) == 11
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == "en"
    assert all(r.held_out is not None for r in rows)
    assert language_mix.identified(no_docs(spark)).count() == 0
    unlabelled = odd_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_mix.identified(unlabelled).collect()} == {"und"}


def test_cells_skip_what_is_no_letter():
    assert len(language_mix.cells("12 .. \U0001f600")) == 0
    assert np.array_equal(language_mix.cells("Ab, c"), language_mix.cells("aB  12 C"))


def test_quality_of_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op3_quality_network"](spark, SF).collect()
    assert all(r.held_out == held_out(r.doc_id, 5, 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    judged = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in judged if y == 1], [s for s, y in judged if y == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.93
    assert np.mean([(s >= 0.3) == y for s, y in judged]) > 0.9


def test_quality_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 1), (7, 0, 1), (99, 1, 0), (8, None, 0), (None, 1, 1)], "doc_id long, quality int, score int")
    rows = quality.scored(docs, labels).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    assert quality.scored(no_docs(spark), labels).count() == 0
    unlabelled = quality.scored(docs, labels.where(F.lit(False))).collect()
    assert {r.score for r in unlabelled} == {0.5}


def test_network_and_temperature():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(4000, 6))
    p = 1 / (1 + np.exp(-3 * x[:, 0] * x[:, 1]))
    y = (draw.random(4000) < p).astype(float)
    network = quality.Network.fit(x, y)
    fresh = draw.normal(size=(2000, 6))
    true = 1 / (1 + np.exp(-3 * fresh[:, 0] * fresh[:, 1]))
    assert np.mean(np.abs(network.probabilities(fresh) - true)) < 0.12


def test_repeats_have_a_word_of_their_own():
    assert (quality.word_cells("of of of of")[1:] == quality.AGAIN).all()
    assert quality.AGAIN not in quality.word_cells("the quick brown fox")


@pytest.mark.parametrize("most", [1, 7, 40, 1000])
def test_training_sample_is_the_least_hashes(spark, monkeypatch, most):
    """The bound of the hash leaves out no row of the sample, repeated ids and unknown ones included."""
    monkeypatch.setattr(quality, "SAMPLE", most)
    width = 2 * quality.DIMENSIONS
    ids = [k // 60 if k < 120 else k for k in range(400)]  # two ids on sixty labelled rows each
    docs = spark.createDataFrame(
        [(k, np.full(width, k, np.float32).tobytes()) for k in sorted(set(ids))], "doc_id long, features binary"
    )
    labels = spark.createDataFrame([(k, k % 2) for k in [*ids, 5000]] + [(None, 1)], "doc_id long, quality int")
    x, y = quality.training_sample(docs, labels, "quality", 5, 0)
    hashes = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    wanted = sorted((k for k in ids if not held_out(k, 5, 0)), key=lambda k: (hashes[k], k))[:most]
    assert x[:, 0].astype(int).tolist() == wanted and y.astype(int).tolist() == [k % 2 for k in wanted]
