"""A training corpus from raw documents: five stages, each written as Parquet and read again.

language_mixture drops documents without a letter and such in which no language prevails.
quality_network drops documents that its classifier, fitted on the labelled ones, predicts as 0.
near_duplicates keeps the first document of each class of near duplicates.
personal_data masks personal data in the texts and sets n_chars anew.
packing turns the texts into token sequences.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of ``docs``. A row
that occurs several times is one document: the first two stages keep all of its rows or none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import language_mix, near_dup, packing, pii, quality
from ledgerlake.llm.common import scratch_dir, table, without_ids
from ledgerlake.llm.queries import TOKENIZERS

#: The least share of the main language, times its posterior.
LEAST_SHARE = 0.5


def language_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_mix.Model.fit(docs.select("text", "lang"))
    found = language_mix.predicted(docs, model, docs.columns, prefix="__")
    kept = found.where((F.col("__lang_pred") != language_mix.UNKNOWN) & (F.col("__score") >= LEAST_SHARE))
    return kept.select(*docs.columns)


def quality_network(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scores = quality.scored(docs, table(spark, sf_dir, "labels"))
    rejected = scores.where("predicted = 0").select("doc_id").distinct()
    return without_ids(docs, rejected)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    counted = F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return pii.masked(docs).withColumn("n_chars", counted).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, TOKENIZERS("word_bpe_49k.json"))


STAGES = [
    ("language_mixture", language_mixture),
    ("quality_network", quality_network),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: The models are fitted and the tokens looked up outside SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences of ``documents`` under ``sf_dir``."""
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
