"""The training-data pipeline: five stages over `documents`, each written and read again.

Rules and the classifier drop documents, near-duplicate linking keeps the first
document of each group, repeated spans are cut from the texts, and what is left
is packed into sequences. All stages but the last return the columns of
`documents`. The classifier learns from the labelled documents that reach it.

Empty tables pass through (the last stage then returns no rows). What null or
repeated rows mean is said at each operator. A text that loses words has its
kept words joined by one space, and n_chars counted anew. Each stage's table
goes once the next one is written; the last one stays, as the result reads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from placeflow.llm import near_dedup, packing, quality_crf, quality_rules, substring_dedup
from placeflow.llm.common import discarded, shared_folder


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_crf.keep(docs, quality_crf.learn(spark, sf_dir, docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.strip(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("packing", packing_stage),
]

#: The classifier, the sketches' order and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; stages are written to the folder that the cluster shares."""
    base = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        if before is not None:
            discarded(before)
        before = docs
    return docs
