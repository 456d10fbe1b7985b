"""Training-data pipeline over ``documents``: each stage calls one operator of ``riskflow.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``docs``; the last replaces the text by its token ids.

Defined cases: each stage handles null and empty texts, repeated rows, empty
tables and extra columns as its operator states; extra columns are passed on.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

# The package sits next to this file; make it importable however the file is loaded.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from riskflow.llm import byte_bpe, decontamination, language_id, near_dedup, secret_scan  # noqa: E402
from riskflow.llm.common import table  # noqa: E402
from riskflow.llm.queries import held_out_language  # noqa: E402
from riskflow.session import materialize  # noqa: E402


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determined language (null or no letter) go."""
    return language_id.keep_identified(docs, language_id.train(docs, ~held_out_language()))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest doc_id."""
    return near_dedup.keep_one(docs, words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secret_scan.redact(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token ids."""
    rank_file, pattern = byte_bpe.default_tokenizer()
    return byte_bpe.token_ids(docs, rank_file, pattern)


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("byte_bpe", encoding_stage),
]

# Trained models and alignments: no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
