"""Corpus pipeline: documents in, token ids out.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all
rows its predecessor kept.  ``run`` writes every stage as Parquet to the shared
checkpoint folder and reads it again, so a stage's work is not repeated and a lost executor
costs only its own tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, minhash, quality_rules, secrets
from tidemark.llm.common import read, stage

STAGES = [
    ("quality_rules", quality_rules.stage_quality),
    ("near_dedup", minhash.stage_near_dedup),
    ("decontaminate", decontaminate.stage_decontaminate),
    ("secrets", secrets.stage_secrets),
    ("encode", bpe.stage_encode),
]

#: Components, template alignment and byte-pair merges are not expressible in SQL; tests/llm checks run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, f in STAGES:
        docs = stage(f(spark, docs, sf_dir), name)
    return docs
