"""The corpus pipeline: documents through five stages, each written as Parquet and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dugout.llm import stages
from dugout.llm.common import shared_path, ship_package, table

STAGES = [
    ("quality", stages.quality),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate),
    ("secrets", stages.secrets),
    ("byte_bpe", stages.byte_bpe),
]

#: The classifiers and the signatures are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last one's rows."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
