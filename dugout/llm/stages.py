"""Stages of the corpus pipeline; each takes what the one before kept.

All but the last return rows of documents with the columns they came with. Rows
without a ``doc_id`` are judged like the others, except that near-duplicate
removal, which names documents by their ids, lets them pass.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.llm import bagminhash, bpe
from dugout.llm import decontaminate as leaks
from dugout.llm import quality as rules
from dugout.llm import secrets as scanner
from dugout.llm.common import ship_package, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules don't reject; the rules are learnt from the labelled ones among them."""
    ship_package(spark)
    learnt = rules.fit_on(docs, table(spark, sf_dir, "labels"))
    kept = rules.scored(docs.select(F.struct(*docs.columns).alias("doc"), "text"), learnt).filter("predicted = 1")
    return kept.select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every class of near copies, once; documents alone in their class stay."""
    ship_package(spark)
    classes = bagminhash.near_duplicates(docs.select("doc_id", "text"))
    removed = stored(classes.filter("class_id != doc_id").select("doc_id").distinct(), "removed")
    kept = docs.join(removed, "doc_id", "leftanti")
    # Rows that repeat an id are copies of one document or share its name; one of them stays.
    repeated = stored(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    single = kept.join(repeated, "doc_id", "leftanti")
    one_each = kept.join(repeated, "doc_id", "leftsemi").dropDuplicates(["doc_id"])
    return single.unionByName(one_each).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    ship_package(spark)
    return leaks.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark and ``n_chars`` counted anew."""
    ship_package(spark)
    clean = scanner.redact(docs, scanner.fit_on(docs))
    size = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return clean if size is None else clean.withColumn("n_chars", size)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: how many, and the digests of ids and decoded bytes."""
    ship_package(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks))
