"""Corpus pipeline: five stages over ``documents``, each written as Parquet and reread by the next.

A stage gets all that its predecessor kept and returns a DataFrame; all but the last return the columns of
``documents``.  None of them can be said in SQL as a whole (scores, weighted min-hash classes, tiles and bins), so
``ORACLE_SQL`` is None and ``tests/llm`` holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoindicators.llm.common import scratch_path, ship_package
from geoindicators.llm.exact_dedup import drop_exact_copies
from geoindicators.llm.minhash_dedup import drop_near_copies
from geoindicators.llm.packing import pack_documents
from geoindicators.llm.tiling import drop_contaminated
from geoindicators.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.3 stay."""
    ship_package(spark)
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest doc_id stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the document with the smallest doc_id stays."""
    ship_package(spark)
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover half of no benchmark item stay."""
    ship_package(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that are left, as pieces of sequences of 2,048 words."""
    ship_package(spark)
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; returns the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
