"""A corpus pipeline: reject bad documents, remove copies, mix sources, pack.

``run`` writes every stage as Parquet to the shared folder and reads it again, so a later
stage works on exactly what its predecessor kept.

Defined cases are those of the operators: a null text is an empty one, and all empty texts are
one group of copies; rows that share an id are told apart by their texts, of equal rows one
stays; ties go to the smaller id, null ids last; texts of any length are read whole; an empty
table gives an empty result. Other columns pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierworks.llm import exact_dedup, mixing, packing, quality, simhash
from tierworks.llm.common import staged, word_count


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints within three bits, as in op9, one document stays."""
    return simhash.keep_rows(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The repeats of a document are one duplicate cluster and never share a bin."""
    items = docs.select(
        F.col("doc_id").cast("long"), word_count().alias("size"), "source",
        exact_dedup.digest().alias("cluster"),
    )
    return packing.pack(items)


STAGES = [
    ("quality_classifier", reject_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_bins),
]

#: The classifier is trained, so SQL cannot say which rows stay.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
