"""The corpus pipeline: quality rules, near-duplicates, repeated passages, mixing, packing.

Each stage has the defined results of its operator: null and empty texts fail the quality
rules and go; very long texts are read whole; of equal or near-equal rows one stays, as
SimHash near-dedup states; ties in the mix are settled as mixing states; an empty table
gives an empty result; further columns are carried and may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixing, packing, quality_rules, simhash, suffix_dedup
from tessera.plans.cut import written


#: Bytes of a passage that stands twice: less than 50 words have in common prose.
PASSAGE = 200


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.keep_first(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that also stand elsewhere."""
    return suffix_dedup.without_repeats(docs, length=PASSAGE).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix in training order, repeated where a source is repeated."""
    return mixing.mixed_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed token sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeats),
    ("mixing", mix),
    ("packing", pack),
]

#: Fingerprints, token ids and hashed orders are beyond SQL; tests hold the rows against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's table is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
