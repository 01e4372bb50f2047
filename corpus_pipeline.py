"""From raw documents to training sequences: toxicity, near-duplicates, decontamination, personal data, packing.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read back as the next one's docs. All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontaminate, packing, pii, simhash, toxicity
from tallyhouse.llm.common import read, stored

# SQL has no fingerprints by XXH64, logistic models or tokenizers; the tests compare with plain versions.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model predicts to be toxic go."""
    scored = toxicity.scored(docs, read(spark, sf_dir, "labels"))
    return scored.filter("predicted = 0").select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints (three-word shingles) linked at three bits or fewer the document of the least id stays."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, exact or with other parameters, go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind; n_chars is that of the new text."""
    return pii.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokenised pieces of all documents with their sequence and offset."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", reject_toxic), ("near_copies", one_of_each), ("decontaminate", without_benchmark), ("pii", redact),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each but the last written and read back."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
