"""Corpus pipeline: five stages over ``documents``, each stored as Parquet and read again by the next.

Every stage works on all that its predecessor kept and returns the columns of ``documents``; the last one returns ids.

Defined cases. Null texts and texts of fewer than 20 words fail the quality rules, and go with the first stage; the stages
after it take them as their operators say, if called alone. Null ids, sources and languages are values like others: a null
source is one source, null ids stay null and come after all others where the smallest id is kept. Of documents that are
near copies the smallest id stays, of repeated rows of one id one row; the mix then may take a row up to three times, as
equal rows. Ids keep their type and value, and columns beyond those of ``documents`` pass through all stages but the last.
Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import cube_mix, jaccard_join, pii, quality_rules, sentencepiece_codec
from strata.llm.common import store, table
from strata.session import configure

# Near duplicates in the pipeline: five-word shingles, a similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80
# The mix takes a document at most this many times.
MOST_COPIES = 3.0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    judged = quality_rules.judge(docs.withColumn("__doc", F.struct("*")), table(configure(spark), sf_dir, "labels"),
                                 passed=["__doc"])
    return judged.where("kept").select("__doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates the document of smallest id."""
    configure(spark)
    return jaccard_join.one_of_each(docs, n=SHINGLE, percent=PERCENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; n_chars follows the text."""
    configure(spark)
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix of sources takes it: not at all, once or more."""
    configure(spark)
    return cube_mix.take(docs, cube_mix.ranked_weights(docs), cap=MOST_COPIES)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left."""
    configure(spark)
    coded = sentencepiece_codec.encode(docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text")))
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing sources", mix),
    ("SentencePiece encoding", encode),
]

# Hashed statistics, EM and the cube method are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole ``documents`` table."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
