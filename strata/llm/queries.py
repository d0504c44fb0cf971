"""Registered queries of this package: one per operator, over whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import (
    cube_mix,
    dual_tree,
    fingerprint,
    html_extract,
    jaccard_join,
    katz,
    language_id,
    periodic_runs,
    pii,
    quality_rules,
    sentencepiece_codec,
    suffix_dedup,
    url_filter,
)
from .common import table
from .oracle import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op1_cube_mix(spark, sf_dir):
    """Words that a balanced mix takes of every document."""
    docs = table(spark, sf_dir, "documents")
    return cube_mix.mix(docs, cube_mix.ranked_weights(docs), cap=3.0) \
        .select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


@query
def op3_quality_rules(spark, sf_dir):
    """Base figures and verdict on every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs, table(spark, sf_dir, "labels"), passed=["doc_id"])


@query
def op9_url_filter(spark, sf_dir):
    """Verdict on every page's URL."""
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url")) \
        .select("page_id", "host", "path", "rule", "verdict", "by")


@query
def op10_fingerprint(spark, sf_dir):
    """Fingerprints of every text and of its edited form, and their likeness."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    value = F.struct(F.col("text").alias("text"), fingerprint.sketch(F.col("text")).alias("sketch"))
    both = fingerprint.with_next(docs, "doc_id", value, "own", "next", F.xxhash64("text"))
    changed = both.select("doc_id", F.col("own.text").alias("text"), F.col("own.sketch").alias("own"),
                          F.col("next.sketch").alias("next"),
                          fingerprint.edited(F.col("own.text"), F.col("next.text")).alias("edited"))
    changed = changed.withColumn("edited_own", fingerprint.sketch(F.col("edited")))
    return changed.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.as_text(F.col("own")).alias("fingerprint"),
        fingerprint.as_text(F.col("edited_own")).alias("edited_fingerprint"),
        fingerprint.resemblance(F.col("own"), F.col("edited_own")).alias("near_edited"),
        fingerprint.resemblance(F.col("own"), F.col("next")).alias("near_next"))


@query
def op4_html_extract(spark, sf_dir):
    """Main text of every page."""
    text = html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


@query
def op7_pii(spark, sf_dir):
    """Personal data of every document."""
    return pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_sentencepiece(spark, sf_dir):
    """Ids of every text, and whether decoding them gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = sentencepiece_codec.encode(docs, decoded="decoded_sha256")
    return coded.select("doc_id", F.length("text").cast("long").alias("n_chars"),
                        F.size("ids").cast("long").alias("n_ids"), "ids", "decoded_sha256",
                        (F.col("decoded_sha256") == F.sha2("text", 256)).alias("round_trip"))


@query
def op8_jaccard_join(spark, sf_dir):
    """Components of documents that are at least 90 % similar in three-word shingles."""
    return jaccard_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op2_katz(spark, sf_dir):
    """Katz backoff score of every text beside a unigram baseline."""
    return katz.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_suffix_dedup(spark, sf_dir):
    """Bytes of every document that an earlier document has in strings of 50 bytes."""
    return suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_periodic_runs(spark, sf_dir):
    """Runs of repeated words in every text, a tenth of them with planted repeats, and the texts without repeats."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", periodic_runs.with_planted_repeats(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs.find(docs)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n"))), "")
    best = F.col("best")
    return found.select("doc_id", "collapsed", F.size("runs").cast("long").alias("n_runs"), listed.alias("listed"),
                        periodic_runs.strongest(F.col("runs")).alias("best")).select(
        "doc_id", "n_runs", best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op12_dual_tree(spark, sf_dir):
    """The 20 highest-scoring documents of every benchmark item."""
    return dual_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_language_id(spark, sf_dir):
    """Predicted language of every text, learned from four fifths of the documents."""
    docs = table(spark, sf_dir, "documents")
    learn = docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).select("doc_id", "text", "lang")
    model = language_id.fit(learn, label="lang", key="doc_id")
    asked = docs.select("doc_id", "text", language_id.held_out(F.col("doc_id")).alias("held_out"))
    return language_id.predict(asked, model).drop("text")
