"""Every operator returns ids as they came: above 2 ** 53, beside a null, repeated, among columns of clashing names."""

from collections import Counter

import corpus_pipeline
import pytest
from helpers import words
from pyspark.sql import functions as F

from strata.llm import (cube_mix, dual_tree, fingerprint, jaccard_join, katz, language_id, periodic_runs, pii,
                        quality_rules, sentencepiece_codec, suffix_dedup, url_filter)

BIG = (1 << 53) + 1
IDS = [BIG, None, BIG + 1, BIG + 2, BIG, None, 4, (1 << 63) - 1, -5]
WANT = Counter(IDS)
CLASH = ("size", "target", "h", "id", "text_hash", "row", "part", "n", "features", "depth", "label", "tokens", "page",
         "value", "key", "rank", "item", "words", "count", "base", "seen")


@pytest.fixture(scope="module")
def docs(spark):
    texts = [f"some words of text number {i} and then a few more of the same kind as all others here have them all "
             f"with card 4111 1111 1111 1111 and mail a{i}@b.org" for i in range(len(IDS))]
    rows = [(i, None if k == 3 else t, "en", ["a", None, "b"][k % 3], k) for k, (i, t) in enumerate(zip(IDS, texts))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    return df.withColumns({c: F.lit(BIG if k % 2 else None).cast("long") for k, c in enumerate(CLASH)})


def ids(df, name="doc_id"):
    return Counter(r[0] for r in df.select(name).collect())


def test_mix(docs):
    weights = cube_mix.ranked_weights(docs)
    assert ids(cube_mix.mix(docs, weights)) == WANT
    taken = cube_mix.take(docs, weights)
    assert taken.schema == docs.schema and set(ids(taken)) <= set(WANT)
    assert {r.page for r in taken.collect()} <= {None, BIG}


def test_many_equal_rows_fall_into_many_blocks(spark, monkeypatch):
    """Rows without an id and of one size are no one block, and come out as many as they went in."""
    monkeypatch.setattr(cube_mix, "_RUN", 64)
    docs = spark.createDataFrame([(None, "a b", "s")] * 1000 + [(None, "a", "t")] * 300, "doc_id long, text string, source string")
    rows = cube_mix.numbered(docs.select("doc_id", "text", "source"))
    assert rows.count() == 1300 and rows.where("source = 's'").distinct().count() == 1000
    out = cube_mix.mix(docs, cube_mix.ranked_weights(docs), block=50)
    total = {r.source: (r.n, r.taken, r.target) for r in out.groupBy("source").agg(
        F.count("*").alias("n"), F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
    assert [total[s][0] for s in "st"] == [1000, 300]
    assert all(abs(t - want) <= 2 for _, t, want in total.values())


def test_katz(docs):
    assert ids(katz.score(docs.select("doc_id", "text"))) == WANT


def test_quality(spark, docs):
    labels = spark.createDataFrame([(BIG, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    out = quality_rules.judge(docs.select("doc_id", "text"), labels)
    assert ids(out) == WANT


def test_sentencepiece(docs):
    texts = docs.withColumn("text", F.coalesce("text", F.lit("")))
    out = sentencepiece_codec.encode(texts)
    assert ids(out) == WANT and ids(out, "page") == ids(docs, "page")


def test_suffix_dedup(docs):
    assert ids(suffix_dedup.dedup(docs.select("doc_id", "text"))) == WANT


def test_pii(docs):
    found = pii.find(docs)
    assert ids(found) == WANT and {r.n_card for r in found.collect()} == {0, 1}
    clean = pii.redact(docs)
    assert clean.schema == docs.schema and ids(clean) == WANT and ids(clean, "key") == ids(docs, "key")


def test_jaccard(docs):
    assert ids(jaccard_join.join(docs.select("doc_id", "text"))) == WANT


def test_urls(docs):
    pages = docs.withColumn("url", F.concat(F.lit("http://a.com/fr/"), F.col("n_chars")))
    out = url_filter.judge(pages)
    assert ids(out) == WANT
    assert [c for c in out.columns if c not in ("host", "path", "rule", "verdict", "by")] == pages.columns
    assert ids(out, "depth") == ids(docs, "depth")


def test_fingerprint(docs):
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    assert ids(fingerprint.with_next(texts, "doc_id", F.col("text"), "own", "next")) == WANT


def test_runs_search_language(spark, docs):
    runs = periodic_runs.find(docs)
    assert ids(runs) == WANT and ids(runs, "rank") == ids(docs, "rank")
    items = spark.createDataFrame([(BIG, "mail card"), (None, "mail")], "item_id long, text string").coalesce(1)
    found = dual_tree.search(docs, items, k=20)
    filled = Counter(r.doc_id for r in docs.collect() if words(r.text))
    for item in (BIG, None):
        assert ids(found.where(F.col("item_id").eqNullSafe(F.lit(item).cast("long")))) == filled
    assert ids(language_id.predict(docs, language_id.fit(docs, label="lang"))) == WANT


def test_stages(spark, docs, tmp_path):
    spark.createDataFrame([(BIG, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert set(ids(out)) <= set(WANT), name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
    assert ids(corpus_pipeline.personal_data(spark, docs, str(tmp_path))) == WANT
