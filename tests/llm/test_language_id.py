import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import DOCS, documents, edge_texts

from strata.llm import language_id as I
from strata.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def bucket(gram):
    h = np.full(1, len(gram), np.uint64)
    for c in gram:
        h = h * np.uint64(0x100000001B3) + np.uint64(0 if c == " " else ord(c))
    return int(I.mix(h)[0] >> np.uint64(48))


def plain(text):
    """Buckets of a text's n-grams, word by word."""
    found = Counter()
    low = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower())
    for word in low.split(" "):
        if word:
            word = f" {word} "
            found.update(bucket(word[i:i + n]) for n in I.ORDERS for i in range(len(word) - n + 1))
    return found


def sentences(rng, words, rows):
    return [" ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(rows)]


def two_languages(rng, rows):
    a, b = ["the", "house", "is", "where", "water"], ["das", "häuschen", "ist", "wo", "wässer"]
    return ([(x, "en") for x in sentences(rng, a, rows)] + [(x, "de") for x in sentences(rng, b, rows)])


@pytest.fixture(scope="module")
def model(spark):
    rows = two_languages(random.Random(1), 200)
    return I.fit(spark.createDataFrame(rows, "text string, label string"), max_rows=300)


def test_subwords_word_by_word():
    for text in [x for x in edge_texts() if x] + ["a", "ab  c1d", "Ñandú éx 漢字", " x ", "İ­", "1 2"]:
        at, n = I._counts(text)
        assert dict(zip(at.tolist(), n.tolist())) == dict(plain(text))


def test_long_texts_are_read_whole_in_pieces(spark, model, monkeypatch):
    texts = [f"{x} {y}" for (x, _), y in zip(two_languages(random.Random(8), 20), edge_texts()[3:9] * 4)]
    whole = I.predict(documents(spark, texts), model).collect()
    monkeypatch.setattr(I, "PIECE", 17)
    for text in texts:
        if max(map(len, text.split())) < 17:
            assert dict(zip(*(x.tolist() for x in I._counts(text)))) == dict(plain(text))
    monkeypatch.setattr(I, "PIECE", 1 << 13)
    for a, b in zip(whole, I.predict(documents(spark, texts), model).collect()):
        assert a.lang_pred == b.lang_pred and abs(a.score - b.score) < 1e-6


def test_prediction_against_plain_average(spark, model):
    texts = [x for x, _ in two_languages(random.Random(9), 10)]
    for r in I.predict(documents(spark, texts), model).collect():
        n = plain(r.text)
        mean = sum(model.embed[b] * c for b, c in n.items()) / sum(n.values())
        z = np.exp((mean @ model.layer + model.bias) / model.temperature)
        p = z / z.sum()
        assert r.lang_pred == model.labels[p.argmax()] and abs(r.score - p.max()) < 1e-5
        assert r.accepted == (p.max() >= model.least)


def test_learns_and_rejects(spark, model):
    rng = random.Random(2)
    rows = two_languages(rng, 100)
    docs = spark.createDataFrame([(t, x) for t, x in rows], "text string, truth string")
    got = I.predict(docs, model)
    assert got.where("lang_pred = truth").count() == 200
    # labels that nothing in the text tells apart: no confidence is enough
    noise = [(x, rng.choice(["a", "b"])) for x in sentences(rng, ["one", "two", "three"], 400)]
    blind = I.fit(spark.createDataFrame(noise, "text string, label string"))
    assert I.predict(docs, blind).where("accepted").count() < 20


def test_calibration():
    model = I.Model(["a", "b"], np.zeros((1, 1)), np.zeros((1, 2)), np.zeros(2))
    truth = np.array([0] * 90 + [1] * 10)
    I._calibrate(model, np.tile([40.0, 0.0], (100, 1)), truth, 0.98)
    p = model.probabilities(np.array([[40.0, 0.0]]))
    assert abs(p[0, 0] - 0.9) < 0.02 and model.least > 1  # overconfident scores come down, none is enough
    I._calibrate(model, np.tile([40.0, 0.0], (100, 1)), truth, 0.9)
    assert model.least <= p[0, 0] + 1e-9


def test_same_every_time_and_bounded(spark, model):
    rows = two_languages(random.Random(1), 200)
    again = I.fit(spark.createDataFrame(rows[::-1], "text string, label string").repartition(5), max_rows=300)
    assert np.array_equal(again.embed, model.embed) and again.least == model.least
    labelled = spark.createDataFrame(rows, "text string, label string")
    taken = I.sample(labelled, 60)
    assert 30 <= taken.count() / (1 + I.FRAGMENTS) <= 60
    assert I.sample(labelled.union(labelled), 5).count() <= 5 * (1 + I.FRAGMENTS)


def test_edge_rows_and_clashing_columns(spark, model):
    texts = edge_texts() + ["123 456", "!!!", "٣٤", "漢字", "́"]
    docs = documents(spark, texts).selectExpr("doc_id + 9007199254740993 AS doc_id", "text", "1 AS score", "lang AS label",
                                              "'x' AS accepted", "source AS embed")
    docs = docs.union(docs.selectExpr("null", "text", "score", "label", "accepted", "embed"))
    got = I.predict(docs, model)
    assert got.columns == ["doc_id", "text", "label", "embed", "lang_pred", "score", "accepted"]
    out = got.collect()
    assert len(out) == 2 * len(texts)
    assert {r.doc_id for r in out} == {i + (1 << 53) + 1 for i in range(len(texts))} | {None}
    for r in out:
        letters = any(unicodedata.category(c)[0] == "L" for c in r.text or "")
        assert (r.lang_pred in model.labels and 0 < r.score <= 1) if letters else (
            r.lang_pred == "und" and r.score == 0 and not r.accepted)
    assert I.predict(docs.limit(0), model).collect() == []


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([("a b", None), (None, "en"), ("12", "en")], "text string, label string")
    assert I.fit(empty) is None
    assert [(r.lang_pred, r.score) for r in I.predict(empty, None).collect()] == [("und", 0.0)] * 3


def test_query_held_out_accuracy(spark, tmp_path):
    got = {r.doc_id: r for r in QUERIES["op13_language_id"](spark, SF).collect()}
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()
    assert len(got) == len(truth)
    tested = [r for r in truth if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in truth)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in tested) >= 0.98 * len(tested) > 100
    spark.createDataFrame([(None, "a", None, "s", 1)], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert [tuple(r)[1:] for r in QUERIES["op13_language_id"](spark, str(tmp_path)).collect()] == \
        [(False, "und", 0.0, False)]
