import random

import pytest
from helpers import documents, edge_texts

from strata.llm import sentencepiece_codec as S
from strata.llm.queries import QUERIES

from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def codec():
    return S.Codec(S.load_pieces())


def best(v, text):
    """Score of the best segmentation, by plain dynamic programming over the whole text."""
    plain = {k: v.find.get(k)[1] for k in v.find.keys()}
    score = [0.0] + [-1e18] * len(text)
    for j in range(1, len(text) + 1):
        for size in range(1, min(v.longest, j) + 1):
            if (s := plain.get(text[j - size:j])) is not None:
                score[j] = max(score[j], score[j - size] + s)
        if text[j - 1] not in v.chars:
            score[j] = max(score[j], score[j - 1] + len(text[j - 1].encode()) * v.byte_score)
    return score[-1]


def test_best_segmentation_and_round_trip(codec):
    v = codec.vocabulary
    by_id = {x[2]: x[1] for x in v.find.values()}
    rnd = random.Random(1)
    for _ in range(150):
        text = "".join(rnd.choice("abthe ion\n éß漢  Zz▁") for _ in range(rnd.randint(0, 300)))
        ids = codec.encode(text)
        assert codec.decode(ids) == text
        if text and S.MARK not in text:
            marked = S.MARK + text.replace(" ", S.MARK)
            want = best(v, marked)
            for found in (ids, S.segment(v, marked, rnd.choice([1, 3, 7, 50]))):
                assert abs(sum(by_id.get(i, v.byte_score) for i in found) - want) < 1e-6


def test_stream_commits_and_stays_small(codec):
    stream, most, out = S.Stream(codec.vocabulary), 0, []
    for w in ("the and nation " * 400).split(" "):
        out += stream.feed(S.MARK + w)
        most = max(most, len(stream.text))
    assert most <= 4 * codec.vocabulary.longest
    assert out + stream.close() == S.segment(codec.vocabulary, "".join(S.MARK + w for w in ("the and nation " * 400).split(" ")))


def test_long_unbroken_text_takes_linear_time(codec):
    import time
    took = []
    for n in (50_000, 200_000):
        t = time.process_time()
        assert codec.decode(codec.encode("ab" * n)) == "ab" * n
        took.append(time.process_time() - t)
    assert took[1] < 10 * took[0] + 1


def test_tables(spark, tmp_path):
    texts = edge_texts()
    docs = documents(spark, texts).withColumn("ids", F.lit("clash"))
    coded = S.encode(docs)
    back = {r["doc_id"]: r["decoded"] for r in S.decode(coded, out="decoded").collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = QUERIES["op5_sentencepiece"](spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) and all(r["round_trip"] for r in rows)
    assert S.encode(docs.limit(0)).collect() == []


def test_stream_holds_a_window_on_a_run_of_one_letter(codec):
    """Scores and characters stay within the longest piece, committed or not; what is undecided is six bytes a character."""
    v, n = codec.vocabulary, 300_000
    for letters in ("a", "ab", "=", "e\n"):
        stream, most, count = S.Stream(v), 0, 0
        for a in range(0, n, 1000):
            count += len(stream.feed((letters * 1000)[:1000]))
            most = max(most, len(stream.text), len(stream.score), len(stream.root))
            assert len(stream.step) == len(stream.ids) <= a + 1000
        assert most <= v.longest + 1
        ids = count + len(stream.close())
        assert ids == len(S.segment(v, (letters * n)[:n]))
        assert stream.read(S.MARK + "the") == S.segment(v, S.MARK + "the")


def test_every_unit_goes_through_a_stream(codec):
    fresh = S.Codec(S.load_pieces())
    text = " ".join(f"word{k} Straße{k % 7} 漢字" for k in range(200))
    assert fresh.decode(fresh.encode(text)) == text
    assert fresh.units.streamed == len(fresh.units) == len(set(text.split(" ")))
    fresh.encode(text)
    assert fresh.units.streamed == len(fresh.units)
