"""The pipeline's stages on a small corpus, each against plain Python on its own input."""

import corpus_pipeline as C
from helpers import documents, words
from test_jaccard_join import brute
from test_quality_rules import base

from strata.llm import sentencepiece_codec
from strata.llm.common import store
from strata.llm.queries import QUERIES

from pyspark.sql import functions as F


def corpus():
    good = [" ".join(f"word{(i * 31 + j * j) % 400}" for j in range(60)) + f" mail a{i}@b.com end" for i in range(80)]
    copies = [g.replace("end", "fin") for g in good[:20]] + good[20:30]
    bad = ["spam!! " + " ".join(f"JUNK{j % 9}!!" for j in range(40)) + f" x{i}" for i in range(20)]
    return good + copies + bad + ["too short", None, ""]


def test_stages(spark, tmp_path):
    texts = corpus()
    documents(spark, texts, ["a", "b", "c"]).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1) for i in range(60)] + [(i, 0) for i in range(110, 125)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    assert [n for n, _ in C.STAGES] == ["quality rules", "n-gram Jaccard join", "PII", "mixing sources", "SentencePiece encoding"]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = [docs]
    for name, stage in C.STAGES:
        seen.append(store(stage(spark, seen[-1], str(tmp_path)), "test-pipeline"))
    for df in seen[1:5]:
        assert df.columns == docs.columns
    kept = {r["doc_id"]: r["text"] for r in seen[1].collect()}
    for i, t in enumerate(texts):
        b = base(t)
        assert (i in kept) == (b[0] >= 20 and 100 * b[4] <= 30 * b[0] and "JUNK" not in (t or ""))
    single = {r["doc_id"]: r["text"] for r in seen[2].collect()}
    assert set(single) == {int(i) for i, _, c in brute(sorted(kept.items()), C.SHINGLE, C.PERCENT) if i == c}
    clean = {r["doc_id"]: r for r in seen[3].collect()}
    assert {i: r["text"] for i, r in clean.items()} == {i: t.replace(f" a{i % 80}@b.com", " [email]") if "@" in t else t
                                                       for i, t in single.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in clean.values())
    mixed = seen[4].groupBy("doc_id").count().collect()
    assert {r["doc_id"] for r in mixed} <= set(clean) and all(r["count"] <= 3 for r in mixed)
    size = {i: len(words(r["text"])) for i, r in clean.items()}
    total = sum(size[r["doc_id"]] * r["count"] for r in mixed)
    assert abs(total - sum(size.values())) <= 3 * max(size.values())
    codec = sentencepiece_codec.Codec(sentencepiece_codec.load_pieces())
    for r in seen[5].collect():
        assert codec.decode(r["ids"]) == clean[r["doc_id"]]["text"] and r["n_ids"] == len(r["ids"])
    assert seen[5].count() == seen[4].count()


def test_registered_and_empty(spark, tmp_path):
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    documents(spark, ["a"]).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    assert C.run(spark, str(tmp_path)).collect() == []
