import hashlib

from helpers import DOCS, documents, edge_texts, words

from strata.llm import fingerprint as P
from strata.llm.queries import QUERIES

from pyspark.sql import functions as F


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


TEXTS = edge_texts() + [" ".join(f"t{(i * k) % 97}" for k in range(150)) for i in range(1, 30)]


def test_edited_texts_and_likeness(spark, tmp_path):
    """The registered query against plain Python, ids with gaps, several ranges of ids and a null text."""
    rows = [(i * 700 - 3000, t, None, None, None) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op10_fingerprint"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    order = sorted(((r[0], r[1] or "") for r in rows), reverse=True)
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r["near_edited"] - jaccard(shingles(t), shingles(edited))) < 0.2
        assert abs(r["near_next"] - jaccard(shingles(t), shingles(following))) < 0.2
        if not words(t) and not words(edited):
            assert r["fingerprint"] == r["edited_fingerprint"] == ""
    same = [got[5 * 700 - 3000]["fingerprint"], got[6 * 700 - 3000]["fingerprint"]]
    assert same[0] == same[1] != ""


def test_estimates_and_merging(spark):
    a, b = " ".join(f"a{i}" for i in range(4000)), " ".join(f"a{i}" for i in range(1000, 6000))
    df = spark.createDataFrame([(a, b)], "a string, b string").select(P.sketch(F.col("a")).alias("a"), P.sketch(F.col("b")).alias("b"))
    r = df.select(P.resemblance(F.col("a"), F.col("b")).alias("j"), P.containment(F.col("a"), F.col("b")).alias("c"),
                  P.distinct_shingles(F.col("a")).alias("n"),
                  P.distinct_shingles(P.merge(F.col("a"), F.col("b"))).alias("u")).first()
    assert abs(r["j"] - 0.5) < 0.15 and abs(r["c"] - 0.75) < 0.2
    assert abs(r["n"] / 3996 - 1) < 0.3 and abs(r["u"] / 5996 - 1) < 0.3
    parts = documents(spark, [a[:9000], a[8900:], b], ["x", "x", "y"])
    merged = P.merge_groups(parts.select("source", P.sketch(F.col("text")).alias("sketch")), ["source"])
    both = parts.where("source = 'x'").agg(F.collect_list(P.shingle_hashes(F.col("text"))).alias("h")) \
        .select(F.slice(F.sort_array(F.array_distinct(F.flatten("h"))), 1, P.K).alias("s")).first()["s"]
    assert {r["source"]: r["sketch"] for r in merged.collect()}["x"] == both


def test_empty_ties_and_native(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    assert QUERIES["op10_fingerprint"](spark, str(tmp_path / "a")).collect() == []
    rows = [(5, "x y", None, None, None)] * 3 + [(None, "q", None, None, None), (9, None, None, None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    q = QUERIES["op10_fingerprint"](spark, str(tmp_path / "b"))
    assert q.count() == 5
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _plain_next(rows):
    """Descending by (id, hash, value), null last; each row's next, and the last one's the first."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]), reverse=True)
    return sorted((repr((r[0], r[1], order[(k + 1) % len(order)][1])) for k, r in enumerate(order)))


def test_next_by_sparse_dense_and_repeated_ids(spark, monkeypatch):
    """Hashed 64-bit ids, dense ones beside them, one id and null ids on very many rows; many buckets."""
    import random
    monkeypatch.setattr(P, "ROWS", 8)
    monkeypatch.setattr(P, "HOT", 40)
    rng = random.Random(4)
    cases = {
        "sparse": [rng.randrange(-(1 << 63), 1 << 63) for _ in range(500)],
        "dense": list(range(300)) + [(1 << 62) + 4096 * k for k in range(200)],
        "repeated and large": [(1 << 62) + 1] * 300 + [(1 << 62) + k for k in range(30)] + [None] * 120,
        "repeated": [7] * 300 + list(range(100)) + [None] * 120,
        "null": [None] * 90, "few": [3, 1, 2], "one": [5],
    }
    for name, ids in cases.items():
        docs = spark.createDataFrame([(i, f"{name} {k}") for k, i in enumerate(ids)], "doc_id long, text string").repartition(3)
        rows = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()]
        got = P.with_next(docs, "doc_id", F.col("text"), "own", "next")
        assert sorted(repr(tuple(r)) for r in got.collect()) == _plain_next(rows), name
        size = P._dealt(docs.withColumn("__tie", F.xxhash64("text")), F.col("doc_id")).groupBy("__bucket").count()
        r = size.agg(F.count("*").alias("n"), F.max("count").alias("most")).first()
        if len(ids) > 200:  # neither one bucket a row nor all rows in one
            assert r["most"] <= 80 and r["n"] <= len(ids) * 3 / 4, (name, r)
