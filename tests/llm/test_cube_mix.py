import numpy as np
from helpers import documents, edge_texts, words

from strata.llm import cube_mix as C

from pyspark.sql import functions as F


def water(sizes, weights, cap):
    total, full = sum(sizes), set()
    while True:
        left = total - sum(cap * sizes[i] for i in full)
        w = sum(weights[i] for i in range(len(sizes)) if i not in full)
        t = [cap * s if i in full else left * weights[i] / w for i, s in enumerate(sizes)]
        over = {i for i in range(len(sizes)) if i not in full and t[i] > cap * sizes[i]}
        if not over:
            return t
        full |= over


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(3)
    p, size = rng.random(500), rng.integers(1, 900, 500).astype(float)
    x = C.fly(p, size)
    assert abs(x.sum() - p.sum()) < 1e-6 and abs((x * size).sum() - (p * size).sum()) < 1e-3
    assert ((x > 0) & (x < 1)).sum() <= 2
    y = C.land(x, size, 0.0)
    assert set(y) <= {0.0, 1.0} and abs(((y - p) * size).sum()) <= size.max()


def test_targets_and_mix(spark):
    texts = [" ".join(["w"] * (1 + (i * 37) % 90)) for i in range(900)] + edge_texts()
    sources = [None, "b", "c", "c", "c", "é", "é", "zz", "B", "c"]
    docs = documents(spark, texts, sources).withColumn("target", F.lit("clash"))
    weights = C.ranked_weights(docs)
    order = ["B", "b", "c", "zz", "é", None]
    w = {r["source"]: r["weight"] for r in weights.collect()}
    assert [w[s] for s in order] == [5, 2, 1, 5, 2, 1]
    rows = C.mix(docs, weights, cap=3.0, block=50).collect()
    again = C.mix(docs.repartition(7), weights, cap=3.0, block=50).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)
    assert len(rows) == len(texts)
    size = {s: sum(r["size"] for r in rows if r["source"] == s) for s in order}
    want = dict(zip(order, water([size[s] for s in order], [w[s] for s in order], 3.0)))
    for r in rows:
        assert r["size"] == len(words(texts[r["doc_id"]])) and r["source_size"] == size[r["source"]]
        assert r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, r["target"])
    for s in order:
        of = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in of) - want[s]) <= max(r["size"] for r in of)


def test_empty_and_sizeless(spark):
    docs = documents(spark, ["x"]).limit(0)
    assert C.mix(docs, C.ranked_weights(docs)).collect() == []
    docs = documents(spark, [None, "", " "])
    assert [r["taken"] for r in C.mix(docs, C.ranked_weights(docs)).collect()] == [0, 0, 0]


def test_take_repeats_rows(spark):
    docs = documents(spark, ["a b c"] * 3 + ["d e"] * 30, ["s"] * 3 + ["t"] * 30)
    docs = docs.unionByName(docs.where("doc_id = 0"))
    weights = C.ranked_weights(docs)
    taken = C.take(docs, weights)
    mixed = C.mix(docs, weights).agg(F.sum("copies")).first()[0]
    assert taken.columns == docs.columns and taken.count() == mixed
