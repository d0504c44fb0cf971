import math
from collections import Counter

from helpers import documents, edge_texts, words

from strata.llm import quality_rules as Q

from pyspark.sql import functions as F


def base(text):
    t, w = text or "", words(text)
    lines = [x for x in t.split("\n") if words(x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered |= set(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_base_figures(spark):
    texts = edge_texts() + ["a b c d e f g h i " * 3, "a b c d e f g h a b c d e f g h", "x " * 40, "# $ % | <> & * k"]
    docs = documents(spark, texts).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = Q.judge(docs, labels).collect()
    assert len(rows) == len(texts)
    for r in rows:
        b = base(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == b
        assert r["base_failed"] == (b[0] < 20 or 100 * b[4] > 30 * b[0])
        assert r["kept"] == (not r["base_failed"])  # nothing trusted: the base rules decide


def test_ratio_against_brute_force(spark):
    xxhash = __import__("xxhash")
    good = [f"the small bird number {i} sang a quiet song over the green field and then it flew away home to rest" for i in range(30)]
    bad = [f"BUY!! NOW!! {i}!! CHEAP!! PILLS!! CLICK!! HERE!! FREE!! WIN!! CASH!! " + " ".join(f"q{i}{j}" for j in range(12)) for i in range(30)]
    texts = good + bad
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 20)) for i in [*range(20), *range(30, 50)]] + [(3, 1), (None, 1), (4, None)], "doc_id long, quality int")
    rows = {r["doc_id"]: r for r in Q.judge(docs, labels, n=512).collect()}
    assert all(rows[i]["kept"] for i in range(30))
    assert not any(rows[i]["kept"] for i in range(30, 60))

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def grams(t):
        h = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in words(t)]
        out = [signed(x) % 512 for x in h]
        for i, x in enumerate(h):  # a pair's hash chains the first word's as seed of the second
            seed = 42
            for y in h[i:i + 2]:
                seed = xxhash.xxh64(y.to_bytes(8, "little"), seed=seed).intdigest()
            out.append(signed(seed) % 512)
        return out

    raw = Counter(b for t in texts for b in grams(t))
    trusted = Counter(b for i in range(20) for b in grams(texts[i]))

    def ratio(b):
        return math.log((trusted[b] + .5) / (sum(trusted.values()) + 256)) - math.log((raw[b] + .5) / (sum(raw.values()) + 256))

    for i, t in enumerate(texts):
        g = grams(t)
        assert abs(rows[i]["score"] - sum(map(ratio, g)) / len(g)) < 1e-9


def test_native_and_empty(spark):
    docs = documents(spark, ["a"])
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    plan = Q.judge(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert Q.judge(docs.limit(0), labels.limit(0)).collect() == []


def test_threshold_keeps_all_where_nothing_separates(spark):
    def cut(rows):
        return Q.threshold(spark.createDataFrame(rows, "good boolean, score double"))

    assert cut([(True, -3.5), (False, -3.5), (True, 0.1), (False, 0.1)]) == -math.inf
    assert cut([(True, -3.0), (False, -4.0)]) == -3.99 and cut([(True, 5.0), (False, 3.0)]) == 3.01
    assert cut([(True, 1.0)]) == -math.inf


def test_all_trusted_documents_count(spark):
    texts = [f"the small bird number {i} sang a quiet song over field {i * i}" for i in range(30)]
    labels = spark.createDataFrame([(i, i % 3) for i in range(20)], "doc_id long, quality int")
    few, every = ({r["doc_id"]: r["score"] for r in Q.judge(documents(spark, texts), labels, n=512, max_labelled=m).collect()}
                  for m in (2, 1000))
    assert few == every and any(every.values())


def test_threshold_is_set_on_all_labelled_documents(spark):
    ids = [r["id"] for r in spark.range(20_060).orderBy(F.xxhash64("id")).collect()]
    bad = set(ids[20_000:])  # the last by id hash
    texts = [" ".join(f"{'buy' if i in bad else 'calm'}{j}" for j in range(22)) for i in range(len(ids))]
    labels = spark.createDataFrame([(i, int(i not in bad)) for i in ids], "doc_id long, quality int")
    dropped = {r["doc_id"] for r in Q.judge(documents(spark, texts), labels, n=512).where("not kept and not base_failed").collect()}
    assert dropped == bad


def test_texts_are_measured_once(spark):
    docs = documents(spark, ["a b c"] * 3).withColumn("id", F.lit("clash")).withColumn("m", F.lit("clash"))
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    judged = Q.judge(docs, labels)
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" not in plan and "split" not in plan  # neither figure nor score is computed again for the result
    assert judged.columns == [*docs.columns, *Q.COLUMNS]
    assert Q.judge(docs, labels, passed=["doc_id"]).columns == ["doc_id", *Q.COLUMNS]
