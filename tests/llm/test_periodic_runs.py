import random
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest
from helpers import documents, edge_texts, words

from strata.llm import periodic_runs as R
from strata.llm.queries import QUERIES


def plain(w):
    """Runs by comparing every word with the one p later, for every p."""
    n, found = len(w), {}
    for p in range(1, n // 3 + 1):
        j = 0
        while j + p < n:
            s = j
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > s and j - s + p >= max(24, 3 * p):
                found.setdefault((s, j - s + p), p)
            j += 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda x: (x[0], x[2]))


def without(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic(rng, letters):
    out = []
    for _ in range(rng.randrange(1, 5)):
        block = [rng.choice(letters) for _ in range(rng.randrange(1, 30))]
        out += (block * rng.randrange(1, 15))[:rng.randrange(1, 160)]
        out += [rng.choice(letters) for _ in range(rng.randrange(6))]
    return out


def test_extensions_against_plain_comparison():
    rng = random.Random(3)
    for _ in range(40):
        w = np.array([ord(x) for x in periodic(rng, rng.choice(["a", "ab", "abcdefgh"]))])
        of = R.Extensions(w - 97)
        i = np.array([rng.randrange(len(w)) for _ in range(60)])
        j = np.array([rng.randrange(len(w) + 1) for _ in range(60)])
        i, j = i[i != j], j[i != j]
        for a, b, n in zip(i, j, of(i, j)):
            m = 0
            while max(a, b) + m < len(w) and w[a + m] == w[b + m]:
                m += 1
            assert n == m


def test_runs_against_every_period(spark):
    rng = random.Random(7)
    texts = edge_texts() + [" ".join(periodic(rng, rng.choice(["a", "ab", "abc", "abcdefghijklmnop"])))
                            for _ in range(150)]
    texts += ["x " * 23, "x " * 24, "a b c d e f g h " * 3, "a b c d e f g h i " * 3, "a b c d e f g h i " * 2]
    got = {r.doc_id: r for r in R.find(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        w = words(t)
        runs = plain(w) if len(w) < 5000 else []
        assert [tuple(r) for r in got[i].runs] == runs
        assert got[i].collapsed == without(w, runs)
        assert got[i].text == t


def test_slices_and_rows_give_the_same(spark, monkeypatch):
    rng = random.Random(11)
    texts = [" ".join(periodic(rng, "abc")) for _ in range(60)]
    one = R.find(documents(spark, texts)).orderBy("doc_id").collect()
    monkeypatch.setattr(R, "SLICE", 200)
    monkeypatch.setattr(R, "_PAIRS", 7)
    assert R.find(documents(spark, texts)).orderBy("doc_id").collect() == one


@pytest.mark.parametrize("rows", [0, 3])
def test_columns_pass_and_results_replace(spark, rows):
    docs = spark.createDataFrame([((1 << 53) + 1 if i else None, "x " * 30, None, "mine")
                                  for i in range(rows)],
                                 "doc_id long, text string, runs string, start string")
    got = R.find(docs)
    assert got.columns == ["doc_id", "text", "start", "runs", "collapsed"]
    out = got.collect()
    assert len(out) == rows
    assert {(r.doc_id, r.start, r.collapsed) for r in out} == (
        {((1 << 53) + 1, "mine", "x"), (None, "mine", "x")} if rows else set())


def test_query_against_plain(spark, tmp_path):
    rng = random.Random(5)
    texts = edge_texts() + [" ".join(periodic(rng, "abcdefgh")) for _ in range(60)]
    texts += [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(300))) for _ in range(60)]
    documents(spark, texts).union(documents(spark, ["x " * 40]).selectExpr(
        "cast(null as long)", "text", "lang", "source", "n_chars")).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    assert got[None].n_runs == 1 and len(got) == len(texts) + 1
    planted = 0
    for i, t in enumerate(texts):
        w, h = words(t), zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
            planted += 1
        runs = plain(w) if len(w) < 5000 else []
        r = got[i]
        assert r.n_runs == len(runs)
        assert r.collapsed_sha256 == sha256(without(w, runs).encode()).hexdigest()
        assert r.runs_sha256 == sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[1] // best[2])
    assert planted > 5
