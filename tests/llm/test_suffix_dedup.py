import hashlib
import random

import numpy as np
import pytest
from helpers import documents, edge_texts

from strata.llm import suffix_dedup as Z


def brute(rows):
    first, out = {}, []
    order = [(float("inf") if i is None else i, (t or "").encode()) for i, t in rows]
    for k, b in order:
        for i in range(len(b) - 49):
            s = b[i:i + 50]
            first[s] = min(first.get(s, k), k)
    for (i, _), (k, b) in zip(rows, order):
        covered = bytearray(len(b))
        for j in range(len(b) - 49):
            if first[b[j:j + 50]] < k:
                covered[j:j + 50] = b"\1" * 50
        spans = sum(1 for j in range(len(b)) if covered[j] and (j == 0 or not covered[j - 1]))
        kept = bytes(x for x, c in zip(b, covered) if not c)
        out.append((str(i), len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def pieces():
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abcdé ") for _ in range(200)) for _ in range(6)]
    out = []
    for _ in range(60):
        t = ""
        for _ in range(rnd.randint(0, 5)):
            x, a = rnd.choice(base), rnd.randint(0, 150)
            t += x[a:a + rnd.choice([30, 44, 49, 50, 51, 60, 120])] + rnd.choice(["", "#", " ab" * 20, "z" * 70])
        out.append(t)
    return out + ["aaaa" * 50, "a" * 60, "a" * 50, "a" * 49, "ab" * 40, "ba" * 40]


@pytest.mark.parametrize("part_bytes,windows", [(8 << 20, 500_000), (1500, 500_000), (3000, 40)])
def test_spans_against_brute_force(spark, monkeypatch, part_bytes, windows):
    monkeypatch.setattr(Z, "PART_BYTES", part_bytes)
    monkeypatch.setattr(Z, "WINDOWS", windows)
    texts = pieces() + edge_texts()
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[5]), (None, texts[5]), (8, texts[9])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in Z.dedup(df).collect())
    assert got == brute(rows)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(2)
    shared = rng.integers(97, 101, 120).astype(np.uint8)
    a = np.r_[rng.integers(97, 101, 300).astype(np.uint8), shared, rng.integers(97, 101, 77).astype(np.uint8)]
    b = np.r_[rng.integers(97, 101, 31).astype(np.uint8), shared]
    at = {}
    for name, x, shift in (("a", a, 300), ("b", b, 31)):
        p, h, first, last = Z.anchors(x, np.array([0, len(x)]))
        for i in range(len(p)):
            for w in range(first[i], last[i] + 1):
                if shift <= w <= shift + 70:
                    at.setdefault(w - shift, set()).add((p[i] - w, h[i]))
    assert len(at) == 71 and all(len(v) == 1 for v in at.values())


def test_long_texts_cross_stretches(spark, monkeypatch):
    monkeypatch.setattr(Z, "_STRETCH", 500)
    texts = [" ".join(f"w{(i * i) % 4001}" for i in range(3000)), " ".join(f"w{(i * i) % 4001}" for i in range(900, 2500))]
    rows = list(enumerate(texts))
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                 for r in Z.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows)


def test_empty(spark):
    assert Z.dedup(documents(spark, ["a"]).limit(0)).collect() == []
