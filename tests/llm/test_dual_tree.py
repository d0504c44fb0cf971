import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import documents, edge_texts, lower

from strata.llm import dual_tree as D

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(lower(text))


def plain(docs, items, k):
    """Rows (item place, rank, id, score) by scoring every document; docs and items are (id, text)."""
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    counted = [x for x in counted if x[2]]
    n, length = len(counted), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for place, (_, text) in enumerate(items):
        scores = []
        for i, c, size in counted:
            m = 100 - 25 + (25 * size * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(place, r, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return out


def corpus(rng, rows):
    return [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 4) for _ in range(rng.randrange(80)))
            for _ in range(rows)]


@pytest.mark.parametrize("small", [False, True])
def test_against_scoring_every_document(spark, monkeypatch, small):
    if small:  # many trees, leaves, levels, blocks and slices
        for name, value in (("BLOCK_ITEMS", 5), ("BLOCK_TERMS", 40), ("TREE_CELLS", 300), ("LEAF_DOCS", 2),
                            ("LEAF_ITEMS", 2), ("FAN", 2)):
            monkeypatch.setattr(D, name, value)
    rng = random.Random(2)
    texts = edge_texts() + corpus(rng, 250)
    texts += texts[-20:] + ["AbC-abc_ABC 12 é漢字", "\x00abc\x7fé"]  # repeats give ties
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, texts[40]), (None, "abc é"), (7, texts[41]), (7, texts[41])]
    docs += [((1 << 53) + 1, texts[42]), ((1 << 53) + 2, texts[42])]
    items = [(i, " ".join(rng.choice(texts[11:]).split()[:rng.randrange(30)])) for i in range(23)]
    items += [(None, "abc"), (5, None), (5, ""), (6, "--- ???"), (3, items[3][1]), (99, "nosuchterm"), (8, "é É 漢字")]
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(3) \
        .selectExpr("*", "'x' AS item_id", "1.5D AS score", "0 AS rank")
    right = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    got = D.search(left, right, k=6)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    want = [(items[p][0], r, i, s) for p, r, i, s in plain(docs, items, 6)]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_most_pairs_of_leaves_are_pruned(spark):
    """Documents on one subject each: the items' k-th scores drop nearly all leaves."""
    rng = random.Random(4)
    subjects = [[f"s{s}w{i}" for i in range(20)] for s in range(60)]
    texts = [" ".join(rng.choices(subjects[i % 60], k=40)) for i in range(6000)]
    ids, terms_, own = next(D._blocks(spark.createDataFrame(
        [(i, " ".join(rng.choices(subjects[i], k=12))) for i in range(60)], "id long, text string")))
    counts = D.counted(spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1), terms_)
    n, length, w = D._weights(counts, len(terms_))
    of = D.Search(own, w, n, length, 20)
    for row in counts.collect():
        of.add(bytes(row["blob"]))
    assert of.scored < len(texts) * 60 / 20
    assert all(len(score) == 20 for _, _, _, score in of.found())


def test_sums_beyond_doubles(spark):
    of = D.Search([np.zeros(400_000, np.int64)], np.array([30_000]), 2, 2, 1)
    assert of.items.dtype == np.int64


def test_empty_tables(spark):
    docs, items = documents(spark, ["a b"]), spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert D.search(docs.limit(0), items).collect() == []
    assert D.search(docs, items.limit(0)).collect() == []
    assert D.search(docs, items).schema["item_id"].dataType.simpleString() == "int"
