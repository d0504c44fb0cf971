import random

import numpy as np
import pytest
from helpers import DOCS, documents, edge_texts, lower, words

from strata.llm import components as C
from strata.llm import jaccard_join as J
from strata.llm.components import components

from pyspark.sql import functions as F


def shingles(text, n):
    w = words(lower(text))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    ids = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            ids[root(k)] = min(ids.get(root(k), i), i)
    return sorted((str(i), len(s), str(ids.get(root(k))) if s else str(i)) for k, (i, s) in enumerate(sets))


def family_texts():
    """Groups of near copies with few to many edits around both thresholds, long and short."""
    rnd = random.Random(9)
    out = []
    for size in (4, 9, 12, 25, 60, 150, 400):
        base = [f"w{rnd.randrange(5000)}" for _ in range(size)]
        for _ in range(14):
            t = list(base)
            for _ in range(rnd.randrange(0, 2 + size // 40)):
                t[rnd.randrange(len(t))] = f"e{rnd.randrange(9999)}"
            out.append(" ".join(t))
    common = " ".join(f"p{i}" for i in range(30))
    out += [common + " " + " ".join(f"x{rnd.randrange(9999)}" for _ in range(40)) for _ in range(25)]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("n,percent,tile", [(3, 90, 1024), (3, 90, 4), (5, 80, 1024), (5, 80, 6), (2, 100, 1024)])
def test_components_against_brute_force(spark, n, percent, tile):
    rows = list(enumerate(edge_texts() + family_texts()))
    rows += [(3, rows[20][1]), (None, rows[21][1]), (None, "alone here now"), (None, "alone here now"), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit(1), "node": F.lit(2)})
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]))
                 for r in J.join(df, n=n, percent=percent, tile=tile).collect())
    assert got == brute(rows, n, percent)


def test_tree_loses_no_partner():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 60, rng.integers(10, 300)).astype(np.uint64)
        for _ in range(6):
            s = base.copy()
            s[rng.integers(0, len(s), len(s) // 25)] = rng.integers(0, 1 << 60, len(s) // 25)
            sets.append(np.unique(s))
    points = np.array([J.count_vector(s, 128) for s in sets])
    tree = J.CountTree(points, 90)
    for i, s in enumerate(sets):
        near = set(tree.near(points[i]).tolist())
        assert {j for j, t in enumerate(sets) if J.links(s, t, 90)} <= near
        assert len(near) < 60  # and the boxes do bound something


def test_linked_sets_meet_in_a_block():
    rng = np.random.default_rng(6)
    for percent in (80, 90, 95):
        for _ in range(400):
            base = np.unique(rng.integers(0, 1 << 60, rng.integers(2, 400)).astype(np.uint64))
            cut = int(len(base) * rng.random() * 0.12)
            other = np.unique(np.r_[base[cut:], rng.integers(0, 1 << 60, int(len(base) * rng.random() * 0.08)).astype(np.uint64)])
            if len(other) and J.links(base, other, percent) and J.node_of(base) != J.node_of(other):
                assert set(J.block_keys(base, percent).tolist()) & set(J.block_keys(other, percent).tolist())


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (301, 300), (300, 301)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b", "t").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 300: 300, 301: 300}


def test_one_of_each_and_empty(spark):
    docs = documents(spark, ["a b c d e f"] * 4 + ["x y z"] + ["", "", None])
    docs = docs.unionByName(docs.where("doc_id = 0"))
    assert sorted(r["doc_id"] for r in J.one_of_each(docs).collect()) == [0, 4, 5, 6, 7]
    empty = spark.createDataFrame([], DOCS)
    assert J.join(empty).collect() == [] and J.one_of_each(empty).collect() == []
    with pytest.raises(ValueError):
        J.join(empty, percent=50)


@pytest.mark.parametrize("n,percent,tile", [(3, 90, 1024), (5, 80, 6)])
def test_links_against_brute_force(spark, n, percent, tile):
    rows = list(enumerate(edge_texts() + family_texts()))
    rows += [(3, rows[20][1]), (None, rows[21][1]), (900, rows[21][1]), (901, rows[22][1])]
    sets = [shingles(t, n) for _, t in rows]

    def near(x, y):
        return bool(x) and bool(y) and 100 * len(x & y) >= percent * len(x | y)

    want = sorted((str(i), sum(near(x, y) for y in sets) - bool(x)) for (i, _), x in zip(rows, sets))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.join(df, n=n, percent=percent, tile=tile).collect()
    assert sorted((str(r["doc_id"]), r["n_links"]) for r in got) == want
    assert max(c for _, c in want) > 5
    pairs, nodes = J.node_links(df, n=n, percent=percent, tile=tile)
    of = {r["node"]: r["n_shingles"] for r in nodes.collect()}
    found = [(r["a"], r["b"]) for r in pairs.collect()]
    different = list(dict.fromkeys(sets))
    assert nodes.count() == len(rows) and len(of) == len(different) and {x for p in found for x in p} <= of.keys()
    assert len(found) == len(set(found)) and all(a < b for a, b in found)
    assert len(found) == sum(near(x, y) for k, x in enumerate(different) for y in different[:k])


def test_rounds_of_few_edges_have_few_tasks(spark, monkeypatch):
    tasks, coalesce = {}, "spark.sql.adaptive.coalescePartitions.enabled"

    def spy(df, name):
        out = store(df, name)
        tasks[name] = len(out.inputFiles())
        return out

    store = C.store
    monkeypatch.setattr(C, "store", spy)
    monkeypatch.setattr(C, "TASK_EDGES", 50)
    edges = spark.createDataFrame([(i, i + 1) for i in range(99)] + [(200, 201)], "a long, b long")
    old = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        found = {r["node"]: r["root"] for r in C.components(edges, "a", "b", "few").collect()}
    finally:
        spark.conf.set(coalesce, old)
    assert found == {**{i: 0 for i in range(100)}, 200: 200, 201: 200}
    assert all(n <= 2 for name, n in tasks.items() if name != "few-0") and len(tasks) > 4
