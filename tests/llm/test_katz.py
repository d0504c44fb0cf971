import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import documents, edge_texts, lower, words

from strata.llm import katz as Z
from strata.llm.packed import pack, unpack


def model(rows, vocabulary):
    """Plain Katz bigram model of the training rows; returns P(w | h) by class of h, and counts."""
    train = [words(lower(t)) + ["</s>"] for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10]
    count = Counter(w for x in train for w in x)
    total, types = sum(count.values()), Counter(count.values())
    d1 = Z.discounts([types[r] for r in range(1, 7)])
    keep = 1 - Z.RESERVED

    def p_all(c):
        return keep * (d1[c - 1] if c <= 5 else Z.BIG) * c / total

    unknown = keep - sum(map(p_all, count.values()))
    groups, top = defaultdict(list), []
    for w, c in count.items():
        groups[math.floor(math.log2(c) * 64)].append(w)
    for o in sorted(groups, reverse=True):
        if len(top) + len(groups[o]) > vocabulary:
            break
        top += groups[o]
    top = set(top) | {"</s>"}
    p_class = {w: p_all(count[w]) for w in top}
    p_class[None] = keep - sum(p_class.values())
    pairs = defaultdict(Counter)
    for x in train:
        h = "<s>"
        for w in x:
            c = w if w in top else None
            pairs[h][c] += 1
            h = c
    of = Counter(c for x in pairs.values() for c in x.values())
    d2 = Z.discounts([of[r] for r in range(1, 7)])

    def share(h, c):
        n = pairs[h][c]
        return (d2[n - 1] if n <= 5 else Z.BIG) * n / sum(pairs[h].values())

    back = {h: (1 - sum(share(h, c) for c in x)) / (1 - sum(p_class[c] for c in x)) for h, x in list(pairs.items())}

    def p(h, w):
        c = w if w in top else None
        x = p_class[c] if h not in back else share(h, c) if pairs[h][c] else back[h] * p_class[c]
        return x if c is not None else x * (p_all(count[w]) if count[w] else unknown) / p_class[None]

    return p, count, total, top, back


@pytest.mark.parametrize("vocabulary,dense", [(1 << 16, 1024), (1 << 16, 6), (40, 7), (40, 1), (0, 1024)])
def test_scores_against_a_plain_model(spark, monkeypatch, vocabulary, dense):
    monkeypatch.setattr(Z, "PART_TOKENS", 4000)
    monkeypatch.setattr(Z, "DENSE", dense)
    texts = edge_texts() + [" ".join(f"w{(i * j * j) % (7 + i)}" for j in range(30)) + " The END" for i in range(120)]
    rows = list(enumerate(texts)) + [(5, "the same id"), (None, "w1 w2 w3"), (None, "w1 w2 w3")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    p, count, total, top, back = model(rows, vocabulary)
    for h in list(back)[:20]:
        mass = sum(p(h, w) for w in count) + p(h, "never met") + Z.RESERVED * back[h]
        assert abs(mass - 1) < 1e-9
    got = sorted((tuple(r) for r in Z.score(df, vocabulary=vocabulary).collect()), key=str)
    want = []
    for i, t in rows:
        w, h, own = words(lower(t)) + ["</s>"], "<s>", 0.0
        for x in w:
            own += math.log10(p(h, x))
            h = x if x in top else None
        base = sum(math.log10((count[x] + .1) / (total + .1 * (len(count) + 1))) for x in w)
        held = i is not None and zlib.crc32(str(i).encode()) % 10 == 0
        want.append((i, held, len(w), sum(count[x] > 0 for x in w), total, base, own))
    want.sort(key=str)
    for a, b in zip(sorted(got, key=lambda r: (str(r[0]), r[2], r[5])), sorted(want, key=lambda r: (str(r[0]), r[2], r[5]))):
        assert a[:5] == b[:5]
        assert abs(a[5] - b[5]) < 1e-7 * max(1, abs(b[5])) and abs(a[6] - b[6]) < 1e-7 * max(1, abs(b[6]))
    assert len(got) == len(want)


def test_without_training_and_empty(spark):
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    one = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    r = Z.score(one).first()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (True, 3, 0, 0, 0, 0)
    assert Z.score(documents(spark, ["a"]).limit(0)).collect() == []


def test_packing_round_trips():
    rng = np.random.default_rng(1)
    cols = {"a": rng.integers(0, 1 << 40, 1000), "b": rng.random(17), "c": np.zeros(0, np.uint8), "d": np.arange(300, dtype=np.uint16)}
    back = unpack(pack(**cols))
    assert all((back[k] == v).all() and back[k].dtype == v.dtype for k, v in cols.items())


@pytest.mark.parametrize("table,dense", [(0, 1024), (12, 5), (40, 1024)])
def test_every_pair_is_counted_whatever_the_table(spark, monkeypatch, table, dense):
    monkeypatch.setattr(Z, "PART_TOKENS", 500)
    monkeypatch.setattr(Z, "DENSE", dense)
    texts = edge_texts() + [" ".join(f"w{(i * j * j) % (7 + i)}" for j in range(30)) + " The END" for i in range(120)]
    held = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = list(enumerate(texts)) + [(None, "rare1 rare2 rare3")] * 8 + [(None, "rare1 w3 rare2")]
    rows += [(held[0], "rare1 rare2"), (held[1], "rare1 rare3 rare1 new1 new2 w3 rare1 w5"), (held[2], "rare2 rare1 w1 rare3")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    p, count, total, _, _ = model(rows, 1 << 30)
    want = defaultdict(list)
    for i, t in rows:
        w = words(lower(t)) + ["</s>"]
        own = sum(math.log10(p(h if h == "<s>" or h in count else None, x)) for h, x in zip(["<s>", *w], w))
        base = sum(math.log10((count[x] + .1) / (total + .1 * (len(count) + 1))) for x in w)
        want[i].append((len(w), sum(count[x] > 0 for x in w), base, own))
    got = defaultdict(list)
    for r in Z.score(df, table=table).collect():
        got[r["doc_id"]].append((r["n_tokens"], r["n_known"], r["base_score"], r["score"]))
    assert got.keys() == want.keys()
    for i, rows_of in want.items():
        for a, b in zip(sorted(got[i]), sorted(rows_of), strict=True):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-9, abs=1e-7)


@pytest.mark.parametrize("table", [1 << 16, 40])
def test_answers_take_few_bytes_a_token_at_any_number_of_parts(spark, monkeypatch, table):
    """Sums that a part adds up by document come to two doubles a token once the parts are many; counts do not."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 300) % 4000)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(Z, "DENSE", 4)
    size, scores, kept = [], [], Z.store

    def measured(made, name):
        out = kept(made, name)
        if name == "katz-tables":
            size.append(sum(len(r["blob"]) for r in out.where("kind = 'answer'").collect()))
        return out

    monkeypatch.setattr(Z, "store", measured)
    for tokens in (90_000, 1_500):
        monkeypatch.setattr(Z, "PART_TOKENS", tokens)
        scores.append(sorted((r["doc_id"], r["score"]) for r in Z.score(df, table=table).collect()))
    assert [i for i, _ in scores[0]] == [i for i, _ in scores[1]]
    assert [x for _, x in scores[0]] == pytest.approx([x for _, x in scores[1]], rel=1e-9)
    assert max(size) < 2 * 300 * 301, size
