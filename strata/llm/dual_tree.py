"""Ranked lexical search by dual trees: the highest-scoring documents of every item, pruned in whole batches.

A term is a maximal match of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z read as a-z. N documents have
a term, L terms in all; n of them are in one document, df documents hold a term. A term weighs
w = floor(1000 * ln((2N + 2) / (2 df + 1))); with m = 75 + (25 n N) div L, a document's score for an item sums
w * ((1000000000 tf) div (1000 tf + 12 m)) over the item's terms, repeats included.

Items come to the driver in blocks of bounded size (``BLOCK_ITEMS`` items, ``BLOCK_TERMS`` unlike terms; an item with
more is a block of its own), and each block is searched against all documents:

1. One pass over the texts keeps of each document only the counts of the block's terms and its number of terms, packed
   by slices of texts and stored. N, L and df are sums over the slices; what is collected is one number a term.
2. Each task reads packed slices. A tree over its documents, ordered by the items their terms weigh for, holds in each node the
   largest value of every term below it; a tree over the items does the same. From the two roots down, the product of
   an item node and a document node bounds the score of each pair below, and a pair of nodes is dropped with all below
   it if the bound is under the weakest k-th score so far of the node's items. Leaves that are left are scored exactly.
   The k-th scores go on from slice to slice.
3. Each task returns at most k documents an item, and the best k of all are taken by a window with a partial limit.

Nothing is dropped but what can't be among the k highest. Terms are compared by 64-bit hash.

Defined cases: a null text has no term; documents and items without terms, or without a common one, give no rows; equal
scores go by ascending id, null last; rows of one id count and rank as documents of their own, and so do repeated
items. Empty tables give no rows. Long texts are read whole, in slices of about a megabyte. Only the named columns are
read; ids of documents are integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shuffle_parts, store
from .packed import pack, slices, smallest, unpack
from .tokens import rows_of, text_column, word_hashes

BLOCK_ITEMS = 512
BLOCK_TERMS = 16_384
TREE_CELLS = 1 << 22  # leaves of a tree over documents times terms
LEAF_DOCS, LEAF_ITEMS, FAN = 4, 1, 8
SCALE = 1_000_000_000
_NO_ID = np.iinfo(np.int64).max

_BETWEEN = np.zeros(256, bool)
_BETWEEN[:128] = True
_BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


def _blocks(items: DataFrame) -> Iterator[tuple[list, np.ndarray, list[np.ndarray]]]:
    """(ids, sorted terms, terms of each item as places in them) of bounded blocks of items that have terms."""
    ids, own, seen = [], [], set()

    def block():
        terms = np.unique(np.concatenate(own))
        return list(ids), terms, [np.searchsorted(terms, x) for x in own]

    for row in items.toLocalIterator():
        hashes, _ = word_hashes(pa.array([row["text"]], pa.string()), between=_BETWEEN)
        if not len(hashes):
            continue
        more = seen | set(hashes.tolist())
        if ids and (len(ids) == BLOCK_ITEMS or len(more) > BLOCK_TERMS):
            yield block()
            ids, own, more = [], [], set(hashes.tolist())
        ids.append(row["id"])
        own.append(hashes)
        seen = more
    if ids:
        yield block()


_COUNTED = "docs long, terms long, held array<struct<term:int,df:long>>, blob binary"
_HELD = pa.list_(pa.struct([("term", pa.int32()), ("df", pa.int64())]))


def counted(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """One row for each slice of documents (id, text): its figures, and the packed counts of the given terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                hashes, upto = word_hashes(text_column(batch, "text"), between=_BETWEEN)
                n = np.diff(upto)
                place = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
                hit = terms[place] == hashes
                pair, tf = np.unique(rows_of(upto)[hit] * len(terms) + place[hit], return_counts=True)
                row, term = pair // len(terms), pair % len(terms)
                held = np.bincount(term, minlength=len(terms))
                at = np.flatnonzero(held)
                keep = np.unique(row)  # documents with one of the terms
                ids = text_column(batch, "id")
                null = ids.is_null().to_numpy(zero_copy_only=False)
                blob = pack(id=ids.fill_null(0).to_numpy()[keep], null=null[keep], n=smallest(n[keep]),
                            size=smallest(np.bincount(np.searchsorted(keep, row), minlength=len(keep))),
                            term=smallest(term), tf=smallest(tf))
                yield pa.RecordBatch.from_arrays([
                    pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64()),
                    pa.array([[{"term": int(t), "df": int(held[t])} for t in at]], _HELD),
                    pa.array([blob], pa.binary())], names=["docs", "terms", "held", "blob"])

    return docs.mapInArrow(run, _COUNTED)


def _weights(slices_: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and the weight of every term of a block."""
    total = slices_.agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    n, length = total["docs"] or 0, total["terms"] or 0
    w = np.zeros(terms, np.int64)
    for row in slices_.select(F.explode("held").alias("h")).groupBy("h.term").agg(F.sum("h.df").alias("df")).collect():
        w[row["term"]] = math.floor(1000 * math.log((2 * n + 2) / (2 * row["df"] + 1)))
    return n, length, w


def _by_strength(row: np.ndarray, term: np.ndarray, strength: np.ndarray, rows: int) -> np.ndarray:
    """Order of rows by their strongest term, then the second and third: like rows come together."""
    order = np.lexsort((term, -strength, row))
    first = np.searchsorted(row[order], np.arange(rows))
    size = np.bincount(row, minlength=rows)
    keys = [np.where(size > k, term[order[np.minimum(first + k, max(len(order) - 1, 0))]], -1) if len(order)
            else np.full(rows, -1) for k in (0, 1, 2)]
    return np.lexsort(keys[::-1])


def _upwards(leaves: np.ndarray) -> list[np.ndarray]:
    """Levels of a tree from its leaves to its root; each node holds the maxima of its FAN children."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(np.maximum.reduceat(levels[-1], np.arange(0, len(levels[-1]), FAN)))
    return levels


class Search:
    """The k highest-scoring documents of every item of a block, over the slices given one after the other."""

    def __init__(self, own: list[np.ndarray], weights: np.ndarray, docs: int, length: int, k: int):
        t = len(weights)
        row = np.repeat(np.arange(len(own)), [len(x) for x in own])
        dense = np.zeros((len(own), t))
        np.add.at(dense, (row, np.concatenate(own)), 1)
        dense *= weights
        at = np.nonzero(dense)
        self.order = _by_strength(at[0], at[1], dense[at], len(own))
        # sums of whole numbers are exact in doubles up to 2 ** 53; beyond, longs are multiplied
        exact = dense.sum(axis=1).max(initial=0) * (SCALE // 1000) < 2 ** 53
        self.items = dense[self.order] if exact else dense[self.order].astype(np.int64)
        self.nearest = dense[self.order].argmax(axis=0)  # the item that weighs each term most
        self.tree = _upwards(np.maximum.reduceat(dense[self.order], np.arange(0, len(own), LEAF_ITEMS)))
        self.docs, self.length, self.k, self.weights = docs, length, k, weights
        self.best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in own]
        self.bar = np.ones(len(own))  # a score must be above 0
        self.scored = self.pairs = 0

    def _bars(self) -> list[np.ndarray]:
        """The weakest k-th score below each node of the items' tree."""
        bars = [np.minimum.reduceat(self.bar, np.arange(0, len(self.bar), LEAF_ITEMS))]
        for _ in self.tree[1:]:
            bars.append(np.minimum.reduceat(bars[-1], np.arange(0, len(bars[-1]), FAN)))
        return bars

    def add(self, blob: bytes) -> None:
        x = unpack(blob)
        rows = len(x["id"])
        if not rows:
            return
        row = np.repeat(np.arange(rows), x["size"].astype(np.int64))
        term, tf = x["term"].astype(np.int64), x["tf"].astype(np.int64)
        n = x["n"].astype(np.int64)
        if int(n.max()) * 25 * self.docs < 2 ** 63:
            m = 75 + (25 * n * self.docs) // self.length
        else:
            m = np.array([75 + (25 * int(v) * self.docs) // self.length for v in n], np.int64)
        value = (SCALE * tf) // (1000 * tf + 12 * m[row])
        # like documents come together: by the items that their terms speak for
        pair, place = np.unique(row * len(self.items) + self.nearest[term], return_inverse=True)
        strength = np.bincount(place, value * self.weights[term].astype(float), minlength=len(pair))
        order = _by_strength(pair // len(self.items), pair % len(self.items), strength, rows)
        starts = np.r_[0, np.cumsum(np.bincount(row, minlength=rows))]
        step = max(1, TREE_CELLS // len(self.weights)) * LEAF_DOCS
        for a in range(0, rows, step):
            part = order[a:a + step]
            size = starts[part + 1] - starts[part]
            at = np.arange(size.sum()) + np.repeat(starts[part] - (np.cumsum(size) - size), size)
            self._tree(x["id"][part], x["null"][part], np.r_[0, np.cumsum(size)], term[at], value[at])

    def _tree(self, ids, null, starts, term, value) -> None:
        t = len(self.weights)
        leaf_of = np.repeat(np.arange(len(ids)) // LEAF_DOCS, np.diff(starts))
        leaves = np.zeros((-(-len(ids) // LEAF_DOCS), t))
        np.maximum.at(leaves, (leaf_of, term), value)
        tree, bars = _upwards(leaves), self._bars()
        # both trees from the root down; alive[i, d]: item node i and document node d may hold a result
        i, d = len(self.tree) - 1, len(tree) - 1
        while True:
            bound = self._bounds(self.tree[i], tree[d]) if i == len(self.tree) - 1 and d == len(tree) - 1 else \
                self._bounds(self.tree[i], tree[d], alive)
            alive = bound >= bars[i][:, None]
            if not i and not d:
                break
            if i:
                i -= 1
                alive = np.repeat(alive, FAN, axis=0)[:len(self.tree[i])]
            if d:
                d -= 1
                alive = np.repeat(alive, FAN, axis=1)[:, :len(tree[d])]
        self.pairs += bound.size
        # most promising documents first, which lifts the bars for the rest
        gain = np.where(alive, bound / np.maximum(bars[0], 1)[:, None], 0).max(axis=0)
        for leaf in np.argsort(-gain, kind="stable"):
            if gain[leaf] > 0:
                self._leaf(leaf, bound[:, leaf], alive[:, leaf], ids, null, starts, term, value)

    @staticmethod
    def _bounds(items: np.ndarray, docs: np.ndarray, alive: np.ndarray | None = None) -> np.ndarray:
        """Upper bounds of the scores of pairs of nodes that are alive (below 0 for others), rounded up."""
        if alive is None:
            return items @ docs.T * (1 + 1e-9)
        out = np.full(alive.shape, -1.0)
        r, c = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if len(r) and len(c):
            out[np.ix_(r, c)] = np.where(alive[np.ix_(r, c)], items[r] @ docs[c].T * (1 + 1e-9), -1.0)
        return out

    def _leaf(self, leaf: int, bound, alive, ids, null, starts, term, value) -> None:
        lowest = np.minimum.reduceat(self.bar, np.arange(0, len(self.bar), LEAF_ITEMS))
        groups = np.flatnonzero(alive & (bound >= lowest))
        if not len(groups):
            return
        rows = (groups[:, None] * LEAF_ITEMS + np.arange(LEAF_ITEMS)).ravel()
        rows = rows[rows < len(self.items)]
        a, b = leaf * LEAF_DOCS, min((leaf + 1) * LEAF_DOCS, len(ids))
        span = slice(starts[a], starts[b])
        used, column = np.unique(term[span], return_inverse=True)
        docs = np.zeros((b - a, len(used)), self.items.dtype)
        docs[np.repeat(np.arange(b - a), np.diff(starts[a:b + 1])), column] = value[span]
        scores = self.items[np.ix_(rows, used)] @ docs.T
        self.scored += scores.size
        for r in np.flatnonzero((scores >= self.bar[rows][:, None]).any(axis=1)):
            item = rows[r]
            take = np.flatnonzero(scores[r] >= self.bar[item])
            kept = self.best[item]
            score = np.concatenate([kept[0], scores[r][take].astype(np.int64)])
            gone = np.concatenate([kept[1], null[a:b][take]])
            name = np.concatenate([kept[2], ids[a:b][take]])
            top = np.lexsort((name, gone, -score))[:self.k]
            self.best[item] = score[top], gone[top], name[top]
            if len(top) == self.k:
                self.bar[item] = score[top[-1]]

    def found(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(item, ids, which are null, scores) of every item with results."""
        for place, (score, gone, name) in zip(self.order, self.best):
            if len(score):
                yield int(place), name, gone, score


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` highest-scoring documents with a score above 0."""
    spark, id_type = docs.sparkSession, items.schema[item_id].dataType
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", id_type),
                           T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    found, before = spark.createDataFrame([], schema), 0
    for ids, terms, own in _blocks(items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))):
        counts = store(counted(texts, terms), "dual-tree-counts")
        found = found.union(_searched(counts, ids, own, before, k, _weights(counts, len(terms)), schema))
        before += len(ids)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("item_id", "rank", "doc_id", "score")


def _searched(counts: DataFrame, ids: list, own: list[np.ndarray], before: int, k: int, weights, schema) -> DataFrame:
    docs, length, w = weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        of = Search(own, w, docs, length, k)
        for batch in batches:
            for blob in batch.column(0):
                of.add(blob.as_py())
        for item, name, gone, score in of.found():
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(name), before + item)),
                pa.array([ids[item]] * len(name), to_arrow_type(schema["item_id"].dataType)),
                pa.array(name, pa.int64(), mask=gone), pa.array(score, pa.int64())], names=schema.names)

    return counts.select("blob").repartition(shuffle_parts(counts.sparkSession)).mapInArrow(run, schema)
