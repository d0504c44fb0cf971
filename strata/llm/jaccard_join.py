"""N-gram Jaccard join by a count-vector R-tree.

A document's set holds its distinct word shingles. Two documents link when their sets' Jaccard similarity reaches the
threshold; linked documents form components. The result is exact (but for collisions of 64-bit hashes).

1. Documents with equal sets are one node, however many copies there are.
2. Shingles are hashed into groups; a set is a point of group counts. For a threshold t, two linked sets of at most M
   shingles differ in at most D = 2M(1-t)/(1+t) shingles. With more than D blocks of groups, some block is equal in
   both. Nodes of a size class are dealt by the content of each block; nodes that meet in a block are joined in a
   family. Blocks with few shingles meet by chance, so there are spare blocks: a node deals its poor blocks only if
   all blocks that it must have in common with a partner might be poor.
3. In a family, an R-tree over the count vectors finds partners: the overlap of two sets is at most the sum of their
   counts' minima, that of a set and any point in a box at most the sum with the box's upper corner. Survivors are
   verified on the sets, each pair once: two nodes lie in one family and one pair of tiles. Links are counted by node,
   weighted by copies, and those that connect what was not connected go on. Where only components are wanted, pairs
   that are already connected need no check.
   A family of more than ``TILE`` nodes is split by size into tiles, and each pair of tiles of near sizes is one task.
4. The links' components give every document the smallest id it is connected with.

``join`` gives every document its component and its number of links, ``node_links`` the links themselves as pairs of
nodes and the documents of each node. Copies are never paired, and the blocks' nodes are linked to the first of them, never each with each.

Defined cases: null and blank texts have an empty set, belong to no one and are their own component; a text of fewer
words than a shingle has one shingle, the whole sequence; repeated rows have equal sets and are connected; a null id
gets the smallest id of its component, null if there is none. Texts are read whole, in slices of about a megabyte; a very
long one is one set, eight bytes a shingle. ``join`` and ``node_links`` read the id and the text only and return their own
columns; ``one_of_each`` returns all columns as they came. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, shuffle_parts, store
from .components import components
from .tokens import combine, mix, text_column, word_hashes

SHINGLE = 3
PERCENT = 90
RATIO = 1.25  # size of a class's largest set over its smallest; thresholds of 80 % and more fit it
GROUPS = 64  # least and most groups of a count vector
MOST_GROUPS = 4096
LEAF = 16
TILE = 1024
BAND = 1.05


def shingle_sets(column: pa.Array, n: int = SHINGLE) -> Iterator[np.ndarray]:
    """Ascending distinct shingle hashes of each row."""
    h, upto = word_hashes(column)
    g = h
    for k in range(1, n):
        g = combine(g[:max(0, len(h) - k)], h[k:]) if len(h) > k else g[:0]
    for a, b in zip(upto[:-1].tolist(), upto[1:].tolist()):
        if b - a >= n:
            yield np.unique(g[a:b - n + 1])
        elif b > a:
            one = np.uint64(b - a)
            for x in h[a:b]:
                one = combine(np.array([one]), np.array([x]))[0]
            yield np.array([one], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def node_of(s: np.ndarray) -> int:
    """64-bit name of a set."""
    a, b = mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return int(combine(np.array([a]), np.array([b ^ np.uint64(len(s))])).view(np.int64)[0])


def class_of(size: int) -> int:
    return int(math.log(size) / math.log(RATIO) + 1e-9)


def most_different(a: int, b: int, percent: int) -> int:
    """Most shingles in which two linked sets of at most these sizes can differ."""
    return (a + b) * (100 - percent) // (100 + percent)


def class_blocks(c: int, percent: int) -> tuple[int, int]:
    """Blocks of a size class, and below how many shingles a block is poor. No blocks if only equal sets can link.

    The blocks beyond those that linked sets can differ in make up for the poor ones: more of them for lower
    thresholds, where blocks are smaller.
    """
    most = math.ceil(RATIO ** (c + 1) + 1e-6)  # one more than the largest set, for rounding
    differ = most_different(most, most, percent)
    if not differ:
        return 0, 0
    return (differ + 4 + differ // 6, 3) if percent >= 90 else (differ + 4 + differ // 2, 2)


def block_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """Keys under which a set is dealt: its class's blocks, and the next class's if sets of that can link."""
    size, out = len(s), [np.zeros(0, np.uint64)]
    c = class_of(size)
    following = 100 * (size + 1) >= percent * RATIO ** (c + 1)
    place, weight = mix(s ^ np.uint64(0x8CB92BA72F3D8DD7)), mix(s)
    largest = size * 100 // percent  # partner
    for k in (c, c + 1) if following else (c,):
        blocks, few = class_blocks(k, percent)
        if not blocks:
            continue
        at = (place % np.uint64(blocks)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        count = np.bincount(at, minlength=blocks)
        content = np.zeros(blocks, np.uint64)
        filled = np.flatnonzero(count)
        starts = np.cumsum(count) - count
        content[filled] = np.add.reduceat(weight[order], starts[filled])
        poor = count < few
        # a partner has at least this many blocks in common with the set; if more than are poor, one is not
        common = blocks - most_different(size, largest, percent)
        take = np.flatnonzero(~poor) if poor.sum() < common else np.arange(blocks)
        name = mix(np.uint64(k << 40) + take.astype(np.uint64) + np.uint64(1))
        out.append(combine(content[take], name ^ count[take].astype(np.uint64)))
    return np.concatenate(out)


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets are similar enough."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


class CountTree:
    """R-tree over count vectors, packed bottom-up in order of size; boxes keep their upper corners."""

    def __init__(self, points: np.ndarray, percent: int):
        self.percent = percent
        size = points.sum(1)
        self.order = np.lexsort((points[:, 0], size))
        points, size = points[self.order], size[self.order]
        self.levels = [(points, size, size)]
        while len(points) > LEAF:
            starts = np.arange(0, len(points), LEAF)
            points = np.maximum.reduceat(points, starts, axis=0)
            low, high = np.minimum.reduceat(self.levels[-1][1], starts), np.maximum.reduceat(self.levels[-1][2], starts)
            self.levels.append((points, low, high))

    def near(self, q: np.ndarray) -> np.ndarray:
        """Numbers of the points whose sets may be similar enough to the query's."""
        n, t = int(q.sum()), self.percent
        at = np.arange(len(self.levels[-1][0]))
        for depth, (upper, low, high) in enumerate(reversed(self.levels)):
            overlap = np.minimum(upper[at], q).sum(1)
            ok = ((100 + t) * overlap >= t * (n + low[at])) & (100 * n >= t * low[at]) & (100 * high[at] >= t * n)
            at = at[ok]
            if depth < len(self.levels) - 1:
                below = len(self.levels[-2 - depth][0])
                at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                at = at[at < below]
        return self.order[at]


def groups_for(largest: int) -> int:
    """Groups of the count vectors of sets up to this size: about four shingles a group, else boxes bound nothing."""
    return min(MOST_GROUPS, max(GROUPS, 1 << max(0, (largest // 4)).bit_length()))


def count_vector(s: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    at = mix(s ^ np.uint64(0xA0761D6478BD642F)) & np.uint64(groups - 1)
    return np.bincount(at.astype(np.int64), minlength=groups)


def family_links(nodes: list[int], sets: list[np.ndarray], copies: np.ndarray, left: np.ndarray, right: np.ndarray,
                 percent: int, want: str) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links between the left and the right members (both sides: any pair): with ``want`` "pairs" all of them, else
    enough to connect what is connected; and, unless only "components" are wanted, the links of each member with
    others, weighted by the others' copies."""
    size = np.array([len(s) for s in sets])
    groups = groups_for(int(size.max()))
    vectors = np.array([count_vector(s, groups) for s in sets], np.int32)
    tree_at = np.flatnonzero(right)
    tree = CountTree(vectors[tree_at], percent)
    label = np.arange(len(nodes))  # of what is connected
    weight = np.zeros(len(nodes), np.int64)
    out: list[tuple[int, int]] = []
    starts = np.cumsum(size) - size
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.zeros(len(names), bool)

    def connect(i: int, j: int) -> None:
        label[label == label[j]] = label[i]
        out.append((nodes[i], nodes[j]))

    for i in np.flatnonzero(left).tolist():
        near = tree_at[tree.near(vectors[i])]
        near = near[(near != i) & ~(left[near] & right[i] & (near < i))]
        if want == "components":
            for j in near[label[near] != label[i]].tolist():
                if label[j] != label[i] and links(sets[i], sets[j], percent):
                    connect(i, j)
            continue
        if not len(near):
            continue
        mine = flat[starts[i]:starts[i] + size[i]]
        own[mine] = True
        if 2 * len(near) > len(sets):
            common = np.add.reduceat(own[flat], starts, dtype=np.int64)[near]
        else:
            common = np.array([int(own[flat[starts[j]:starts[j] + size[j]]].sum()) for j in near.tolist()])
        own[mine] = False
        linked = near[100 * common >= percent * (size[i] + size[near] - common)]
        weight[i] += copies[linked].sum()
        weight[linked] += copies[i]
        if want == "pairs":
            out += [(nodes[i], nodes[j]) for j in linked.tolist()]
            continue
        while len(linked := linked[label[linked] != label[i]]):
            connect(i, int(linked[0]))
    return out, weight


def _ids(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))


def document_nodes(docs: DataFrame, n: int) -> DataFrame:
    """(id, n, node) of each row of (id, text)."""
    def run(batches):
        for batch in batches:
            found = [(len(s), node_of(s)) for s in shingle_sets(text_column(batch, "text"), n)]
            yield pa.RecordBatch.from_arrays(
                [text_column(batch, "id"), pa.array([x for x, _ in found], pa.int64()),
                 pa.array([x for _, x in found], pa.int64())], ["id", "n", "node"])

    schema = docs.select("id", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("node")).schema
    return docs.mapInArrow(run, schema)


def dealt_blocks(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(key, node) for every block under which a node is dealt; a task deals a node once."""
    def run(batches):
        done: set[int] = set()
        for batch in batches:
            keys, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for s in shingle_sets(text_column(batch, "text"), n):
                if len(s) and (node := node_of(s)) not in done:
                    done.add(node)
                    keys.append(block_keys(s, percent))
                    nodes.append(np.full(len(keys[-1]), node))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)),
                                              pa.array(np.concatenate(nodes))], ["key", "node"])

    return docs.select("text").mapInArrow(run, "key long, node long")


def met(dealt: DataFrame) -> DataFrame:
    """(a, b): the first node of each block with each other node there. Reads the blocks in order, a batch at a time."""
    def run(batches):
        last_key, first = None, None
        for batch in batches:
            key, node = (text_column(batch, c).to_numpy() for c in ("key", "node"))
            if not len(key):
                continue
            new = np.empty(len(key), bool)
            new[0], new[1:] = key[0] != last_key, key[1:] != key[:-1]
            at = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            firsts = np.where(at >= 0, node[at], first if first is not None else 0)
            last_key, first = key[-1], firsts[-1]
            differ = firsts != node
            pairs = np.unique(np.stack([firsts[differ], node[differ]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    parts = shuffle_parts(dealt.sparkSession)
    return dealt.repartition(parts, "key").sortWithinPartitions("key", "node").mapInArrow(run, "a long, b long")


def family_members(docs: DataFrame, chosen: DataFrame, n: int) -> DataFrame:
    """(family, node, size, shingles) of the chosen (id, node, family), from the texts."""
    def run(batches):
        for batch in batches:
            rows = []
            for s, node, family in zip(shingle_sets(text_column(batch, "text"), n),
                                       text_column(batch, "node").to_pylist(),
                                       text_column(batch, "family").to_pylist()):
                if node_of(s) == node:  # not another text under the same id
                    rows.append((family, node, len(s), s.tobytes()))
            cols = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                ["family", "node", "size", "shingles"])

    joined = docs.hint("merge").join(chosen.withColumnRenamed("id", "__id"), F.col("id").eqNullSafe(F.col("__id")))
    return joined.select("text", "node", "family").mapInArrow(
        run, "family long, node long, size long, shingles binary")


def verified(members: DataFrame, chosen: DataFrame, percent: int, tile: int, want: str) -> DataFrame:
    """(a, b, links): links a-b between members of a family, as ``family_links`` gives them, and, without b, numbers of
    links of nodes a; ``chosen`` has (node, family, n, copies) of all of them."""
    band = F.floor(F.log("n") / math.log(BAND)).cast("long")
    large = chosen.groupBy("family").agg(F.count("*").alias("m")).withColumn("split", F.col("m") > tile)
    banded = chosen.join(large, "family").withColumn("band", F.when(F.col("split"), band).otherwise(F.lit(0)))
    per_band = banded.groupBy("family", "band").agg(F.count("*").alias("m"), F.max("split").alias("split"))
    per_band = per_band.withColumn("tiles", F.when(F.col("split"), F.ceil(F.col("m") / tile)).otherwise(F.lit(1)))
    per_band = store(per_band.select("family", "band", F.col("tiles").cast("long").alias("tiles")), "jaccard-bands")
    tiles = per_band.select("family", "band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("sub"))
    # linked sizes differ by at most the threshold's ratio: so many bands
    reach = int(math.log(100 / percent) / math.log(BAND)) + 1
    other = tiles.select("family", F.col("band").alias("band2"), F.col("sub").alias("sub2"))
    near = tiles.withColumn("band2", F.explode(F.sequence(F.col("band"), F.col("band") + reach))) \
        .join(other, ["family", "band2"]) \
        .where((F.col("band2") > F.col("band")) | (F.col("sub2") >= F.col("sub")))
    pair = F.xxhash64("band", "sub", "band2", "sub2").alias("pair")
    same = (F.col("band") == F.col("band2")) & (F.col("sub") == F.col("sub2"))
    lefts = near.select("family", "band", "sub", pair, F.lit(True).alias("left"), same.alias("right"))
    rights = near.where(~same).select("family", F.col("band2").alias("band"), F.col("sub2").alias("sub"), pair,
                                      F.lit(False).alias("left"), F.lit(True).alias("right"))
    sides = lefts.unionByName(rights)
    placed = banded.select("node", "family", "band", "copies").join(per_band, ["family", "band"]) \
        .withColumn("sub", F.pmod(F.xxhash64("node"), F.col("tiles"))).drop("tiles") \
        .join(sides, ["family", "band", "sub"]).select("family", "node", "copies", "pair", "left", "right")

    def run(t: pa.Table) -> pa.Table:
        rows = t.sort_by("node").to_pydict()
        seen, keep = set(), []
        for i, node in enumerate(rows["node"]):
            if node not in seen:
                seen.add(node)
                keep.append(i)
        nodes = [rows["node"][i] for i in keep]
        pairs, weight = family_links(nodes, [np.frombuffer(rows["shingles"][i], np.uint64) for i in keep],
                                     *(np.array([rows[c][i] for i in keep]) for c in ("copies", "left", "right")),
                                     percent, want)
        of = np.flatnonzero(weight) if want == "counts" else []
        return pa.table({"a": pa.array([a for a, _ in pairs] + [nodes[i] for i in of], pa.int64()),
                         "b": pa.array([b for _, b in pairs] + [None] * len(of), pa.int64()),
                         "links": pa.array([None] * len(pairs) + [int(weight[i]) for i in of], pa.int64())})

    return members.hint("merge").join(placed, ["family", "node"]) \
        .select("family", "pair", "node", "copies", "left", "right", "shingles") \
        .groupBy("family", "pair").applyInArrow(run, "a long, b long, links long")


def _verified(docs: DataFrame, doc_id: str, text: str, n: int, percent: int, tile: int,
              want: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, n, node) of every row; (node, id, n, copies) with the smallest id; and what ``verified`` gives."""
    if not 100 <= percent * RATIO or percent > 100:
        raise ValueError("the threshold must be from 80 to 100 percent")
    rows = _ids(docs, doc_id, text)
    nodes = store(document_nodes(rows, n), "jaccard-nodes")
    families = store(components(met(dealt_blocks(rows, n, percent)), "a", "b", "jaccard-families"), "jaccard-families")
    release(docs.sparkSession)
    first = nodes.groupBy("node").agg(F.min("id").alias("id"), F.min("n").alias("n"), F.count("*").alias("copies"))
    chosen = store(first.join(families, "node").select("id", "node", F.col("root").alias("family"), "n", "copies"),
                   "jaccard-chosen")
    members = family_members(rows, chosen.select("id", "node", "family"), n)
    return nodes, first, verified(members, chosen.select("node", "family", "n", "copies"), percent, tile, want)


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = SHINGLE, percent: int = PERCENT,
         tile: int = TILE, count: bool = True) -> DataFrame:
    """Doc id, n_shingles, component_id and n_links of every row: the number of other rows whose sets are similar enough,
    copies included. Without ``count`` no n_links, and no check of pairs that are already connected."""
    nodes, first, found = _verified(docs, doc_id, text, n, percent, tile, "counts" if count else "components")
    if count:
        found = store(found, "jaccard-found")
    linked = components(found.where("b is not null").select("a", "b"), "a", "b", "jaccard-links")
    rooted = first.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component"))
    by_node = rooted.join(least, "root").select("node", "component", "copies")
    if count:
        others = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("others"))
        by_node = by_node.join(others, "node", "left") \
            .select("node", "component", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"))
    by_node = store(by_node.drop("copies"), "jaccard-components")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component"))
    more = [F.when(F.col("n") == 0, F.lit(0).cast("long")).otherwise(F.col("links")).alias("n_links")] if count else []
    return nodes.join(by_node, "node").select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
                                              component.alias("component_id"), *more)


def node_links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = SHINGLE, percent: int = PERCENT,
               tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """All links (a, b) between nodes of different sets, each once with a < b, and the node of every row: doc id,
    n_shingles, node. Rows of one node have equal sets and link, but for empty ones."""
    nodes, _, found = _verified(docs, doc_id, text, n, percent, tile, "pairs")
    pairs = store(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "jaccard-pairs")
    return pairs, nodes.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), "node")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = SHINGLE,
                percent: int = PERCENT) -> DataFrame:
    """The documents without near duplicates: of each component the one of smallest id stays, equal rows once.

    Empty texts belong to no one and stay. Rows of one id with different texts are one document's and stay together.
    """
    of = join(docs, doc_id, text, n, percent, count=False).where(F.col(doc_id).eqNullSafe(F.col("component_id")))
    rows = store(of.groupBy(F.col(doc_id).alias("__id")).agg(F.count("*").alias("__n")), "jaccard-kept")
    kept = docs.hint("merge").join(rows.select("__id"), F.col(doc_id).eqNullSafe(F.col("__id")), "left_semi")
    if rows.where("__n > 1").isEmpty():
        return kept
    return kept.withColumn("__text", F.xxhash64(text)).dropDuplicates([doc_id, "__text"]).drop("__text")
