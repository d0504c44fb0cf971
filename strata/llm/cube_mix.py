"""Mixing sources to target weights: cube-method balanced sampling.

Every source gets a target amount of words. A document's expected number of copies is its source's target over its
source's size, at most ``cap``. The whole part is taken outright. The fractional part is an inclusion probability,
which the cube method rounds to 0 or 1: the flight phase walks the probabilities through the null space of two
balancing constraints (documents and words of the source), fixing at least one document a step, until at most two
stay fractional; the landing phase settles those so that the words come nearest to the target.

Spark deals a source's documents into blocks by hash. Each block flies on its own and passes on at most two fractional
documents; these are dealt again, a few thousand to a block, until one block a source is left, where it lands. So a
source with a third of all rows is many tasks, and a level passes on two rows for each ``block`` rows.

Defined cases: a null text has size 0 and is taken 0 times its size; a null source is a source of its own; repeated
rows are rows of their own, numbered among their equals and dealt over all blocks like others, however many they are;
rows that tie in order are equal in all that decides, so reruns return the same rows. No rows give no rows. Ids keep
their type and value. Extra columns do not enter.

All sources (one row each) are ordered in one task to deal weights in turn; they are assumed to be few.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import store, words

BLOCK = 4096
_EPS = 1e-9


def fly(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Flight phase: rounds probabilities along directions that keep sum(p) and sum(p * size).

    Takes three fractional documents at a time; their two constraints leave one direction. Stops with at most two
    fractional documents.
    """
    x = p.copy()
    todo = [int(i) for i in np.flatnonzero((x > _EPS) & (x < 1 - _EPS))]
    todo.reverse()
    while len(todo) >= 3:
        a, b, c = todo[-1], todo[-2], todo[-3]
        u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])  # kernel of [[1, 1, 1], [sa, sb, sc]]
        if u == (0, 0, 0):
            u = (1.0, -1.0, 0.0)
        step = np.inf
        for i, d in zip((a, b, c), u):
            if d > 0:
                step = min(step, (1 - x[i]) / d)
            elif d < 0:
                step = min(step, x[i] / -d)
        for i, d in zip((a, b, c), u):
            x[i] += step * d
        left = [i for i in (c, b, a) if _EPS < x[i] < 1 - _EPS]
        del todo[-3:]
        todo += left
    for i in np.flatnonzero((x <= _EPS) | (x >= 1 - _EPS)):
        x[i] = round(x[i])
    return x


def land(x: np.ndarray, size: np.ndarray, drift: float = 0.0) -> np.ndarray:
    """Landing phase: settles the last fractional documents so that the words come nearest to their expectation.

    ``drift`` is what earlier choices took beyond expectation. Ties go to fewer documents, then the earlier.
    """
    open_ = np.flatnonzero((x > 0) & (x < 1))
    best, choice = None, 0
    for bits in range(1 << len(open_)):
        take = np.array([(bits >> k) & 1 for k in range(len(open_))], float)
        off = abs(drift + float(((take - x[open_]) * size[open_]).sum()))
        if best is None or off < best - _EPS:
            best, choice = off, bits
    y = x.copy()
    for k, i in enumerate(open_):
        y[i] = (choice >> k) & 1
    return y


def _block(rows: pa.Table) -> pa.Table:
    """Rounds the ``__p`` of a block's documents; all other columns stay as they came."""
    order, p, size = (rows.column(c).to_numpy() for c in ("__order", "__p", "size"))
    by = np.lexsort((size, rows.column("__tie").to_numpy(), order))
    size = size[by].astype(float)
    x = fly(p[by].astype(float), size)
    if rows.column("__last")[0].as_py():
        x = land(x, size)
    rounded = np.empty(len(x))
    rounded[by] = x
    return rows.set_column(rows.schema.get_field_index("__p"), "__p", pa.array(rounded))


def targets(sources: DataFrame, cap: float) -> DataFrame:
    """Adds ``target`` to rows of (source_size, weight).

    Weights share all sizes; a target above ``cap`` sizes stops there and its excess is shared again by weight.
    A round settles at least one more source, and seldom more than a few are needed.
    """
    held = F.col("source_size") * F.lit(float(cap))
    total = sources.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    rate, capped = 0.0, -1
    while True:
        full = held <= F.lit(rate) * F.col("weight")
        if capped < 0:
            full = F.lit(False)
        r = sources.agg(
            F.coalesce(F.sum(F.when(full, held)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count_if(full).alias("n")).first()
        if r["n"] == capped or not r["weight"]:
            break
        capped, rate = r["n"], (total - r["held"]) / r["weight"]
    if not r["weight"]:
        return sources.withColumn("target", held.cast("double"))
    return sources.withColumn("target", F.least(held, F.lit(rate) * F.col("weight")).cast("double"))


_RUN = 1 << 16


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``__copy``, the number of a row among the rows equal to it: counted, and dealt out again."""
    n = F.col("__n")
    runs = rows.groupBy(*rows.columns).agg(F.count("*").alias("__n")) \
        .withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / _RUN))))
    first = F.col("__run") * _RUN
    return runs.withColumn("__copy", F.explode(F.sequence(first, F.least(first + (_RUN - 1), n - 1)))) \
        .drop("__n", "__run")


def mix(docs: DataFrame, weights: DataFrame, doc_id: str = "doc_id", source: str = "source",
        size: Column | None = None, cap: float = 3.0, block: int = BLOCK) -> DataFrame:
    """``copies`` of every document, by targets in words.

    ``weights`` has (source, weight), one row a source (null for the null source); ``size`` defaults to the words of
    ``text``. Returns doc id, source, size, source_size, target, copies, taken.
    """
    n = F.size(words(F.col("text"))) if size is None else size
    sizes = docs.select(F.col(doc_id).alias("__id"), F.col(source).alias("__source"), n.cast("long").alias("size"))
    rows = store(numbered(sizes), "mix-sizes")
    per = rows.groupBy("__source").agg(F.sum("size").alias("source_size"))
    w = weights.select(F.col("source").alias("__w"), F.col("weight").cast("double").alias("weight"))
    per = store(targets(store(per.join(w, F.col("__source").eqNullSafe(F.col("__w"))).drop("__w"), "mix-sources"), cap)
                .select(F.col("__source").alias("__s"), "source_size", "target"), "mix-targets")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    state = rows.join(per, F.col("__source").eqNullSafe(F.col("__s"))).drop("__s").withColumns({
        "__whole": F.floor(share + _EPS),
        "__order": F.xxhash64("__id", "size", "__copy"),
        "__tie": F.hash("__copy", "__id"),
    }).withColumn("__p", F.greatest(F.lit(0.0), share - F.col("__whole")))
    done, level = [], 0
    while True:
        # blocks a source: a count by source, so that each holds about `block` documents
        n_blocks = state.groupBy("__source").agg(F.ceil(F.count("*") / block).cast("long").alias("__n"))
        n_blocks = n_blocks.withColumnRenamed("__source", "__s")
        dealt = state.join(n_blocks, F.col("__source").eqNullSafe(F.col("__s"))).drop("__s").withColumns({
            "__block": F.pmod(F.xxhash64("__order", F.lit(level)), F.col("__n")),
            "__last": F.col("__n") == 1,
        }).drop("__n")
        flown = store(dealt.groupBy("__source", "__block").applyInArrow(_block, dealt.schema)
                      .drop("__block", "__last"), f"mix-flight-{level}")
        open_ = (F.col("__p") > 0) & (F.col("__p") < 1)
        done.append(flown.where(~open_))
        state, level = flown.where(open_), level + 1
        if state.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    copies = F.col("__whole") + F.round("__p").cast("long")
    return out.select(F.col("__id").alias(doc_id), F.col("__source").alias(source), "size", "source_size", "target",
                      copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def ranked_weights(docs: DataFrame, source: str = "source", weights: Iterable[float] = (5, 2, 1)) -> DataFrame:
    """Weights dealt in turn to the sources by code point, null last. One row a source."""
    cycle = F.array(*[F.lit(float(x)) for x in weights])
    names = docs.select(F.col(source).alias("source")).distinct()
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    return names.select("source", cycle[F.pmod(rank - 1, F.size(cycle))].alias("weight"))


def take(docs: DataFrame, weights: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
         cap: float = 3.0) -> DataFrame:
    """The mix itself: each document as often as it is taken. Equal rows share what all of them are given."""
    keyed = docs.withColumn("__key", F.xxhash64(doc_id, source, text))
    size = F.size(words(F.col(text)))
    given = mix(keyed, weights, "__key", source, size, cap).groupBy("__key") \
        .agg(F.sum("copies").alias("__copies"), F.count("*").alias("__n"))
    given = store(given, "mix-copies")
    if not given.where("__n > 1").isEmpty():
        keyed = keyed.dropDuplicates(["__key"])
    taken = keyed.hint("merge").join(given.where("__copies > 0").select("__key", "__copies"), "__key")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))) \
        .select(*docs.columns)
