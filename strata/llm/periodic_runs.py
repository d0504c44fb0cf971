"""Periodic run detection: maximal stretches of words that repeat with a smallest period, and texts without the repeats.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and length of at least
``max(MIN_LENGTH, 3 * q)`` that no neighbouring word extends keeping period q. Each text is searched on its own:

1. Grid. For each period p, the points 0, g, 2g, ... with g = max(p, BLOCK) are compared with the words p further on.
   The words of a run that equal those p later are at least 2p - 1 and 15, so one grid point of each run has its next
   BLOCK words equal; only such points go on. Over all periods these are n/1 + n/2 + ... points.
2. Longest common extensions. ``Extensions`` sorts only the suffixes that start at a difference cover (4 of 13
   positions), by blocks of 13 words and then by doubling ranks. Two positions compare at most 12 words until both are
   covered, then a sparse table over the sampled suffixes' common prefixes answers. One is built forwards, one backwards.
3. Each surviving point is extended both ways to its maximal stretch. A stretch found with several periods has the
   smallest of them.

Numpy does this for all texts of a slice (``SLICE`` bytes, one text at least) at once, with separators that equal
nothing; a text is never cut, so memory is some 30 times the bytes of the slice or the longest text. Words are compared
by 64-bit hash.

Defined cases: a null text has no words, no runs and an empty ``collapsed``; so have empty and blank texts. Ids are not
read; equal texts and repeated rows get equal results. Empty tables give empty results. Other columns pass through
unchanged; columns named like the two results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let, words
from .packed import slices
from .tokens import text_column, word_hashes

MIN_LENGTH = 24
MIN_PERIODS = 3
BLOCK = 8  # words that a grid point must share with those a period later
SLICE = 4 << 20
_PAIRS = 1 << 20  # pairs of positions handled at once

# {0, 1, 3, 9} has every difference modulo 13.
COVER, IN_COVER = 13, np.array([0, 1, 3, 9])
_SLOT = np.full(COVER, -1)
_SLOT[IN_COVER] = np.arange(len(IN_COVER))
_SHIFT = np.array([[next(d for d in range(COVER) if _SLOT[(i + d) % COVER] >= 0 and _SLOT[(j + d) % COVER] >= 0)
                    for j in range(COVER)] for i in range(COVER)])

RUN = T.StructType([T.StructField(x, T.LongType(), False) for x in ("start", "length", "period")])
_ARROW_RUN = pa.struct([pa.field(x, pa.int64(), False) for x in ("start", "length", "period")])


class Extensions:
    """Longest common extensions of positions of one sequence of numbers (0 or more)."""

    def __init__(self, w: np.ndarray):
        top = int(w.max()) + 1 if len(w) else 0
        # ends that equal nothing: no extension passes them
        self.w = np.concatenate([w, top + np.arange(2 * COVER)]).astype(np.int64)
        whole = (len(w) + COVER) // COVER + 1
        at = (np.arange(whole)[:, None] * COVER + IN_COVER).ravel()
        at = at[at < len(w) + COVER]
        levels = self._ranks(at)
        order = np.argsort(levels[-1], kind="stable")
        self.rank = levels[-1]
        self._table(self._common(at, order, levels))

    def _ranks(self, at: np.ndarray) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first 13, 26, 52, ... words, until all differ."""
        bits = int(self.w.max()).bit_length()
        per = max(1, 63 // max(1, bits))
        keys = []
        for a in range(0, COVER, per):
            key = np.zeros(len(at), np.int64)
            for k in range(a, min(a + per, COVER)):
                key = (key << bits) | self.w[at + k]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(at), bool)
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        levels, step = [self._numbered(order, new)], len(IN_COVER)
        while levels[-1].max(initial=0) + 1 < len(at):
            rank = levels[-1]
            later = np.zeros(len(at), np.int64)
            later[:len(at) - step] = rank[step:] + 1
            key = rank * (len(at) + 1) + later
            order = np.argsort(key, kind="stable")
            new = np.zeros(len(at), bool)
            new[1:] = key[order][1:] != key[order][:-1]
            levels.append(self._numbered(order, new))
            step *= 2
        return levels

    @staticmethod
    def _numbered(order: np.ndarray, new: np.ndarray) -> np.ndarray:
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _common(self, at: np.ndarray, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each sampled suffix and the next one in order."""
        a, b = order[:-1].copy(), order[1:].copy()
        for k in range(len(levels) - 2, -1, -1):
            same = levels[k][a] == levels[k][b]
            a[same] += len(IN_COVER) << k
            b[same] += len(IN_COVER) << k
        first = at[a] - at[order[:-1]]
        return first + self._words(at[a], at[b], np.full(len(a), COVER))

    def _words(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, at most ``most``, compared one by one."""
        out, left = np.zeros(len(i), np.int64), np.arange(len(i))
        for t in range(int(most.max(initial=0))):
            left = left[most[left] > t]
            left = left[self.w[i[left] + t] == self.w[j[left] + t]]
            if not len(left):
                break
            out[left] = t + 1
        return out

    def _table(self, common: np.ndarray) -> None:
        self.table, width = [common], 1
        while 2 * width <= len(common):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i on and from j on, for unlike i and j."""
        shift = _SHIFT[i % COVER, j % COVER]
        out = self._words(i, j, shift)
        on = np.flatnonzero(out == shift)
        a, b = i[on] + shift[on], j[on] + shift[on]
        a = self.rank[a // COVER * len(IN_COVER) + _SLOT[a % COVER]]
        b = self.rank[b // COVER * len(IN_COVER) + _SLOT[b % COVER]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(float))[1] - 1
        for k in np.unique(level):
            x = np.flatnonzero(level == k)
            t = self.table[k]
            out[on[x]] += np.minimum(t[low[x]], t[high[x] - (1 << int(k))])
        return out


def grid_points(w: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) of the grid points whose BLOCK words equal those a period later, in the same text."""
    n = np.diff(starts)
    periods = np.where(n >= MIN_LENGTH, n // MIN_PERIODS, 0)
    text = np.repeat(np.arange(len(n)), periods)
    p = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(p, BLOCK)
    points = np.maximum((n[text] - p - BLOCK) // step + 1, 0)
    total, found, a = np.cumsum(points), [], 0
    while a < len(p):
        done = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, done + _PAIRS, "right")))
        k = points[a:b]
        row = np.repeat(np.arange(a, b), k)
        at = starts[text[row]] + (np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)) * step[row]
        gap = p[row]
        for t in range(BLOCK):
            same = w[at + t] == w[at + gap + t]
            at, gap = at[same], gap[same]
        found.append((at, gap))
        a = b
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


def runs_of(w: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start in the text, length, period) of every run, by text, start, period.

    ``w`` has the numbers of all texts' words, ``starts`` where each text starts, and the end.
    """
    at, p = grid_points(w, starts)
    none = np.zeros(0, np.int64)
    if not len(at):
        return none, none, none, none
    # only texts with a surviving point are sorted, with a separator of their own after each
    own = np.searchsorted(starts, at, "right") - 1
    texts = np.unique(own)
    size = np.diff(starts)[texts]
    new_start = np.r_[0, np.cumsum(size + 1)]
    joined = np.empty(new_start[-1], np.int64)
    inside = np.ones(len(joined), bool)
    inside[new_start[1:] - 1] = False
    joined[inside] = w[np.arange(size.sum()) + np.repeat(starts[texts] - (np.cumsum(size) - size), size)]
    _, joined[inside] = np.unique(joined[inside], return_inverse=True)
    joined[~inside] = joined[inside].max() + 1 + np.arange(len(texts))
    at = at + (new_start[:-1] - starts[texts])[np.searchsorted(texts, own)]
    forwards, backwards = Extensions(joined), Extensions(joined[::-1])
    found, last = [], len(joined) - 1
    for a in range(0, len(at), _PAIRS):
        i, q = at[a:a + _PAIRS], p[a:a + _PAIRS]
        ahead = forwards(i, i + q)
        # from the word before i backwards; before the first word lies an end of the mirrored sequence
        back = backwards(last - i + 1, last - i - q + 1)
        first, length = i - back, back + q + ahead
        keep = length >= np.maximum(MIN_LENGTH, MIN_PERIODS * q)
        found.append(_smallest_period(first[keep], length[keep], q[keep]))
    first, length, q = _smallest_period(*(np.concatenate(x) for x in zip(*found)))
    text = np.searchsorted(new_start, first, "right") - 1
    return texts[text], first - new_start[text], length, q


def _smallest_period(first: np.ndarray, length: np.ndarray, p: np.ndarray):
    order = np.lexsort((p, length, first))
    first, length, p = first[order], length[order], p[order]
    new = np.r_[True, (first[1:] != first[:-1]) | (length[1:] != length[:-1])][:len(first)]
    first, length, p = first[new], length[new], p[new]
    order = np.lexsort((p, first))
    return first[order], length[order], p[order]


def find(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """Adds ``runs`` (start, length, period of each, by start and period, words counted from 0) and ``collapsed``.

    ``collapsed`` has the text's words joined by one blank, without those that a run holds after its first period.
    """
    kept = [c for c in docs.columns if c not in (runs, collapsed) or c == text]
    if {runs, collapsed} & {text}:
        raise ValueError("the results need names other than the text's")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, SLICE):
                column = text_column(batch, text)
                hashes, starts = word_hashes(column, lower=False)
                _, w = np.unique(hashes, return_inverse=True)
                own, first, length, period = runs_of(w, starts)
                edges = np.searchsorted(own, np.arange(batch.num_rows + 1))
                short = []
                for k, value in enumerate(column):
                    tokens = (value.as_py() or "").encode().split()  # by the same six spaces
                    a, b = edges[k], edges[k + 1]
                    if a < b:
                        change = np.zeros(len(tokens) + 1, np.int64)
                        np.add.at(change, first[a:b] + period[a:b], 1)
                        np.add.at(change, first[a:b] + length[a:b], -1)
                        tokens = [tokens[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
                    short.append(b" ".join(tokens).decode())
                values = pa.StructArray.from_arrays([pa.array(x) for x in (first, length, period)],
                                                    fields=list(_ARROW_RUN))
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [text_column(batch, c) for c in kept] + [lists, pa.array(short, pa.string())],
                    names=[*kept, runs, collapsed])

    schema = T.StructType([docs.schema[c] for c in kept] + [
        T.StructField(runs, T.ArrayType(RUN, False), False), T.StructField(collapsed, T.StringType(), False)])
    return docs.select(*kept).mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run of greatest exact length / period, of equals the first by start and period; null without runs."""
    def better(best: Column, x: Column) -> Column:
        return F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def with_planted_repeats(text: Column, doc_id: Column) -> Column:
    """The text of a tenth of all ids with its end replaced by repeats of a stretch of its own words.

    With h the id's crc32: for h % 10 = 0, each word i >= a becomes word a + (i - a) % p, a = (h / 10) % n,
    p = 1 + (n - a) / (3 + (h / 10) % 8), of n words. Other texts, and those without words, stay as they are.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def changed(w: Column) -> Column:
        n = F.size(w).cast("long")
        return let(F.struct((g % n).alias("a"), n.alias("n")), lambda x: let(
            F.lit(1) + F.floor((x["n"] - x["a"]) / (F.lit(3) + g % 8)),
            lambda p: F.array_join(F.transform(w, lambda v, i: F.when(i < x["a"], v).otherwise(
                F.get(w, (x["a"] + (i - x["a"]) % p).cast("int")))), " ")))

    planted = let(words(text), lambda w: F.when(F.size(w) > 0, changed(w)).otherwise(text))
    return F.when(h % 10 == 0, planted).otherwise(text)
