"""Suffix-array dedup: longest-previous-factor arrays over all texts, in parts.

Every byte that a ``LENGTH``-byte string covers is removed if that string also starts in a document of smaller id. So a
position matters only if its longest previous factor (the longest match with an earlier document) reaches LENGTH, and
only the order of suffixes among equals in their first LENGTH bytes matters. That order falls into parts:

1. Of the ``GRAM``-byte strings inside a LENGTH-byte window, the one of smallest hash (leftmost of equals) is the
   window's anchor. Equal windows have equal anchors at equal places. About one position in 14 is an anchor.
2. Anchor hashes are dealt over parts, shortened and packed; anchors whose hash is in one document only cannot have an
   earlier match and go no further.
3. For each other anchor the bytes of all windows that it anchors (a stretch) are dealt by its hash, once for all
   documents of a slice that have them. A part sorts the suffixes that
   start at these windows by their first LENGTH bytes, ties by document. In that order, the previous smaller document
   of a suffix that agrees with it in LENGTH bytes is where it is copied from: its LPF reaches LENGTH.
   Equal stretches of windows are sorted once, however many documents have them.
4. The windows found are joined to spans by document, and the bytes outside the spans are hashed.

Anchors and windows are found in slices of about a megabyte, so a text of any length is read whole in bounded memory.

Defined cases: a null text is empty; a null id comes after all ids; rows of one id do not remove each other's bytes;
texts shorter than LENGTH lose nothing; matches never cross texts. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, store
from .packed import pack, runs, slices, smallest, unpack
from .tokens import mix, powers, text_bytes, text_column

LENGTH = 50
GRAM = 24
PART_BYTES = 8 << 20  # text bytes for each part of the exchanges
WINDOWS = 500_000  # windows that a part sorts at once, more only if one anchor has more
_STRETCH = (1 << 20) - 2 * LENGTH
_LOW = np.uint64((1 << 20) - 1)
_NULL_ID = (1 << 63) - 1


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size``-byte string of the data."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return mix((total[size:] - total[:-size]) * down[:len(data) - size + 1])


def _window_minima(v: np.ndarray, width: int) -> np.ndarray:
    out, have = v, 1
    while 2 * have <= width:
        out = np.minimum(out[:len(out) - have], out[have:])
        have *= 2
    return np.minimum(out[:len(out) - (width - have)], out[width - have:]) if have < width else out


def anchors(data: np.ndarray, offsets: np.ndarray):
    """Anchor position, its hash, and first and last window of each run of windows with one anchor.

    Windows lie within rows; positions count from the start of the data.
    """
    out = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    starts = offsets[:-1]
    stops = np.maximum(starts, offsets[1:] - LENGTH + 1)  # after the last window of each row
    for a in range(0, max(0, len(data) - LENGTH + 1), _STRETCH):
        b = min(a + _STRETCH, len(data) - LENGTH + 1)
        raw = data[a:b + LENGTH - 1]
        h = gram_hashes(raw, GRAM)
        least = _window_minima((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), LENGTH - GRAM + 1)[:b - a]
        at = (least & _LOW).astype(np.int64)
        inside = np.zeros(b - a + 1, np.int64)
        lo, hi = np.clip(starts, a, b) - a, np.clip(stops, a, b) - a
        np.add.at(inside, lo, 1)
        np.add.at(inside, hi, -1)
        ok = np.cumsum(inside)[:-1] > 0
        window = np.flatnonzero(ok)
        if not len(window):
            continue
        p = at[window]
        new = np.r_[True, (p[1:] != p[:-1]) | (window[1:] != window[:-1] + 1)]
        # a new row begins a new run, even where windows of two rows are neighbours
        row_start = np.zeros(b - a, bool)
        row_start[(starts[(starts >= a) & (starts < b)] - a)] = True
        new |= row_start[window]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(window)] - 1
        out.append((p[first] + a, h[p[first]], window[first] + a, window[last] + a))
    return tuple(np.concatenate(x) for x in zip(*out))


def _sides(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Part of each hash, and 40 other bits of it."""
    return ((h & np.uint64(0xFFFFFF)) % np.uint64(parts)).astype(np.int64), h >> np.uint64(24)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.binary(),
                                                                            pa.binary()))],
                                      ["part", "slice", "ids", "blob"])


_DEALT = "part int, slice long, ids binary, blob binary"


def _identity(batch: pa.RecordBatch) -> bytes:
    """Ids and text hashes of a slice's rows."""
    return pack(id=text_column(batch, "id").to_numpy(), th=text_column(batch, "th").to_numpy())


def dealt_anchors(texts: DataFrame, parts: int) -> DataFrame:
    """Distinct anchor hashes of each document, packed by slice and part; part -1 has the slice's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                data, offsets = text_bytes(text_column(batch, "text"))
                _, h, first, _ = anchors(data, offsets)
                d = np.searchsorted(offsets, first, "right") - 1
                part, rest = _sides(h, parts)
                order = np.lexsort((d, rest, part))
                part, rest, d = part[order], rest[order], d[order]
                if len(part):
                    new = np.r_[True, (part[1:] != part[:-1]) | (rest[1:] != rest[:-1]) | (d[1:] != d[:-1])]
                    part, rest, d = part[new], rest[new], d[new]
                name = text_column(batch, "rid")[0].as_py()
                rows = [(-1, name, b"", _identity(batch))]
                for k, start, end in runs(part):
                    i = slice(start, end)
                    rows.append((k, name, b"", pack(dh=smallest(np.diff(rest[i], prepend=np.uint64(0))),
                                                    d=smallest(d[i]))))
                yield _rows(rows)

    return texts.mapInArrow(run, _DEALT)


def _spread(deals: DataFrame, parts: int) -> DataFrame:
    """Slices' own rows (part -1) over as many parts."""
    own = -1 - F.pmod(F.xxhash64("slice"), F.lit(parts)).cast("int")
    return deals.withColumn("part", F.when(F.col("part") < 0, own).otherwise(F.col("part")))


def hit_documents(deals: DataFrame, parts: int) -> DataFrame:
    """(id, th, hits): hashes (32 bits) of the anchors that a document shares with another."""
    def shared(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if int(key[0]) < 0:
            return pdf[["slice", "blob"]].assign(kind="rows")
        cols = [unpack(x) for x in pdf["blob"]]
        h = np.concatenate([np.cumsum(x["dh"].astype(np.uint64), dtype=np.uint64) for x in cols])
        d = np.concatenate([x["d"].astype(np.int64) for x in cols])
        order = np.argsort(h, kind="stable")  # a hash comes once for each document
        same = h[order][1:] == h[order][:-1]
        many = np.zeros(len(h), bool)
        many[order[1:]] |= same
        many[order[:-1]] |= same
        edges, rows = np.r_[0, np.cumsum([len(x["d"]) for x in cols])], []
        for k, name in enumerate(pdf["slice"]):
            i = edges[k] + np.flatnonzero(many[edges[k]:edges[k + 1]])
            if len(i):
                rows.append((name, pack(d=smallest(d[i]), h=h[i].astype(np.uint32))))
        return pd.DataFrame(rows, columns=["slice", "blob"]).assign(kind="hits")

    def gathered(pdf: pd.DataFrame) -> pd.DataFrame:
        hits = [unpack(x) for x in pdf.loc[pdf["kind"] == "hits", "blob"]]
        if not hits:
            return pd.DataFrame({"id": [], "th": [], "hits": []}, dtype=object)
        rows = unpack(pdf.loc[pdf["kind"] == "rows", "blob"].iloc[0])
        d = np.concatenate([x["d"].astype(np.int64) for x in hits])
        h = np.concatenate([x["h"] for x in hits])
        order = np.lexsort((h, d))
        d, h = d[order], h[order]
        docs = np.unique(d)
        edges = np.r_[np.searchsorted(d, docs), len(d)]
        return pd.DataFrame({"id": rows["id"][docs], "th": rows["th"][docs],
                             "hits": [h[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]})

    found = _spread(deals, parts).groupBy("part").applyInPandas(shared, "slice long, blob binary, kind string")
    return found.groupBy("slice").applyInPandas(gathered, "id long, th long, hits binary").dropDuplicates(["id", "th"])


def dealt_windows(joined: DataFrame, parts: int) -> DataFrame:
    """For each shared anchor of a document the bytes of its windows, packed by slice and part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                data, offsets = text_bytes(text_column(batch, "text"))
                p, h, first, last = anchors(data, offsets)
                d = np.searchsorted(offsets, first, "right") - 1
                part, rest = _sides(h, parts)
                hits = [np.frombuffer(x, np.uint32) for x in text_column(batch, "hits").to_pylist()]
                known = np.concatenate([np.uint64(k << 32) | x.astype(np.uint64) for k, x in enumerate(hits)])
                mine = d.astype(np.uint64) << np.uint64(32) | (rest & np.uint64(0xFFFFFFFF))
                at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                i = np.flatnonzero(known[at] == mine)
                p, first, last, d, part = p[i], first[i], last[i], d[i], part[i]
                size, off = last - first + LENGTH, p - first
                _, same = _stretch_hashes(data, first, size, off)
                i = np.lexsort((first, same, part))
                first, size, off, d, part, same = first[i], size[i], off[i], d[i], part[i], same[i]
                # a stretch that several documents of the slice have is sent once
                new = np.ones(len(part), bool)
                new[1:] = (part[1:] != part[:-1]) | (same[1:] != same[:-1])
                name, ids = text_column(batch, "rid")[0].as_py(), text_column(batch, "id").to_numpy()
                rows = [(-1, name, b"", _identity(batch))]
                sent = pack(id=ids)
                for k, start, end in runs(part):
                    j = slice(start, end)
                    lead = start + np.flatnonzero(new[j])
                    rows.append((k, name, sent, pack(
                        d=smallest(d[j]), at=smallest(first[j] - offsets[d[j]]), new=new[j].astype(np.uint8),
                        size=smallest(size[lead]), off=smallest(off[lead]),
                        text=data[_ranges(first[lead], size[lead])])))
                yield _rows(rows)

    return joined.mapInArrow(run, _DEALT)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of all ranges, one range after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - start, size)


def _stretch_hashes(text: np.ndarray, start: np.ndarray, size: np.ndarray, off: np.ndarray):
    """Hashes of each stretch's anchor, and of its bytes and anchor place. About a megabyte at a time."""
    gram, same = np.empty(len(start), np.uint64), np.empty(len(start), np.uint64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(start, start[a] + (1 << 20))))
        raw, at = text[start[a]:start[b - 1] + size[b - 1]], start[a:b] - start[a]
        up, down = powers(len(raw) + 1)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=total[1:])
        g = at + off[a:b]
        gram[a:b] = mix((total[g + GRAM] - total[g]) * down[g])
        same[a:b] = mix((total[at + size[a:b]] - total[at]) * down[at]) + mix((size[a:b] * 64 + off[a:b]).astype(np.uint64))
        a = b
    return gram, same


def previous_factors(text: np.ndarray, starts: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of each suffix whether its longest previous factor, in an earlier document, reaches LENGTH bytes.

    Suffixes are put in order of their first LENGTH bytes, ties by document. Among neighbours that agree in all of
    them the previous smaller document stands before, if there is one; the first of them is the smallest.
    """
    view = np.lib.stride_tricks.sliding_window_view(text, LENGTH)[starts]
    keys = np.ascontiguousarray(view).view(f"S{LENGTH}").ravel()
    by_doc = np.argsort(doc, kind="stable")
    order = by_doc[np.argsort(keys[by_doc], kind="stable")]  # the suffix array
    agree = np.r_[False, keys[order][1:] == keys[order][:-1]]  # LCP with the suffix before reaches LENGTH
    first = np.maximum.accumulate(np.where(agree, 0, np.arange(len(order))))
    out = np.zeros(len(order), bool)
    out[order] = doc[order[first]] < doc[order]
    return out


def copied_windows(deals: DataFrame, parts: int) -> DataFrame:
    """(slice, blob, kind): of each slice the spans of windows that an earlier document has."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if int(key[0]) < 0:
            return pdf[["slice", "blob"]].assign(kind="rows")
        cols = [unpack(x) for x in pdf["blob"]]
        ids = [unpack(x)["id"] for x in pdf["ids"]]
        n = [len(x["d"]) for x in cols]
        of = np.repeat(np.arange(len(cols)), n)
        d, at, size, off = (np.concatenate([x[c].astype(np.int64) for x in cols]) for c in ("d", "at", "size", "off"))
        doc = np.concatenate([i[x["d"].astype(np.int64)] for i, x in zip(ids, cols)])
        text = np.concatenate([x["text"] for x in cols])
        start = np.cumsum(size) - size
        # stretches: equal bytes and anchor place; each anchor's stretches are a group
        gram, same = _stretch_hashes(text, start, size, off)
        sent = np.cumsum(np.concatenate([x["new"] for x in cols]).astype(np.int64)) - 1  # which one a record has
        gram, same, start, size = gram[sent], same[sent], start[sent], size[sent]
        order = np.lexsort((doc, same, gram))
        g, s = gram[order], same[order]
        new = np.r_[True, (s[1:] != s[:-1]) | (g[1:] != g[:-1])]
        stretch = np.empty(len(order), np.int64)
        stretch[order] = np.cumsum(new) - 1
        lead = order[new]  # a record of each stretch, of its first document
        first_doc = doc[lead]  # of each stretch
        later = doc > first_doc[stretch]
        out = [(of[later], d[later], at[later], size[later])]
        # an anchor with several stretches: its windows may be in an earlier document's other stretch
        lg = g[new]
        mixed = np.zeros(len(lead), bool)
        mixed[1:] |= lg[1:] == lg[:-1]
        mixed[:-1] |= lg[1:] == lg[:-1]
        several = np.flatnonzero(mixed)  # by group
        count = size[lead[several]] - LENGTH + 1
        ends = np.flatnonzero(np.r_[lg[several][1:] != lg[several][:-1], True]) + 1 if len(several) else []
        # records of each stretch that are of its first document
        rec = np.flatnonzero(~later)
        rec = rec[np.argsort(stretch[rec], kind="stable")]
        total, begin = np.cumsum(count), 0
        for k, end in enumerate(ends):
            if k + 1 < len(ends) and total[ends[k + 1] - 1] - (total[begin - 1] if begin else 0) <= WINDOWS:
                continue
            some, n_windows = several[begin:end], count[begin:end]
            begin = end
            windows = _ranges(start[lead[some]], n_windows)
            owner = np.repeat(np.arange(len(some)), n_windows)
            copied = previous_factors(text, windows, first_doc[some][owner])
            inner = np.r_[False, copied[1:] & copied[:-1] & (owner[1:] == owner[:-1])]
            a = np.flatnonzero(copied & ~inner)
            b = np.flatnonzero(copied & ~np.r_[inner[1:], False])
            which = some[owner[a]]
            shift = windows[a] - start[lead[which]]
            lo, hi = np.searchsorted(stretch[rec], which, "left"), np.searchsorted(stretch[rec], which, "right")
            to = rec[_ranges(lo, hi - lo)]
            span = np.repeat(np.arange(len(a)), hi - lo)
            out.append((of[to], d[to], at[to] + shift[span], (b - a)[span] + LENGTH))
        of, d, at, size = (np.concatenate(x) for x in zip(*out))
        order = np.lexsort((at, d, of))
        of, d, at, size = of[order], d[order], at[order], size[order]
        edges = np.searchsorted(of, np.arange(len(cols) + 1))
        rows = [(name, pack(d=smallest(d[a:b]), at=smallest(at[a:b]), size=smallest(size[a:b])))
                for name, a, b in zip(pdf["slice"], edges[:-1], edges[1:]) if a < b]
        return pd.DataFrame(rows, columns=["slice", "blob"]).assign(kind="spans")

    return _spread(deals, parts).groupBy("part").applyInPandas(run, "slice long, blob binary, kind string")


def joined_spans(at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs that spans in order of start cover."""
    reach = np.maximum.accumulate(at + size)
    new = np.r_[True, at[1:] > reach[:-1]]
    first = np.flatnonzero(new)
    return at[first], reach[np.r_[first[1:], len(at)] - 1]


def document_spans(found: DataFrame) -> DataFrame:
    """(id, th, spans): starts and ends of the removed runs of each document that has any."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        spans = [unpack(x) for x in pdf.loc[pdf["kind"] == "spans", "blob"]]
        if not spans:
            return pd.DataFrame({"id": [], "th": [], "spans": []}, dtype=object)
        rows = unpack(pdf.loc[pdf["kind"] == "rows", "blob"].iloc[0])
        d, at, size = (np.concatenate([x[c].astype(np.int64) for x in spans]) for c in ("d", "at", "size"))
        order = np.lexsort((at, d))
        d, at, size = d[order], at[order], size[order]
        docs = np.unique(d)
        edges = np.r_[np.searchsorted(d, docs), len(d)]
        return pd.DataFrame({"id": rows["id"][docs], "th": rows["th"][docs], "spans": [
            np.concatenate(joined_spans(at[a:b], size[a:b])).tobytes() for a, b in zip(edges[:-1], edges[1:])]})

    return found.groupBy("slice").applyInPandas(run, "id long, th long, spans binary").dropDuplicates(["id", "th"])


def _with_rid(texts: DataFrame) -> DataFrame:
    """A slice is named by the id of its first row; the ids only need to differ within one scan."""
    return texts.withColumn("rid", F.monotonically_increasing_id())


def _hits(texts: DataFrame, parts: int) -> DataFrame:
    return store(hit_documents(dealt_anchors(_with_rid(texts), parts), parts), "suffix-hits")


def _spans(texts: DataFrame, hits: DataFrame, parts: int) -> DataFrame:
    joined = _with_rid(texts.hint("merge").join(hits, ["id", "th"]))
    return store(document_spans(copied_windows(dealt_windows(joined, parts), parts)), "suffix-spans")


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's id, text and removed runs (binary: starts, then ends, as 64-bit numbers; null: none)."""
    t = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("id"), t.alias("text"),
                        F.xxhash64(t).alias("th"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    hits = _hits(texts, parts)
    release(docs.sparkSession)
    spans = _spans(texts, hits, parts)
    release(docs.sparkSession)
    plain = docs.select(F.col(doc_id), F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("id"),
                        t.alias("text"), F.xxhash64(t).alias("th"))
    return plain.hint("merge").join(spans, ["id", "th"], "left").select(doc_id, "text", "spans")


def kept_parts(data: bytes, spans: bytes | None) -> tuple[int, int, list[bytes]]:
    """Removed bytes, removed runs, and what is left of a text's bytes."""
    if not spans:
        return 0, 0, [data]
    x = np.frombuffer(spans, np.int64)
    starts, ends = x[:len(x) // 2].tolist(), x[len(x) // 2:].tolist()
    kept = [data[a:b] for a, b in zip([0, *ends], [*starts, len(data)])]
    return sum(ends) - sum(starts), len(starts), kept


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Doc id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch, "text").cast(pa.binary()).to_pylist()
            rows = [(len(x), *kept_parts(x, s)) for x, s in zip(texts, text_column(batch, "spans").to_pylist())]
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [text_column(batch, doc_id), *[pa.array(c, pa.int64()) for c in cols[:3]],
                 pa.array([sha256(b"".join(k)).hexdigest() for k in cols[3]], pa.string())],
                [doc_id, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = docs.select(doc_id).withColumns({"n_bytes": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"),
                                              "n_spans": F.lit(0).cast("long"), "kept_sha256": F.lit("")}).schema
    return removed(docs, doc_id, text).mapInArrow(run, schema)
