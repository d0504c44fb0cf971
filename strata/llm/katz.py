"""LM scoring by Katz backoff.

Bigram model over lower-cased words with one end token a text. P(w|h) is the Good-Turing discounted share of w after h
where the pair was met in training, else a(h) P(w); P(w) in turn is the discounted share of w, or the mass left for
unknown words. a(h) is normalised exactly: the mass that discounting leaves after h, over the P mass of what was not
met after h.

Every pair of words is counted, at any number of distinct words. The ``table`` most frequent words (a bounded table,
broadcast) are only a shortcut: their pairs travel by number, those of open words (all others) by hash. On request
(``vocabulary``) the model is closed instead: words outside the table share one class, and a word of that class costs
P(w | class) more, from the exact counts of all words. Either way probabilities add up to one over all words, and no
word is dropped. A sliver of mass (``RESERVED``) belongs to a word that never comes, so that a history met with every
word still leaves some.

Work: one pass counts words. A second counts the pairs of the ``DENSE`` most frequent classes, a table of fixed size
that is broadcast: a pair that very many texts have is one of these, so no part ever gathers such a pair. A third pass
scores these pairs where they are read and deals the others by (history, word), as packed number columns; hot
histories are split over several parts by the following word. A pair with an open word is dealt by that word's hash,
a pair of two open words by both: the follower's part has all tokens of the follower and so knows P(w), the history's
part has all that follows the history; both know the pair's count, and the logarithm of a score is a sum of what
each of them knows. An open history's total is its count as a word, so it goes with the history's own token. Each part
counts its pairs, and answers each dealing batch with those counts by document: small whole numbers, a byte or two a
token at any number of parts, of which the last pass takes the logarithms. What the table alone tells of a token is
summed by document where the token is read. History totals of table
words are added up in tasks and by history; the driver gets one row a table word. The backoff weight of an open history also needs
the P mass of its open followers: their parts send it by history hash, and a pass between joins it to the tokens that
wait for the weight. The last pass adds up the answers batch by batch. An open word has at most about one in ``table``
of all tokens, so no part gathers a hot one. Word counts, pair counts of table words and answers are Parquet tables in
the shared folder.

Defined cases: a null text is empty and has the end token only; a null id is not held out; repeated rows are texts of
their own; without training texts every token is unknown and all scores are 0. Classes of equal count are told apart by hash,
and a class count that does not fit the table stays open whole, so ties change no score. Texts are read whole, however
long. Empty tables give empty results. Only the named columns are read; the result has the id and its own columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, store
from .packed import pack, runs, slices, smallest, unpack
from .tokens import mix, rows_of, text_column, word_hashes

VOCABULARY = 1 << 16  # words in the table
DENSE = 1 << 10  # classes whose pairs are counted in one table
TOP = 5  # counts up to this are discounted by Good-Turing
BIG = 0.999  # discount of larger counts: just below one, so every history leaves mass
RESERVED = 1e-9
END = np.uint64(0xE1D0E1D0E1D0E1D0)
PART_TOKENS = 2_000_000
SLICE_BYTES = 8 << 20  # text bytes a task handles at once
_OCTAVE = 64


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(False))


def discounts(of_count: list[float]) -> list[float]:
    """Good-Turing discount of counts 1..TOP, from the numbers of types met 1..TOP+1 times.

    Where the numbers do not give one between 0 and 1 (small or odd corpora), a count loses one half.
    """
    n = [0.0, *of_count]
    tail = (TOP + 1) * n[TOP + 1] / n[1] if n[1] else 1.0
    out = []
    for r in range(1, TOP + 1):
        d = -1.0
        if n[r] and tail < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail)
        out.append(d if 0 < d < 1 else (r - 0.5) / r)
    return out


class Words(NamedTuple):
    """What tasks need of the word counts."""
    total: int  # training tokens
    types: int  # distinct ones
    hashes: np.ndarray  # of the vocabulary, ascending
    class_of: np.ndarray  # class of each, frequent ones first; after the last: other words, the start
    counts: np.ndarray  # training tokens of each class, and of other words; last, training texts
    unigram: np.ndarray  # P of each class and of other words
    discount: list[float]
    unknown: float  # P of unknown words
    parts: int
    rare_parts: int
    splits: np.ndarray  # parts of each history
    dense: np.ndarray  # training count of each pair of dense classes: history by word
    closed: bool  # other words are one class; else each is a word of its own

    @property
    def dense_of(self) -> np.ndarray:
        """Dense number of each class, other words and the start after the frequent ones; -1 for all between, and for
        other words of an open model."""
        n, d = len(self.hashes), self.dense.shape[1] - 1
        out = np.full(n + 2, -1, np.int32)
        out[:d] = np.arange(d)
        out[n], out[n + 1] = d if self.closed else -1, d + 1
        return out

    def discounted(self, c: np.ndarray) -> np.ndarray:
        d = np.array([0.0, *self.discount, BIG])[np.minimum(c, TOP + 1)]
        return (1 - RESERVED) * d * c / max(1, self.total)


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end token after each text, and tokens up to each row."""
    words, upto = word_hashes(column)
    n = len(upto) - 1
    out = np.empty(len(words) + n, np.uint64)
    ends = upto[1:] + np.arange(n)
    is_word = np.ones(len(out), bool)
    is_word[ends] = False
    out[is_word], out[ends] = words, END
    return out, upto + np.arange(n + 1)


def count_words(texts: DataFrame) -> DataFrame:
    """(w, n): training count of every word hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        held = 0

        def merged():
            w, at = np.unique(np.concatenate(words), return_inverse=True)
            return [w], [np.bincount(at, np.concatenate(counts), minlength=len(w)).astype(np.int64)]

        for batch in batches:
            batch = batch.filter(pa.compute.invert(text_column(batch, "held")))
            for part in slices(batch, "text", SLICE_BYTES):
                w, n = np.unique(_tokens(text_column(part, "text"))[0], return_counts=True)
                words.append(w)
                counts.append(n)
                held += len(w)
                if held > 4_000_000:
                    words, counts = merged()
                    held = 0
        words, counts = merged()
        yield pa.RecordBatch.from_arrays([pa.array(words[0].view(np.int64)), pa.array(counts[0])], ["w", "n"])

    return texts.select("text", "held").mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def word_model(words: DataFrame, texts: int, vocabulary: int, tokens: int | None = None, closed: bool = True) -> Words:
    """Classes and discounts from the word counts; collects at most ``vocabulary`` words."""
    c = F.col("n")
    r = words.agg(F.sum(c).alias("total"), F.count("*").alias("types"),
                  *[F.count_if(c == k).alias(f"n{k}") for k in range(1, TOP + 2)]).first()
    total, types = r["total"] or 0, r["types"]
    octave = F.floor(F.log2(c.cast("double")) * _OCTAVE).cast("int")
    taken, least = 0, None
    for row in words.groupBy(octave.alias("o")).agg(F.count("*").alias("n")).orderBy(F.desc("o")).collect():
        if taken + row["n"] > vocabulary:
            break
        taken, least = taken + row["n"], row["o"]
    top = [] if least is None else words.where(octave >= least).collect()
    hashes = np.array([x["w"] for x in top], np.int64).view(np.uint64)
    counts = np.array([x["n"] for x in top], np.int64)
    if END not in hashes:
        hashes, counts = np.append(hashes, END), np.append(counts, 0 if not total else texts)
    total_known = int(counts.sum())
    rank = np.lexsort((hashes, -counts))
    hashes, counts = hashes[rank], counts[rank]
    order = np.argsort(hashes)
    discount = discounts([float(r[f"n{k}"]) for k in range(1, TOP + 2)])
    d = min(DENSE, len(counts))
    model = Words(total, types, hashes[order], order.astype(np.int32), counts, np.zeros(0), discount, 1.0, 1, 1,
                  np.zeros(0), np.zeros((d + 2, d + 1), np.int64), closed)
    # mass of all words: discounted by count, so the counts of counts suffice
    mass = sum(model.discounted(np.array([k]))[0] * r[f"n{k}"] for k in range(1, TOP + 1))
    big = total - sum(k * r[f"n{k}"] for k in range(1, TOP + 1))
    mass += (1 - RESERVED) * BIG * big / max(1, total)
    unknown = (1 - RESERVED) - mass
    p = model.discounted(counts)
    unigram = np.append(p, (1 - RESERVED) - p.sum())
    if not total:
        unigram, unknown = np.ones(len(counts) + 1), 1.0
    every = np.concatenate([counts, [total - total_known, texts]])
    n_all = max(tokens or total, 1)
    parts = max(1, -(-n_all // PART_TOKENS))
    rare = max(1, -(-int(n_all * (1 - total_known / max(1, total))) // (PART_TOKENS if closed else PART_TOKENS // 2)))
    splits = np.maximum(1, np.ceil(every * 4 * parts / n_all)).astype(np.int64)
    return model._replace(counts=every, unigram=unigram, unknown=unknown, parts=parts, rare_parts=rare, splits=splits)


def _sum_by(keys: np.ndarray, *values: np.ndarray):
    """Distinct sorted keys, and each column's sums over them. ``keys`` ascend."""
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[new], *[np.add.reduceat(v, new) if len(new) else v[:0] for v in values]


def _classes(m: Words, column: pa.Array):
    """Of each token: hash, row, class, class before it, and whether it is in the vocabulary. And tokens up to each row."""
    token, upto = _tokens(column)
    other = len(m.hashes)
    at = np.minimum(np.searchsorted(m.hashes, token), other - 1)
    known = m.hashes[at] == token
    cls = np.where(known, m.class_of[at], np.int32(other))
    before = np.empty_like(cls)
    before[1:], before[upto[:-1]] = cls[:-1], other + 1
    return token, rows_of(upto).astype(np.int32), cls, before, known


def dense_pairs(texts: DataFrame, words) -> DataFrame:
    """(pair, n): training counts of the pairs of dense classes, at most DENSE squared and a few rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Words = words.value
        of, shape = m.dense_of, m.dense.shape
        total = np.zeros(shape[0] * shape[1], np.int64)
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                _, doc, cls, before, _ = _classes(m, text_column(batch, "text"))
                learns = ~np.array(text_column(batch, "held").to_pylist(), bool)
                h, w = of[before], of[cls]
                ok = (h >= 0) & (w >= 0) & learns[doc]
                total += np.bincount(h[ok].astype(np.int64) * shape[1] + w[ok], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    return texts.select("text", "held").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _by_hash(m: Words, first: int, x: np.ndarray, y: np.ndarray, y_class: np.ndarray,
             doc: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(part, blob) of the open words x beside y, dealt by x; y is a class, or a hash if it is open too (o...)."""
    both_open = y_class == len(m.hashes)
    part = (x % np.uint64(m.rare_parts)).astype(np.int64)
    order = np.lexsort((doc, y_class, x, part))
    zero = np.uint64(0)
    for k, start, end in runs(part[order]):
        i = order[start:end]
        a, b = i[~both_open[i]], i[both_open[i]]
        yield first + k, pack(dx=np.diff(x[a], prepend=zero), y=smallest(y_class[a]), d=smallest(doc[a]),
                              odx=np.diff(x[b], prepend=zero), oy=y[b], od=smallest(doc[b]))


def dealt(texts: DataFrame, words) -> DataFrame:
    """(part, batch, blob): each slice's pairs by part, then its rare words by part (of an open model with the word
    before, then its rare histories with the word after), then its documents with their sums (part -1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Words = words.value
        other, of = len(m.hashes), m.dense_of
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                token, doc, cls, before, known = _classes(m, text_column(batch, "text"))
                docs = batch.num_rows
                rare = np.flatnonzero(~known)
                rare_token, rare_doc = token[rare], doc[rare]
                by_hash: list[tuple[int, bytes]] = []
                here = np.ones(len(token), bool)
                if not m.closed:
                    after = np.flatnonzero(before == other)
                    by_hash += _by_hash(m, m.parts, rare_token, token[rare - 1], before[rare], rare_doc)
                    by_hash += _by_hash(m, m.parts + m.rare_parts, token[after - 1], token[after], cls[after],
                                        doc[after])
                    here[rare] = here[after] = False
                hd, wd = of[before], of[cls]
                dense = (hd >= 0) & (wd >= 0)
                sums = _sums(m, docs, doc, before, cls, dense, m.dense[hd[dense], wd[dense]])
                here &= ~dense
                doc, cls, before = doc[here], cls[here], before[here]
                bits = max(1, (other + 2).bit_length())
                key = (before.astype(np.uint64) << np.uint64(bits) | cls.astype(np.uint64)) * np.uint64(docs) \
                    + doc.astype(np.uint64)
                key, n = _sum_by(np.sort(key), np.ones(len(key), np.int64))
                pair, d = key // np.uint64(docs), (key % np.uint64(docs)).astype(np.int64)
                h, w = (pair >> np.uint64(bits)).astype(np.int64), (pair & np.uint64((1 << bits) - 1)).astype(np.int64)
                fold = mix(w.astype(np.uint64)) % m.splits[h].astype(np.uint64)
                part = (mix(h.astype(np.uint64) * np.uint64(1 << 24) + fold) % np.uint64(m.parts)).astype(np.int64)
                batch_id = text_column(batch, "rid")[0].as_py()
                out: list[tuple[int, bytes]] = []
                order = np.argsort(part, kind="stable")
                for k, start, end in runs(part[order]):
                    i = order[start:end]
                    out.append((k, pack(dh=smallest(np.diff(h[i], prepend=0)), w=smallest(w[i]), d=smallest(d[i]),
                                        n=smallest(n[i]))))
                out += by_hash
                t, d = (rare_token, rare_doc) if m.closed else (rare_token[:0], rare_doc[:0])
                part = (t % np.uint64(m.rare_parts)).astype(np.int64)
                order = np.lexsort((d, t, part))
                for k, start, end in runs(part[order]):
                    i = order[start:end]
                    out.append((m.parts + k, pack(t=t[i], d=smallest(d[i]))))
                ids = text_column(batch, "id")
                null = np.array(ids.is_null().to_pylist(), np.uint8)
                train = ~np.array(text_column(batch, "held").to_pylist(), bool)
                # what a part must know of the slice: which documents train
                flags = pack(train=train.astype(np.uint8))
                rows = [(k, batch_id, flags, b) for k, b in out]
                rows.append((-1, batch_id, flags, pack(id=pa.compute.fill_null(ids, 0).to_numpy().astype(np.int64),
                                                       null=null, **sums)))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    ["part", "batch", "flags", "blob"])

    return texts.mapInArrow(run, "part int, batch long, flags binary, blob binary")


def _sums(m: Words, docs: int, doc: np.ndarray, h: np.ndarray, w: np.ndarray, dense: np.ndarray, c: np.ndarray) -> dict:
    """Sums by document of what the tables tell: tokens, all about table words alone, what history totals take from
    the score, and the scores of dense pairs (training counts ``c``) with the history of each unseen one in order of
    document."""
    n = len(m.hashes)
    own = np.append(m.counts[:n], [0, 0])
    base_of = np.where(np.arange(n + 2) < n, _base(m, own), 0.0)
    less = -np.log10(np.maximum(1, m.counts))
    less[n] *= m.closed  # of an open history its own token tells
    fixed = less[h]
    seen = _met(c) + fixed[dense]
    with np.errstate(divide="ignore"):
        fixed[dense] = np.where(c > 0, seen, np.log10(m.unigram)[w[dense]])
    d = doc[dense]
    unseen = c == 0
    return dict(n=smallest(np.bincount(doc, minlength=docs)),
                known=smallest(np.bincount(doc[own[w] > 0], minlength=docs)),
                base=np.bincount(doc, base_of[w], docs), fixed=np.bincount(doc, fixed, docs),
                **{f"low{r}": smallest(np.bincount(d[c == r], minlength=docs)) for r in range(1, TOP + 1)},
                unseen=smallest(np.bincount(d[unseen], minlength=docs)), history=smallest(h[dense][unseen]))


def _base(m: Words, own: np.ndarray) -> np.ndarray:
    """log10 of the baseline of words that training has ``own`` times."""
    return np.log10((own + 0.1) / (m.total + 0.1 * (m.types + 1)))


def _met(c: np.ndarray) -> np.ndarray:
    """What a pair's count adds to log10 P of a seen pair; the discounts of small counts are added later."""
    return np.log10(np.maximum(1, c)) + np.where(c > TOP, math.log10(BIG), 0)


def _answers(batch_of: np.ndarray, doc: np.ndarray, n: np.ndarray, batches: list[int],
             **lists: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[str, int, bytes]]:
    """A blob for each batch: of each list the tokens it holds (a mask), by document and value, equal ones once with
    their number. ``met``: counts of seen pairs; ``own``: counts of open words; ``new``: those of them that back off;
    ``to`` and ``from``: word and history, both of the table, of tokens that back off; ``late``: backoff weights."""
    blobs: list[dict[str, np.ndarray]] = [{} for _ in batches]
    for name, (holds, value) in lists.items():
        i = np.flatnonzero(holds)
        if not len(i):
            continue
        i = i[np.lexsort((value[i], doc[i], batch_of[i]))]
        b, d, v = batch_of[i], doc[i], value[i]
        first = np.flatnonzero(np.r_[True, (b[1:] != b[:-1]) | (d[1:] != d[:-1]) | (v[1:] != v[:-1])])
        times, b, d, v = np.add.reduceat(n[i], first), b[first], d[first], v[first]
        for k, start, end in runs(b):
            one, many = slice(start, end), times[start:end]
            blobs[k] |= {f"{name}_d": smallest(np.diff(d[one], prepend=0)),
                         name: v[one] if v.dtype.kind == "f" else smallest(v[one])}
            if (many > 1).any():
                blobs[k][f"{name}_n"] = smallest(many)
    for b, x in zip(batches, blobs):
        if x:
            yield "answer", b, pack(**x)


def _listed(answers: list[dict[str, np.ndarray]], name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, value and number of all entries of a list, in an order that does not depend on that of the answers."""
    parts = [(np.cumsum(x[f"{name}_d"].astype(np.int64)), x[name],
              x[f"{name}_n"].astype(np.int64) if f"{name}_n" in x else np.ones(len(x[name]), np.int64))
             for x in answers if name in x]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    d, v, n = map(np.concatenate, zip(*parts))
    v = v if v.dtype.kind == "f" else v.astype(np.int64)
    order = np.lexsort((n, v, d))
    return d[order], v[order], n[order]


def _count_pairs(m: Words, pdf: pd.DataFrame) -> Iterator[tuple[str, int, bytes]]:
    batches = pdf["batch"].tolist()
    cols = [unpack(x) for x in pdf["blob"]]
    train = [unpack(x)["train"].astype(bool) for x in pdf["flags"]]
    h = np.concatenate([np.cumsum(x["dh"].astype(np.int64)) for x in cols])
    w, d, n = (np.concatenate([x[c].astype(np.int64) for x in cols]) for c in ("w", "d", "n"))
    batch_of = np.repeat(np.arange(len(cols)), [len(x["w"]) for x in cols])
    learns = np.concatenate([t[x["d"].astype(np.int64)] for t, x in zip(train, cols)])
    pair = h * (1 << 24) + w
    name, at = np.unique(pair, return_inverse=True)
    count = np.bincount(at, np.where(learns, n, 0), minlength=len(name)).astype(np.int64)
    ph, pw = name >> 24, name & ((1 << 24) - 1)
    seen = count > 0
    # history sums: types met 1..TOP+1 times, tokens of counts above TOP, P mass of what was met
    stats = [np.where(count == r, 1, 0)[seen] for r in range(1, TOP + 2)]
    hist, *sums = _sum_by(ph[seen], *stats, np.where(count > TOP, count, 0)[seen], m.unigram[pw[seen]])
    yield "history", 0, pack(h=hist, **{f"m{r + 1}": x for r, x in enumerate(sums[:TOP + 1])}, big=sums[-2], p=sums[-1])
    yield "pairs", 0, pack(dh=smallest(np.diff(ph[seen], prepend=0)), w=smallest(pw[seen]), n=smallest(count[seen]))
    met = seen[at]
    yield from _answers(batch_of, d, n, batches, met=(met, count[at]), to=(~met, w), **{"from": (~met, h)})


def _count_rare(m: Words, pdf: pd.DataFrame) -> Iterator[tuple[str, int, bytes]]:
    batches = pdf["batch"].tolist()
    cols = [unpack(x) for x in pdf["blob"]]
    train = [unpack(x)["train"].astype(bool) for x in pdf["flags"]]
    t, d = np.concatenate([x["t"] for x in cols]), np.concatenate([x["d"].astype(np.int64) for x in cols])
    batch_of = np.repeat(np.arange(len(cols)), [len(x["t"]) for x in cols])
    learns = np.concatenate([f[x["d"].astype(np.int64)] for f, x in zip(train, cols)])
    name, at = np.unique(t, return_inverse=True)
    count = np.bincount(at, learns, minlength=len(name)).astype(np.int64)
    yield from _answers(batch_of, d, np.ones(len(t), np.int64), batches, own=(np.ones(len(t), bool), count[at]))


class OpenPairs(NamedTuple):
    """Pairs of an open word x and a word y in one part, and the tokens that have them."""
    x: np.ndarray
    y: np.ndarray  # class, or hash if open
    open: np.ndarray  # whether y is
    count: np.ndarray  # in training
    at: np.ndarray  # pair of each token
    doc: np.ndarray
    batch: np.ndarray  # place in batches
    batches: list[int]


def _open_pairs(pdf: pd.DataFrame) -> OpenPairs:
    cols = [unpack(x) for x in pdf["blob"]]
    train = [unpack(x)["train"].astype(bool) for x in pdf["flags"]]
    both = [(k, c, o) for k, c in enumerate(cols) for o in ("", "o")]
    sizes = [len(c[o + "y"]) for _, c, o in both]
    x = np.concatenate([np.cumsum(c[o + "dx"], dtype=np.uint64) for _, c, o in both])
    y = np.concatenate([c[o + "y"].astype(np.uint64) for _, c, o in both])
    d = np.concatenate([c[o + "d"].astype(np.int64) for _, c, o in both])
    learns = np.concatenate([train[k][c[o + "d"].astype(np.int64)] for k, c, o in both])
    is_open = np.repeat([o == "o" for _, _, o in both], sizes)
    order = np.lexsort((y, is_open, x))
    sx, sy, so = x[order], y[order], is_open[order]
    new = np.ones(len(order), bool)
    new[1:] = (sx[1:] != sx[:-1]) | (sy[1:] != sy[:-1]) | (so[1:] != so[:-1])
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    count = np.bincount(at, learns, minlength=int(new.sum())).astype(np.int64)
    return OpenPairs(sx[new], sy[new], so[new], count, at, d, np.repeat([k for k, _, _ in both], sizes),
                     pdf["batch"].tolist())


def _count_open_words(m: Words, pdf: pd.DataFrame) -> Iterator[tuple[str, int, bytes]]:
    """Of open words and the words before them: all about their tokens, but for what open histories add."""
    q = _open_pairs(pdf)
    _, of = np.unique(q.x, return_inverse=True)
    own = np.bincount(of, q.count).astype(np.int64)  # every token has a word or the start before it
    p = np.where(own > 0, m.discounted(own), m.unknown)[of]
    seen, hist = q.count > 0, np.where(q.open, 0, q.y).astype(np.int64)
    s = np.flatnonzero(seen & ~q.open)
    s = s[np.argsort(hist[s], kind="stable")]
    h, *sums = _sum_by(hist[s], *[np.where(q.count == r, 1, 0)[s] for r in range(1, TOP + 2)],
                       np.where(q.count > TOP, q.count, 0)[s], p[s])
    yield "history", 0, pack(h=h, **{f"m{r + 1}": x for r, x in enumerate(sums[:TOP + 1])}, big=sums[-2], p=sums[-1])
    # to the open histories: how often training has the words that follow them
    s = np.flatnonzero(seen & q.open)
    part = (q.y[s] % np.uint64(m.rare_parts)).astype(np.int64)
    order = np.lexsort((q.y[s], part))
    for k, start, end in runs(part[order]):
        i = s[order[start:end]]
        yield "mass", k, pack(dh=np.diff(q.y[i], prepend=np.uint64(0)), n=smallest(own[of[i]]))
    n, met, is_open = own[of][q.at], seen[q.at], q.open[q.at]
    yield from _answers(q.batch, q.doc, np.ones(len(q.at), np.int64), q.batches, own=(np.ones(len(q.at), bool), n),
                        met=(met & ~is_open, q.count[q.at]), new=(~met, n),
                        **{"from": (~met & ~is_open, hist[q.at])})


def _count_open_histories(m: Words, part: int, pdf: pd.DataFrame) -> Iterator[tuple[str, int, bytes]]:
    """Of open histories and the words after them: counts of seen pairs, and the table words that back off. Tokens
    that need a backoff weight wait for the mass of open followers."""
    q = _open_pairs(pdf)
    name, of = np.unique(q.x, return_inverse=True)
    total = np.bincount(of, q.count).astype(np.int64)
    types = [np.bincount(of[q.count == r], minlength=len(name)) for r in range(1, TOP + 2)]
    big = np.bincount(of, np.where(q.count > TOP, q.count, 0), len(name)).astype(np.int64)
    yield "history", 0, pack(h=np.array([len(m.hashes)]), **{f"m{r + 1}": np.array([x.sum()]) for r, x in enumerate(types)},
                             big=np.array([big.sum()]), p=np.zeros(1))
    seen, w = q.count > 0, np.where(q.open, 0, q.y).astype(np.int64)
    mass = np.bincount(of, np.where(seen & ~q.open, m.unigram[w], 0.0), len(name))
    yield from _answers(q.batch, q.doc, np.ones(len(q.at), np.int64), q.batches, met=(seen[q.at], q.count[q.at]),
                        to=((~seen & ~q.open)[q.at], w[q.at]))
    waits = np.flatnonzero(~seen[q.at] & (total[of] > 0)[q.at])  # a history never met backs off in full
    if len(waits):
        h, at = np.unique(of[q.at[waits]], return_inverse=True)
        b, place = np.unique(q.batch[waits], return_inverse=True)
        yield "wait", part, pack(h=name[h], total=smallest(total[h]), big=smallest(big[h]), p=mass[h],
                                 **{f"m{r + 1}": smallest(types[r][h]) for r in range(TOP)}, at=smallest(at),
                                 d=smallest(q.doc[waits]), b=smallest(place), batch=np.array(q.batches, np.int64)[b])


def _late_answers(m: Words, d: list[float], pdf: pd.DataFrame) -> Iterator[tuple[str, int, bytes]]:
    """Backoff weights of the open histories of a part, for the tokens that wait for them. Their totals, which go with
    the histories' own tokens, are for seen pairs only, so they are taken back."""
    for blob in pdf["blob"][pdf["kind"] == "wait"]:  # at most one
        x = unpack(blob)
        p = x["p"].copy()
        for y in map(unpack, sorted(pdf["blob"][pdf["kind"] == "mass"])):
            h = np.cumsum(y["dh"], dtype=np.uint64)
            at = np.minimum(np.searchsorted(x["h"], h), len(p) - 1)
            ours = x["h"][at] == h
            np.add.at(p, at[ours], m.discounted(y["n"][ours].astype(np.int64)))
        met = sum(d[r] * (r + 1) * x[f"m{r + 1}"].astype(float) for r in range(TOP)) + BIG * x["big"]
        back = np.log10((1 - met / x["total"]) / (1 - p)) + np.log10(x["total"].astype(float))
        size = len(x["at"])
        yield from _answers(x["b"].astype(np.int64), x["d"].astype(np.int64), np.ones(size, np.int64), x["batch"].tolist(),
                            late=(np.ones(size, bool), back[x["at"].astype(np.int64)]))


def backoff_weights(m: Words, types: np.ndarray, big: np.ndarray, p: np.ndarray, d: list[float]) -> np.ndarray:
    """log10 of every history's backoff weight; a history never met backs off in full."""
    met = sum(d[r] * (r + 1) * types[r] for r in range(TOP)) + BIG * big
    total = m.counts.astype(float).copy()
    total[int(m.class_of[np.searchsorted(m.hashes, END)])] = 0  # nothing follows the end
    left = np.where(total > 0, 1 - met / np.maximum(total, 1), 1.0)
    return np.log10(left / np.where(total > 0, 1 - p, 1.0))


def _tables(texts: DataFrame, shared, parts: int) -> DataFrame:
    """(kind, batch, blob), stored: pair counts, history sums, answers and documents."""
    def count(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        w: Words = shared.value
        part = int(key[0])
        if part < 0:
            rows = [(k, b, x) for k, c in (("documents", "blob"), ("flags", "flags")) for b, x in zip(pdf["batch"], pdf[c])]
        elif part < w.parts:
            rows = list(_count_pairs(w, pdf))
        elif w.closed:
            rows = list(_count_rare(w, pdf))
        elif part < w.parts + w.rare_parts:
            rows = list(_count_open_words(w, pdf))
        else:
            rows = list(_count_open_histories(w, part - w.parts - w.rare_parts, pdf))
        return pd.DataFrame(rows, columns=["kind", "batch", "blob"])

    # a slice is named by the id of its first row; the ids only need to differ within this one scan
    deals = dealt(texts.withColumn("rid", F.monotonically_increasing_id()), shared)
    spread = F.when(F.col("part") < 0, -1 - F.pmod(F.xxhash64("batch"), F.lit(parts))).otherwise(F.col("part"))
    return store(deals.withColumn("part", spread.cast("int")).groupBy("part")
                   .applyInPandas(count, "kind string, batch long, blob binary"), "katz-tables")


def history_sums(tables: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each of ``n`` histories the numbers of seen types by count, the tokens of those above TOP, and the seen mass.

    Added up in tasks and then by history; the driver gets one row a history, ``VOCABULARY`` + 2 at most. The mass adds
    up as decimals, so its order does not matter.
    """
    names = [*[f"m{r + 1}" for r in range(TOP + 1)], "big"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, mass = np.zeros((len(names), n), np.int64), np.zeros(n)
        for batch in batches:
            for blob in batch.column(0):
                x = unpack(blob.as_py())
                at = x["h"].astype(np.int64)
                for row, name in zip(sums, names):
                    np.add.at(row, at, x[name].astype(np.int64))
                np.add.at(mass, at, x["p"])
        h = np.flatnonzero(sums.any(axis=0) | (mass != 0))
        yield pa.RecordBatch.from_arrays([pa.array(h), *[pa.array(row[h]) for row in sums], pa.array(mass[h])],
                                         names=["h", *names, "p"])

    rows = tables.where("kind = 'history'").select("blob").mapInArrow(
        run, f"h long, {', '.join(f'{x} long' for x in names)}, p double")
    found = rows.groupBy("h").agg(*[F.sum(x).alias(x) for x in names],
                                  F.sum(F.col("p").cast("decimal(38,28)")).cast("double").alias("p")).toPandas()
    out = np.zeros((len(names) + 1, n))
    out[:, found["h"].to_numpy()] = found[[*names, "p"]].to_numpy(float).T
    return out[:TOP + 1], out[TOP + 1], out[TOP + 2]


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: int | None = None,
          table: int = VOCABULARY) -> DataFrame:
    """Doc id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    The model has every word; ``table`` does not change it. Only ``vocabulary`` closes it to that many words.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"),
                        held_out(F.col(doc_id)).alias("held"))
    words = store(count_words(texts), "katz-words")
    n_train, n_docs = texts.agg(F.count_if(~F.col("held")), F.count("*")).first()
    total = words.agg(F.sum("n").alias("n")).first()["n"] or 0
    m = word_model(words, n_train, table if vocabulary is None else vocabulary,
                   int(total * n_docs / max(1, n_train)), vocabulary is not None)
    shared = spark.sparkContext.broadcast(m)
    pairs = store(dense_pairs(texts, shared), "katz-dense").toPandas()
    dense = m.dense.copy()
    dense.reshape(-1)[pairs["pair"].to_numpy()] = pairs["n"].to_numpy()
    m = m._replace(dense=dense)
    shared = spark.sparkContext.broadcast(m)
    tables = _tables(texts, shared, m.parts)
    release(spark)
    n = len(m.hashes) + 2
    types, big, p = history_sums(tables, n)
    # the dense pairs' share of the sums
    classes = np.r_[:dense.shape[1] - 1, n - 2, n - 1]
    for r in range(TOP + 1):
        types[r][classes] += (dense == r + 1).sum(1)
    big[classes] += np.where(dense > TOP, dense, 0).sum(1)
    p[classes] += (dense > 0) @ m.unigram[classes[:-1]]
    d = discounts(types.sum(1).tolist())
    weights = spark.sparkContext.broadcast((backoff_weights(m, types, big, p, d), [math.log10(x) for x in d], m.total))

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        w: Words = shared.value
        back, low, total = weights.value
        by = {k: [unpack(x) for x in g["blob"]] for k, g in pdf.groupby("kind")}
        rows, flags = by["documents"][0], by["flags"][0]
        size = len(rows["id"])
        answers = by.get("answer", [])

        def added(name: str, of) -> np.ndarray:
            d, v, times = _listed(answers, name)
            return np.bincount(d, of(v) * times, size)

        def p(c: np.ndarray) -> np.ndarray:
            return np.log10(np.where(c > 0, w.discounted(c), w.unknown))

        met = np.array([0.0, *low, 0.0])
        tokens = rows["n"].astype(np.int64)
        known = rows["known"].astype(np.int64) + added("own", lambda c: c > 0).astype(np.int64)
        base = rows["base"] + added("own", lambda c: _base(w, c))
        own = rows["fixed"] + sum(low[r] * rows[f"low{r + 1}"] for r in range(TOP))
        own += np.bincount(np.repeat(np.arange(size), rows["unseen"]), back[rows["history"].astype(np.int64)], size)
        own += added("met", lambda c: _met(c) + met[np.minimum(c, TOP + 1)])
        # of an open word: the total of the token after it; in a closed model: its share of its class
        own += added("own", lambda c: p(c) - math.log10(w.unigram[-1]) if w.closed else -np.log10(np.maximum(1, c)))
        own += added("new", p) + added("to", lambda x: np.log10(w.unigram[x])) + added("late", lambda x: x)
        own += added("from", lambda h: back[h] + np.log10(np.maximum(1, w.counts[h])))
        ids = pd.array(rows["id"], dtype="Int64")
        ids[rows["null"].astype(bool)] = pd.NA
        return pd.DataFrame({doc_id: ids, "held_out": flags["train"] == 0, "n_tokens": tokens, "n_known": known,
                             "train_tokens": total, "base_score": base, "score": own})

    ready = tables.where("kind in ('documents', 'flags', 'answer')")
    if not m.closed:
        def late(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame(list(_late_answers(shared.value, d, pdf)), columns=["kind", "batch", "blob"])

        ready = ready.unionByName(tables.where("kind in ('wait', 'mass')").groupBy("batch")
                                  .applyInPandas(late, tables.schema))
    return ready.groupBy("batch").applyInPandas(
        finish, f"`{doc_id}` long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")
