"""Language identification: averaged hashed subword embeddings, a linear softmax, and calibrated rejection.

A text's subwords are the n-grams (``ORDERS`` code points) of its words, which are stretches of letters and marks in
lower case with a boundary on both sides; an n-gram crosses no word. Each falls by hash into one of ``BUCKETS``
embeddings. The mean embedding of the whole text goes through a linear layer and a softmax over the learned labels.

1. Sample. ``max_rows`` labelled rows at most train the model: equal shares of the labels, taken by a hash of the row,
   cut to ``max_rows`` by that hash. Each gives its whole text and a few fragments of its words, as counts of buckets.
2. Training. One task runs stochastic gradient descent in numpy over these bounded counts. A fifth of the rows, by
   hash, is not learned from; on it a temperature is fitted, and the least confidence from which predictions there are
   right in ``precision`` of all cases.
3. Prediction. Tasks read every text whole, in pieces of about a million code points. With at most ``DIM`` labels,
   embeddings and layer are one table of label scores per bucket.

Defined cases: a null text, and one without a letter, is ``und`` with score 0, and not accepted; so is every text where
no label could be learned. Rows without text or label teach nothing. Rows that are the same in all of id, text and label
are taken together or not at all where a label has more than its share. Of equal label scores the label first in order
wins. Empty tables give empty results. A word of over a million letters without a blank is cut there. Other columns
pass through unchanged; columns named like the results are replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store
from .packed import pack, unpack
from .tokens import mix, text_column

BUCKETS, DIM = 1 << 16, 16
ORDERS = (2, 3, 4)
MAX_ROWS = 4000
FEW_LABELS = 10_000
FRAGMENTS = 4
EPOCHS, RATE = 6, 0.8
PRECISION = 0.98
PIECE = 1 << 20
UNKNOWN = "und"

_OTHER, _LETTER, _MARK = 1, 2, 3
_kinds = np.zeros(0x110000, np.uint8)  # filled as code points come: 0 is not looked up yet


def _kind(code: np.ndarray) -> np.ndarray:
    kind = _kinds[code]
    if not kind.all():
        for c in np.unique(code[kind == 0]):
            major = unicodedata.category(chr(c))[0]
            _kinds[c] = _LETTER if major == "L" else _MARK if major == "M" else _OTHER
        kind = _kinds[code]
    return kind


def _grams(code: np.ndarray, kind: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every subword of a sequence of code points; rows end with something other than a letter."""
    word = kind != _OTHER
    code, row = np.where(word, code, 0).astype(np.uint64), row
    keep = np.ones(len(code), bool)
    keep[1:] = word[1:] | word[:-1]  # one boundary between words
    code, row = np.r_[np.uint64(0), code[keep]], np.r_[row[:1], row[keep]]
    inner = code != 0
    buckets, rows = [], []
    for n in ORDERS:
        last = len(code) - n + 1
        if last < 1:
            continue
        ok = np.ones(last, bool)
        for k in range(1, n - 1):
            ok &= inner[k:k + last]
        if n == 2:
            ok &= inner[:last] | inner[1:1 + last]
        at = np.flatnonzero(ok)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + code[at + k]
        buckets.append((mix(h) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64))
        rows.append(row[at + np.where(inner[at], 0, 1)])  # the row of its first letter
    return (np.concatenate(buckets), np.concatenate(rows)) if buckets else (np.zeros(0, np.int64),) * 2


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE:
        end = max(text.rfind(" ", at, at + PIECE), text.rfind("\n", at, at + PIECE))
        end = end if end > at else at + PIECE
        yield text[at:end]
        at = end
    yield text[at:]


def _encoded(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, kinds, rows) of texts, in groups of about PIECE code points."""
    group, rows, size = [], [], 0

    def ready():
        code = np.frombuffer("\n".join(group + [""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        return code, _kind(code), np.repeat(rows, [len(x) + 1 for x in group])

    for k, text in enumerate(texts):
        for piece in _pieces(text):
            piece = piece.lower()
            if group and size + len(piece) > PIECE:
                yield ready()
                group, rows, size = [], [], 0
            group.append(piece)
            rows.append(k)
            size += len(piece)
    if group:
        yield ready()


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and how often each comes."""
    total = np.zeros(BUCKETS, np.int64)
    for code, kind, row in _encoded([text]):
        total += np.bincount(_grams(code, kind, row)[0], minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at]


def _fragments(text: str, seed: int) -> Iterator[str]:
    """Short stretches of a text's words, as the hash of its row names them: models must know short texts too."""
    words = text.split()
    for k in range(FRAGMENTS if len(words) > 1 else 0):
        h = int(mix(np.array([(seed + k * 0x9E3779B97F4A7C15) % (1 << 64)], np.uint64))[0])
        size = min(1 + h % (4 << k), len(words))
        at = (h >> 20) % (len(words) - size + 1)
        yield " ".join(words[at:at + size])


@dataclass
class Model:
    labels: list[str]
    embed: np.ndarray
    layer: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def logits(self, mean: np.ndarray) -> np.ndarray:
        return mean @ self.layer + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, bool, np.ndarray, np.ndarray]], precision: float) -> Model | None:
    """Model of (label, is for calibration, buckets, counts) rows; none without labels."""
    learn = [x for x in rows if not x[1] and len(x[2])]
    check = [x for x in rows if x[1] and len(x[2])]
    labels = sorted({x[0] for x in learn})
    if not labels:
        return None
    rng = np.random.default_rng(17)
    number = {x: k for k, x in enumerate(labels)}
    embed = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    layer, bias = np.zeros((DIM, len(labels))), np.zeros(len(labels))
    shares = [(number[x[0]], x[2], x[3] / x[3].sum()) for x in learn]
    steps, done = EPOCHS * len(shares), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(shares)):
            y, at, share = shares[k]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = share @ embed[at]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = layer @ p
            layer -= rate * np.outer(mean, p)
            bias -= rate * p
            embed[at] -= rate * share[:, None] * back
    model = Model(labels, embed, layer, bias)
    known = [x for x in check if x[0] in number]
    if known:
        _calibrate(model, np.array([model.logits((x[3] / x[3].sum()) @ embed[x[2]]) for x in known]),
                   np.array([number[x[0]] for x in known]), precision)
    return model


def _calibrate(model: Model, logits: np.ndarray, truth: np.ndarray, precision: float) -> None:
    """Temperature of least log loss, and the least confidence from which ``precision`` of predictions are right.

    As in Platt scaling, one more row counts as wrong, so that labels without an error keep some doubt.
    """
    doubt = 1 / (len(truth) + 2)

    def loss(t: float) -> float:
        model.temperature = t
        p = np.log(model.probabilities(logits) + 1e-12)
        right = p[np.arange(len(truth)), truth]
        wrong = (p.sum(axis=1) - right) / max(1, p.shape[1] - 1)
        return -((1 - doubt) * right + doubt * wrong).mean()

    model.temperature = min(np.geomspace(0.05, 20, 121).tolist(), key=loss)
    p = model.probabilities(logits)
    best = p.max(axis=1)
    order = np.argsort(-best, kind="stable")
    right = np.cumsum((p.argmax(axis=1) == truth)[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero((right >= precision) & np.r_[best[order][1:] < best[order][:-1], True])
    model.least = float(best[order][enough[-1]]) if len(enough) else 1.0 + 1e-9


_SEED = "__seed"


def sample(labelled: DataFrame, max_rows: int, text: str = "text", label: str = "label",
           key: str | None = None) -> DataFrame:
    """(label, check, buckets, counts): whole texts and fragments of at most ``max_rows`` labelled rows."""
    rows = labelled.select(F.col(text).alias("text"), F.col(label).cast("string").alias("label"),
                           F.xxhash64(text, label, *([key] if key else [])).alias(_SEED)) \
        .where(F.col("text").isNotNull() & F.col("label").isNotNull())
    sizes = store(rows.groupBy("label").agg(F.count("*").alias("n")), "language-labels")
    labels = sizes.count()
    shares = sizes.select("label", (F.lit(max_rows / max(1, labels)) / F.col("n")).alias("share"))
    if labels <= FEW_LABELS:  # counted: the texts stay where they are
        shares = F.broadcast(shares)
    place = F.col(_SEED).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    taken = rows.join(shares, "label").where(place < F.col("share")).select("label", _SEED, "text") \
        .orderBy(_SEED, "label").limit(max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, seed, value = (batch.column(j)[k].as_py() for j in range(3))
                found = [_counts(x) for x in [value, *_fragments(value, seed % (1 << 64))]]
                check = (seed >> 52) % 5 == 0
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(found)), pa.array([check] * len(found)),
                    pa.array([x[0].tolist() for x in found], pa.list_(pa.int32())),
                    pa.array([x[1].tolist() for x in found], pa.list_(pa.int64()))],
                    names=["label", "check", "buckets", "counts"])

    return taken.mapInArrow(run, "label string, check boolean, buckets array<int>, counts array<long>")


def fit(labelled: DataFrame, text: str = "text", label: str = "label", key: str | None = None,
        max_rows: int = MAX_ROWS, precision: float = PRECISION) -> Model | None:
    """Model learned from a bounded sample of rows with text and label; none if there is nothing to learn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(name.as_py(), check.as_py(), np.asarray(at.values), np.asarray(n.values))
                for b in batches for name, check, at, n in zip(*(b.column(k) for k in range(4)))]
        model = train(rows, precision)
        if model is not None:
            blob = pack(embed=model.embed.astype(np.float32).ravel(), layer=model.layer.ravel(), bias=model.bias,
                        rest=np.array([model.temperature, model.least]))
            yield pa.RecordBatch.from_arrays([pa.array([model.labels]), pa.array([blob], pa.binary())],
                                             names=["labels", "blob"])

    row = sample(labelled, max_rows, text, label, key).coalesce(1) \
        .mapInArrow(run, "labels array<string>, blob binary").first()
    if row is None:
        return None
    x = unpack(bytes(row["blob"]))
    return Model(list(row["labels"]), x["embed"].reshape(BUCKETS, DIM).astype(float), x["layer"].reshape(DIM, -1),
                 x["bias"], *x["rest"].tolist())


def predict(docs: DataFrame, model: Model | None, text: str = "text", label: str = "lang_pred", score: str = "score",
            accepted: str = "accepted") -> DataFrame:
    """Adds the predicted label, its calibrated probability, and whether that is enough to rely on it."""
    kept = [c for c in docs.columns if c not in (label, score, accepted) or c == text]
    if text in (label, score, accepted):
        raise ValueError("the results need names other than the text's")
    schema = T.StructType([docs.schema[c] for c in kept] + [
        T.StructField(label, T.StringType()), T.StructField(score, T.DoubleType()),
        T.StructField(accepted, T.BooleanType())])
    blob = None if model is None else (
        model.labels, *((model.embed @ model.layer, None) if len(model.labels) <= DIM
                        else (model.embed, model.layer)), model.bias, model.temperature, model.least)
    shared = docs.sparkSession.sparkContext.broadcast(blob)  # BUCKETS * DIM numbers at most, and DIM a label

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = shared.value
        for batch in batches:
            n = batch.num_rows
            texts = [x or "" for x in text_column(batch, text).to_pylist()]
            names, best, sure = [UNKNOWN] * n, np.zeros(n), np.zeros(n, bool)
            if given is not None and n:
                labels, table, layer, bias, temperature, least = given
                total, size, letters = np.zeros((n, table.shape[1])), np.zeros(n), np.zeros(n, bool)
                for code, kind, row in _encoded(texts):
                    letters[row[kind == _LETTER]] = True
                    bucket, of = _grams(code, kind, row)
                    for a in range(0, len(bucket), PIECE):
                        b, r = bucket[a:a + PIECE], of[a:a + PIECE]
                        first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                        np.add.at(total, r[first], np.add.reduceat(table[b], first, axis=0))
                    size += np.bincount(of, minlength=n)
                mean = total / np.maximum(size, 1)[:, None]
                model = Model(labels, table, layer, bias, temperature, least)
                p = model.probabilities(mean + bias if layer is None else mean @ layer + bias)
                top = p.argmax(axis=1)
                best = np.where(letters, p[np.arange(n), top], 0.0)
                names = [labels[k] if ok else UNKNOWN for k, ok in zip(top, letters)]
                sure = letters & (best >= least)
            yield pa.RecordBatch.from_arrays(
                [text_column(batch, c) for c in kept] + [pa.array(names, pa.string()), pa.array(best), pa.array(sure)],
                names=[*kept, label, score, accepted])

    return docs.select(*kept).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept for testing: crc32 of its id modulo 5 is 0. A null id is not, and teaches nothing."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))
